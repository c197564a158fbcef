"""Scans, snapshots, writers and exports."""
