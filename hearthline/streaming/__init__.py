"""Incremental processing. There are no unbounded streams: the increment is a week."""
