"""Audience analytics as composable Spark DataFrame operators."""
