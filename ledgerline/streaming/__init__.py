"""Continuous file ingest, incremental tasks, refreshes and the task run log."""
