"""Incremental processing: what changed since the last run, and what may run next."""
