"""Incremental ingest with Structured Streaming.

The source pipeline is batch only; its ingest step (CSV files -> raw tables) is offered here
in incremental form as well: each run picks up only files not seen before, exactly once.
"""

from abtforge.streaming.ingest import ingest_new_files

__all__ = ["ingest_new_files"]
