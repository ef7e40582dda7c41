"""Incremental loading of newly arriving export files (Structured Streaming)."""

from spendlake.streaming.incremental import start_incremental_load, start_ledger_load

__all__ = ["start_incremental_load", "start_ledger_load"]
