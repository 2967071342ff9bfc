"""Continuous form of the incremental sync (Structured Streaming)."""

from ledgerline.streaming.sync import start_sync, sync_available

__all__ = ["start_sync", "sync_available"]
