"""The incremental operators as streams over landed files."""

from motorledger.streaming.increments import stream_deletes, stream_upsert

__all__ = ["stream_deletes", "stream_upsert"]
