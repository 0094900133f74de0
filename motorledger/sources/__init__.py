"""Reading landed data and writing published tables."""

from motorledger.sources import ledgers, pages, sinks, tables

__all__ = ["ledgers", "pages", "sinks", "tables"]
