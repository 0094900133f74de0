"""DataFrame to DataFrame operators. None of them runs a job by itself."""

from motorledger.operators import (
    columns,
    deletes,
    documents,
    groups,
    joins,
    keep,
    quality,
    reshape,
    rows,
    unions,
    upserts,
)

__all__ = [
    "columns", "deletes", "documents", "groups", "joins", "keep",
    "quality", "reshape", "rows", "unions", "upserts",
]
