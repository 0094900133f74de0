"""Column to Column functions. All of them stay inside generated JVM code."""

from motorledger.functions import classes, dates, nulls, numbers, text

__all__ = ["classes", "dates", "nulls", "numbers", "text"]
