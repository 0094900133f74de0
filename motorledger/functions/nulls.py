"""Null handling that is stated instead of inherited.

SQL three-valued logic silently loses rows whose flag is null. These helpers give
the ledger meaning: an unknown value is not a member of any list, equals nothing,
and contributes nothing to a row total.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from motorledger import values as V

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_in(c: ColumnLike, values: Iterable) -> Column:
    """True unless the value is one of ``values``; a null value is kept."""
    values = list(values)
    if not values:
        return F.lit(True)
    c = as_col(c)
    return c.isNull() | ~c.isin(*values)


def differs(c: ColumnLike, value) -> Column:
    """``!=`` that is true for null."""
    return ~as_col(c).eqNullSafe(value)


def non_empty(c: ColumnLike) -> Column:
    c = as_col(c)
    return c.isNotNull() & (c.cast("string") != "")


def contains(c: ColumnLike, part: str, na: bool = False) -> Column:
    return F.coalesce(as_col(c).contains(part), F.lit(na))


def matches(c: ColumnLike, pattern: str, na: bool = False) -> Column:
    return F.coalesce(as_col(c).rlike(pattern), F.lit(na))


def zero(c: ColumnLike) -> Column:
    return F.coalesce(as_col(c), F.lit(0.0))


def row_sum(cols: Iterable[ColumnLike], min_count: int = 0) -> Column:
    """Sum across columns, null as 0; null when fewer than ``min_count`` are present."""
    cols = list(cols)
    if all(isinstance(c, str) for c in cols):
        total = F.expr(" + ".join(f"coalesce(`{c}`, 0.0D)" for c in cols))
    else:
        total = reduce(add, (zero(c) for c in cols))
    if min_count <= 0:
        return total
    cols = [as_col(c) for c in cols]
    return F.when(_present(cols) >= min_count, total)


def row_mean(cols: Iterable[ColumnLike]) -> Column:
    """Mean of the present values across columns; 0 when none is present."""
    cols = [as_col(c) for c in cols]
    return F.when(_present(cols) > 0, row_sum(cols) / _present(cols)).otherwise(F.lit(0.0))


def count_positive(cols: Iterable[str], weights: Mapping[str, int] | None = None) -> Column:
    """How many columns are above zero, some counting more than once."""
    weights = weights or {}
    return reduce(
        add, (F.when(F.col(c) > 0, F.lit(weights.get(c, 1))).otherwise(F.lit(0)) for c in cols)
    )


def null_text(c: ColumnLike, tokens: Iterable[str] = V.NULL_WORDS, to: str | None = None) -> Column:
    """Replace the words that stand for a missing value (and null itself) by ``to``."""
    c = as_col(c)
    kept = F.when(~c.isin(*tokens), c)
    return kept if to is None else F.coalesce(kept, F.lit(to))


def _present(cols: list[Column]) -> Column:
    return reduce(add, (F.when(c.isNotNull(), F.lit(1)).otherwise(F.lit(0)) for c in cols))
