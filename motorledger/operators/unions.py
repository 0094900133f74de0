"""Unions by name, with a cut-over date, and ordered output."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorledger.functions.dates import when_at
from motorledger.operators.keep import Order, sort_columns


def _common(a: T.DataType, b: T.DataType) -> T.DataType:
    numeric = (T.NumericType,)
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, numeric) and isinstance(b, numeric):
        if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):  # money stays exact
            scale = max(a.scale, b.scale)
            return T.DecimalType(min(38, max(a.precision - a.scale, b.precision - b.scale) + scale), scale)
        whole = (T.IntegerType, T.LongType, T.ShortType, T.ByteType)
        return T.LongType() if isinstance(a, whole) and isinstance(b, whole) else T.DoubleType()
    if isinstance(a, temporal) and isinstance(b, temporal):
        return T.TimestampNTZType()
    return T.StringType()


def union_outer(*dfs: DataFrame) -> DataFrame:
    """Union by name; missing columns are null and differing types meet in a common one."""
    types: dict[str, T.DataType] = {}
    for df in dfs:
        for f in df.schema.fields:
            types[f.name] = _common(types[f.name], f.dataType) if f.name in types else f.dataType
    fitted = [
        df.select(*[F.col(f.name).cast(types[f.name]).alias(f.name) if f.dataType != types[f.name] else F.col(f.name) for f in df.schema.fields])
        for df in dfs
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), fitted)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_outer(*dfs).distinct()


def union_at_cutover(
    current: DataFrame, archive: DataFrame, date: str, cutover: str, also_archive: Column | None = None
) -> DataFrame:
    """Current rows from the cut-over on, archive rows before it.

    The moment of the cut-over itself belongs to the current side. ``also_archive`` keeps
    further archive rows; a row that qualifies twice is still one row.
    """
    old = F.col(date) < when_at(cutover)
    if also_archive is not None:
        old = old | F.coalesce(also_archive, F.lit(False))
    return union_outer(current.where(F.col(date) >= when_at(cutover)), archive.where(old))


def relabel_positions(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def sort_by(df: DataFrame, order: Order) -> DataFrame:
    return df.orderBy(*sort_columns(order))


def sort_by_expr(df: DataFrame, *exprs: Column) -> DataFrame:
    return df.orderBy(*[e.asc_nulls_last() for e in exprs])


def quarter_number(label: str) -> Column:
    return F.regexp_extract(F.col(label), r"Q(\d)", 1).try_cast("int")


def month_of_label(label: str) -> Column:
    from motorledger.functions.dates import month_start

    return month_start(label)
