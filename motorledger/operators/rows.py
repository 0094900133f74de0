"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorledger import values as V
from motorledger.functions.dates import when_at
from motorledger.operators.joins import attach_group


def filter_eq(df: DataFrame, pairs: Iterable[tuple[str, object]]) -> DataFrame:
    for name, value in pairs:
        df = df.where(F.col(name) == value)
    return df


def drop_soft_deleted(
    tables: Mapping[str, DataFrame], flags: Mapping[str, str | Sequence[str]]
) -> dict[str, DataFrame]:
    """Per table, keep rows whose deletion flags are all false. Absent flags are ignored."""
    out = dict(tables)
    for name, cols in flags.items():
        if name not in out:
            continue
        for c in [cols] if isinstance(cols, str) else cols:
            if c in out[name].columns:
                out[name] = out[name].where(~F.col(c).cast("boolean"))
    return out


def since(df: DataFrame, col: str, date: str) -> DataFrame:
    return df.where(F.col(col) >= when_at(date))


def before(df: DataFrame, col: str, date: str) -> DataFrame:
    return df.where(F.col(col) < when_at(date))


def prefer_rows(df: DataFrame, key: str, wanted: Column) -> DataFrame:
    """In groups that have wanted rows keep only those, otherwise keep all; null keys go.

    The group verdict is a combinable aggregate joined back, so a key holding a third
    of the rows is still spread over tasks.
    """
    wanted = F.coalesce(wanted, F.lit(False))
    flagged = df.where(F.col(key).isNotNull()).withColumn("_wanted", wanted)
    judged = attach_group(flagged, [key], {"_any": F.max("_wanted")})
    return judged.where(F.col("_wanted") | ~F.col("_any")).drop("_wanted", "_any")


def exclude_today(df: DataFrame, col: str, as_of: datetime, hour: int = V.EVENING_HOUR) -> DataFrame:
    """Before the evening hour the running day is incomplete and left out."""
    if as_of.hour >= hour:
        return df
    return df.where(F.col(col) < when_at(as_of.strftime("%Y-%m-%d")))


def excluded_keys(df: DataFrame, key: str, rules: Sequence[Column], unless: Column) -> DataFrame:
    """Distinct keys of rows that break any rule and are not excused."""
    broken = F.lit(False)
    for rule in rules:
        broken = broken | F.coalesce(rule, F.lit(False))
    return df.where(broken & ~F.coalesce(unless, F.lit(False))).select(key).distinct()
