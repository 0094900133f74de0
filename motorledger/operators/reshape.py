"""Wide to long and back. All map-side except the quarter means, which are row-wise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorledger.functions.nulls import contains, row_mean, row_sum


def melt(df: DataFrame, ids: Sequence[str], var: str = "attribute", value: str = "value") -> DataFrame:
    rest = [c for c in df.columns if c not in ids]
    text = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in rest])
    return text.unpivot(list(ids), rest, var, value)


def melt_families(df: DataFrame, key: str, families: Mapping[str, str], label: str = "month") -> DataFrame:
    """Several families of wide columns, told apart by a suffix, to one row per label.

    A label that only one family has still gives a row. One explode, no join.
    """
    labels: dict[str, None] = {}
    for suffix in families.values():
        labels.update({c[: -len(suffix)]: None for c in df.columns if c.endswith(suffix)})
    have = set(df.columns)

    def cell(name: str, suffix: str, lab: str) -> Column:
        c = F.col(f"`{lab}{suffix}`") if f"{lab}{suffix}" in have else F.lit(None)
        return c.cast("double").alias(name)

    entries = F.array(
        *[
            F.struct(F.lit(lab).alias(label), *[cell(n, s, lab) for n, s in families.items()])
            for lab in labels
        ]
    )
    return df.select(key, F.explode(entries).alias("e")).select(key, "e.*")


def quarters_to_rows(df: DataFrame, key: str, year: str, measures: Sequence[str] = ("score", "result", "incentive")) -> DataFrame:
    """Columns ``q<n>_<measure>`` to one row per quarter; a missing measure is null."""
    have = set(df.columns)

    def cell(q: int, m: str) -> Column:
        c = F.col(f"q{q}_{m}") if f"q{q}_{m}" in have else F.lit(None)
        return c.cast("string" if m == "result" else "double").alias(m)

    entries = F.array(
        *[
            F.struct(F.lit(f"{year}Q{q}").alias("quarter"), *[cell(q, m) for m in measures])
            for q in range(1, 5)
        ]
    )
    return df.select(key, F.explode(entries).alias("e")).select(key, "e.*")


def month_to_quarter(df: DataFrame, key: str, quarters: Mapping[int, Mapping[str, Sequence[str]]]) -> DataFrame:
    """Per quarter the mean of the month scores (2 decimals) and the sum of incentives."""
    out = [F.col(key)]
    for q, parts in quarters.items():
        out.append(F.bround(row_mean(parts["score"]), 2).alias(f"q{q}_score"))
        out.append(row_sum(parts["incentive"]).alias(f"q{q}_incentive"))
    return df.select(*out)


def filter_attributes(df: DataFrame, attribute: str, drop: str | None = None, keep: str | None = None, key: str | None = None) -> DataFrame:
    if drop is not None:
        df = df.where(~contains(attribute, drop))
    if keep is not None:
        df = df.where(contains(attribute, keep))
    return df if key is None else df.where(F.col(key).isNotNull())


def explode_ids(df: DataFrame, col: str, name: str) -> DataFrame:
    """A comma list of ids to one row per id; blanks are no ids."""
    parts = F.transform(F.split(F.col(col), ","), lambda x: F.trim(x))
    return df.withColumn(name, F.explode(F.filter(parts, lambda x: x != "")))
