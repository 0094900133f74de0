"""One row per key, with a total order so the survivor never depends on input order.

``row_number() = 1`` lets Catalyst keep a single candidate per key in every map task
before the shuffle, so a heavy key sends one row per task, not all of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorledger.functions.dates import NTZ

Order = Sequence[str | tuple[str, str]]
#: Copies of a row that one task writes out.
_RUN = 100_000


def sort_columns(order: Order, flip: bool = False) -> list[Column]:
    """Sort expressions; nulls come last in both directions."""
    out = []
    for item in order:
        name, direction = (item, "asc") if isinstance(item, str) else item
        down = (direction == "desc") != flip
        out.append(F.col(name).desc_nulls_last() if down else F.col(name).asc_nulls_last())
    return out


def sortable(df: DataFrame, skip: Sequence[str]) -> list[Column]:
    """All other columns as a tiebreak; types without an order are compared as text."""
    out = []
    for f in df.schema.fields:
        if f.name not in skip:
            odd = isinstance(f.dataType, (T.MapType, T.VariantType))
            out.append((F.to_json(F.col(f.name)) if odd else F.col(f.name)).asc_nulls_last())
    return out


def _deciding(df: DataFrame, known: Sequence[str], shown: Sequence[str]) -> list[str]:
    """The tiebreaks that can change what is ``shown``: none behind the last one shown.

    Rows that tie up to there have the same shown values, whichever comes first. Values that compare equal
    and yet differ, as 0.0 and -0.0 do, need all tiebreaks.
    """
    others = [c for c in df.columns if c not in known]
    kinds = [df.schema[c].dataType for c in shown]
    if not all(k == T.StringType() or isinstance(k, (T.IntegralType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)) for k in kinds):
        return others
    return others[: max((i + 1 for i, c in enumerate(others) if c in shown), default=0)]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Order, shown: Sequence[str] | None = None) -> DataFrame:
    """With ``shown`` only those columns come back, and no column is read that cannot decide them."""
    names = [o if isinstance(o, str) else o[0] for o in order]
    if shown is not None:
        deciding = {*keys, *names, *shown, *_deciding(df, [*keys, *names], shown)}
        kept = first_per_key(df.select(*[c for c in df.columns if c in deciding]), keys, order)
        return kept.select(*shown)
    by = [*sort_columns(order), *sortable(df, [*keys, *names])]
    window = Window.partitionBy(*keys).orderBy(*by) if by else Window.partitionBy(*keys).orderBy(F.lit(1))
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") == 1).drop("_rn")


def last_per_key(df: DataFrame, keys: Sequence[str], order: Order, shown: Sequence[str] | None = None) -> DataFrame:
    """The first row of the reversed order, nulls still last."""
    turned = [(o, "desc") if isinstance(o, str) else (o[0], "asc" if o[1] == "desc" else "desc") for o in order]
    return first_per_key(df, keys, turned, shown)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = True) -> DataFrame:
    """The row with the greatest values in ``order``; unknown values lose."""
    return last_per_key(df, keys, list(order)) if last else first_per_key(df, keys, list(order))


def dedupe_except(df: DataFrame, keep_whole: Column, keys: Sequence[str], order: Order) -> DataFrame:
    """Keep pseudo rows as they are and the last ordinary row per key."""
    keep_whole = F.coalesce(keep_whole, F.lit(False))
    return df.where(keep_whole).unionByName(last_per_key(df.where(~keep_whole), keys, order))


def distinct_sparse(df: DataFrame, shared: Sequence[str]) -> DataFrame:
    """``df.distinct()`` for a union in which most rows know no more than the ``shared`` columns.

    All other columns are packed into one record, which is null where every one of them is, so a row of
    few known columns is grouped and shuffled as a short one. The rows are those of ``distinct``,
    whichever columns are named.
    """
    others = [c for c in df.columns if c not in shared]
    if not others:
        return df.distinct()
    known = reduce(or_, (F.col(c).isNotNull() for c in others))
    kept = [c for c in df.columns if c in shared]
    packed = df.select(*kept, F.when(known, F.struct(*others)).alias("_others")).distinct()
    return packed.select(*[F.col(c) if c in kept else F.col("_others")[c].alias(c) for c in df.columns])


def distinct_within(df: DataFrame, at: Sequence[str]) -> DataFrame:
    """``df.distinct()`` for rows that already lie by the ``at`` columns, as behind a join on them: they stay there.

    Grouping by some columns asks for no shuffle where rows are dealt by a few of these; the others are one record.
    """
    others = [c for c in df.columns if c not in at]
    packed = df.select(*at, F.struct(*others).alias("_others")).distinct()
    return packed.select(*[F.col(c) if c in at else F.col("_others")[c].alias(c) for c in df.columns])


def group_span_days(df: DataFrame, key: str, ts: str, name: str = "span_days") -> DataFrame:
    """Days between the first and last moment of the group, on every row."""
    from motorledger.operators.joins import attach_group

    span = F.floor(F.timestamp_diff("SECOND", F.min(F.col(ts).cast(NTZ)), F.max(F.col(ts).cast(NTZ))) / 86400)
    return attach_group(df, [key], {name: span.cast("int")})


def tenure(df: DataFrame, person: str, store: str, ts: str) -> DataFrame:
    """Per person: latest store, days between first and last sale, months rounded up."""
    at = F.col(ts).cast(NTZ)
    days = F.floor(F.timestamp_diff("SECOND", F.min(at), F.max(at)) / 86400).cast("int")
    latest = F.max(F.struct(at.alias("t"), F.col(store).alias("s")))["s"]
    return (
        df.groupBy(person)
        .agg(latest.alias(store), days.alias("tenure_days"))
        .withColumn("tenure_months", F.ceil(F.col("tenure_days") / 30).cast("int"))
        .withColumn("seller_key", F.concat(F.col(store), F.lit("-"), F.col(person)))
    )


def allocate_once(df: DataFrame, keys: Sequence[str], col: str, order: Sequence[str]) -> DataFrame:
    """The first row of a group keeps ``col``, the others get 0.

    Rows of a group are not numbered: equal rows are counted, the first is found by a
    combinable minimum over the values alone, so a task that runs again finds the same one.
    Many copies of one row are written out again in runs, dealt to several tasks.
    """
    from motorledger.operators.joins import attach_group

    names = list(df.columns)
    copies = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_copies"))
    by = [*order, *[c for c in names if c not in order]]
    rank = F.struct(*[x for c in by for x in (F.col(c).isNull().alias(f"n_{c}"), F.col(c).alias(c))])
    # null is a group of its own here: as one record the keys are never null and compare equal
    ranked = copies.withColumn("_rank", rank).withColumn("_group", F.struct(*keys))
    judged = attach_group(ranked, ["_group"], {"_first": F.min("_rank")})
    last = F.col("_copies") - 1
    runs = judged.select(
        *names, (F.col("_rank") == F.col("_first")).alias("_is_first"), last.alias("_last"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(_RUN).cast("bigint"))).alias("_run"),
    )
    dealt = runs.repartition(*names, "_run")
    place = F.explode(F.sequence("_run", F.least(F.col("_last"), F.col("_run") + (_RUN - 1)))).alias("_place")
    spelled = dealt.select(*names, "_is_first", place)
    kept = F.when(F.col("_is_first") & (F.col("_place") == 0), F.col(col)).otherwise(F.lit(0))
    kind = df.schema[col].dataType
    return spelled.withColumn(col, kept.cast(kind)).select(*names)


def any_in_group(df: DataFrame, key: str, predicate: Column, name: str) -> DataFrame:
    from motorledger.operators.joins import attach_group

    return attach_group(df, [key], {name: F.max(F.coalesce(predicate, F.lit(False)))})
