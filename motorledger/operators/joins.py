"""Lookups and joins on ledger keys.

Two things make ledger keys dangerous at scale: rows without a key all hash to one
partition, and one placeholder key can own a large share of the rows.

* Rows without a key can never match. They get a second join key out of a hash of the
  row, so they spread over all partitions; rows with a key have 0 there, like the right.
* That second key makes both sides of a lookup arrive by a shuffle of their own, the form
  in which adaptive execution can split a partition that a heavy key made too large.
* Group aggregates put back on their rows know their heaviest keys already. At most
  ``HEAVY_KEYS`` of them are broadcast, a constant, and never shuffle their rows together.

Which side is broadcast is otherwise left to Catalyst, which compares sizes first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from operator import and_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorledger import values as V
from motorledger.functions.dates import NTZ
from motorledger.functions.nulls import zero
from motorledger.functions.text import match_key, suffix
from motorledger.operators.keep import latest_per_key

HEAVY_KEYS = 256
_SPREAD_OVER = 4096
_SPREAD_COLUMNS = 4
_SPREAD = "_spread"


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions)


def _no_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))


def _spread_of(df: DataFrame, keys: Sequence[str]) -> Column:
    """A number out of a few other columns. Only a few, so that unused columns stay unread."""
    some = [c for c in df.columns if c not in keys][:_SPREAD_COLUMNS] or list(keys)
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in some]), F.lit(_SPREAD_OVER)) + 1


def _with_spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """0 for rows that may match, another number for rows that cannot."""
    return df.withColumn(_SPREAD, F.when(_no_key(keys), _spread_of(df, keys)).otherwise(F.lit(0).cast("bigint")))


def _right(df: DataFrame, keys: Sequence[str], cols: Mapping[str, str]) -> DataFrame:
    picked = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    return df.where(~_no_key(keys)).select(
        *picked, _zero_of(*keys).alias("_r0"), *[F.col(c).alias(new) for c, new in cols.items()]
    )


def _zero_of(*keys: str) -> Column:
    """Always 0, but not a literal: a literal would be folded out of the join keys."""
    return F.xxhash64(*keys).bitwiseAND(F.lit(0).cast("bigint"))


def _same(keys: Sequence[str], zero_name: str) -> Column:
    pairs = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)]
    return _all([*pairs, F.col(_SPREAD) == F.col(zero_name)])


def _columns(right: DataFrame, keys: Sequence[str], cols) -> dict[str, str]:
    if cols is None:
        cols = [c for c in right.columns if c not in keys]
    return dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    right_on: Sequence[str] | None = None,
    cols: Sequence[str] | Mapping[str, str] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Left join that brings ``cols`` over. Null keys match nothing unless ``null_safe``."""
    on, right_on = list(on), list(right_on or on)
    picked = _columns(right, right_on, cols)
    taken = set(left.columns) & set(picked.values())
    if taken:
        raise ValueError(f"columns on both sides: {sorted(taken)}")
    if null_safe:
        keys = [F.col(k).alias(f"_k{i}") for i, k in enumerate(right_on)]
        r = right.select(*keys, *[F.col(c).alias(n) for c, n in picked.items()])
        condition = _all([F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(on)])
        return left.join(r, condition, "left").select(*left.columns, *picked.values())
    r = _right(right, right_on, picked)
    joined = _with_spread(left, on).join(r, _same(on, "_r0"), "left")
    return joined.select(*left.columns, *picked.values())


def attach_group(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Put group aggregates on every row without a window over the whole group.

    The aggregate is combined map-side, so it is small, and it also knows the heaviest
    keys. Those are answered from the broadcast, their rows are spread. Both uses read
    every column of the aggregate, so its shuffle is planned once and reused.
    """
    keys, names = list(keys), list(aggs)
    grouped = (
        df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()], F.count(F.lit(1)).alias("_n"))
        .where(~_no_key(keys) & (F.col("_n") > 0))
    )
    heavy = grouped.orderBy(F.col("_n").desc(), *keys).limit(HEAVY_KEYS).select(
        *[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)], F.struct(*names).alias("_hv")
    )
    first = df.join(
        F.broadcast(heavy), _all([F.col(k) == F.col(f"_h{i}") for i, k in enumerate(keys)]), "left"
    ).select(*df.columns, "_hv")
    # copies of one row share a content hash, so heavy rows are spread by task as well
    by_task = F.pmod(_spread_of(df, keys) + F.spark_partition_id() * 31, F.lit(_SPREAD_OVER)) + 1
    spread = F.when(_no_key(keys) | F.col("_hv").isNotNull(), by_task).otherwise(F.lit(0).cast("bigint"))
    rest = grouped.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], _zero_of(*keys).alias("_r0"),
        *[F.col(n).alias(f"_v_{n}") for n in names],
    )
    joined = first.withColumn(_SPREAD, spread).join(rest, _same(keys, "_r0"), "left")
    return joined.select(
        *df.columns,
        *[F.when(F.col("_hv").isNotNull(), F.col("_hv")[n]).otherwise(F.col(f"_v_{n}")).alias(n) for n in names],
    )


def outer_merge(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join; the keys of both sides become one column.

    A left join, and the right rows that have no partner: both can be split where a key is hot, which
    a full join cannot. Rows without a key match nothing and are spread.
    """
    on = list(on)
    taken = (set(left.columns) & set(right.columns)) - set(on)
    if taken:
        raise ValueError(f"columns on both sides: {sorted(taken)}")
    others = [c for c in right.columns if c not in on]
    partners = left.where(~_no_key(on)).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(on)]).distinct()
    partners = partners.withColumn("_r0", _zero_of(*[f"_k{i}" for i in range(len(on))]))
    lone = _with_spread(right, on).join(partners, _same(on, "_r0"), "left_anti").drop(_SPREAD)
    return left_lookup(left, right, on, cols=others).select(*on, *[c for c in left.columns if c not in on], *others).unionByName(lone, allowMissingColumns=True)


@dataclass(frozen=True)
class Lookup:
    """One point of a star: a table, the columns it gives, and how to make it unique."""

    table: DataFrame | None
    cols: Sequence[str]
    latest_by: Sequence[str] = field(default_factory=tuple)
    unique: bool = False


def star_join(fact: DataFrame, key: str, lookups: Sequence[Lookup], spread_as: str | None = None) -> DataFrame:
    """Left join many tables to a fact on one key.

    Each table that is not unique is reduced to one row per key first, so nothing fans out. The spread
    column stays until the end: all joins then share one partitioning of the fact. It comes back under the
    name ``spread_as``, if one is given, for steps that use this partitioning by ``key`` and spread too.
    Tables that are missing and columns that do not exist are skipped.
    """
    out = _with_spread(fact, [key])
    for i, item in enumerate(lookups):
        if item.table is None:
            continue
        cols = [c for c in item.cols if c in item.table.columns and c not in out.columns]
        if not cols:
            continue
        needed = list(dict.fromkeys([key, *cols, *item.latest_by]))
        unique = item.table.select(*needed).where(F.col(key).isNotNull())
        if not item.unique:
            unique = latest_per_key(unique, [key], item.latest_by)
        side = unique.select(F.col(key).alias("_k0"), _zero_of(key).alias("_r0"), *cols)
        out = out.join(side, _same([key], "_r0"), "left").drop("_k0", "_r0")
    return out.drop(_SPREAD) if spread_as is None else out.withColumnRenamed(_SPREAD, spread_as)


def semi(left: DataFrame, right: DataFrame, on: str, right_on: str | None = None) -> DataFrame:
    return _membership(left, right, on, right_on, "left_semi")


def anti(left: DataFrame, right: DataFrame, on: str, right_on: str | None = None) -> DataFrame:
    """Rows without a partner; rows without a key are kept."""
    return _membership(left, right, on, right_on, "left_anti")


def _membership(left, right, on, right_on, how):
    keys = right.select(F.col(right_on or on).alias("_k0")).where(F.col("_k0").isNotNull()).distinct()
    if how == "left_semi":
        return left.where(F.col(on).isNotNull()).join(keys, F.col(on) == F.col("_k0"), how)
    keys = keys.withColumn("_r0", _zero_of("_k0"))
    return _with_spread(left, [on]).join(keys, _same([on], "_r0"), how).select(*left.columns)


def flag_in(
    left: DataFrame, right: DataFrame, on: str, name: str,
    yes=V.YES, no=V.NO, right_on: str | None = None,
) -> DataFrame:
    """Say on every row whether its key occurs in the other table."""
    keys = (
        right.select(F.col(right_on or on).alias(on)).where(F.col(on).isNotNull()).distinct()
        .withColumn("_found", F.lit(True))
    )
    out = left_lookup(left, keys, [on])
    return out.withColumn(name, F.when(F.col("_found"), F.lit(yes)).otherwise(F.lit(no))).drop("_found")


def latest_lookup(
    left: DataFrame, right: DataFrame, on: Sequence[str], order: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """Look up in the latest right row per key."""
    on = list(on)
    unique = latest_per_key(right.where(~_no_key(on)), on, order).select(*on, *cols)
    return left_lookup(left, unique, on)


def suffix_join(left: DataFrame, right: DataFrame, col: str, cols: Sequence[str], order: Sequence[str], n: int = 6) -> DataFrame:
    """Look up by the last characters of an identifier, the latest right row winning."""
    key = "_suffix"
    r = right.withColumn(key, suffix(col, n)).select(key, *dict.fromkeys([*cols, *order]))
    return latest_lookup(left.withColumn(key, suffix(col, n)), r, [key], order, cols).drop(key)


def key_lookup(left: DataFrame, right: DataFrame, on: Sequence[str], right_on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Look up by a text key built from several columns, nulls as ''; one right row per key."""
    key = "_match_key"
    r = right.withColumn(key, match_key(right_on))
    unique = latest_per_key(r.select(key, *cols), [key], [], last=False)
    return left_lookup(left.withColumn(key, match_key(on)), unique, [key]).drop(key)


def qualify_store(df: DataFrame, series_dim: DataFrame, store: str, series: str, network: str | None = None) -> DataFrame:
    """The shared live-stream store is told apart by the network of the car series.

    A host store whose series has no network keeps its bare name.
    """
    dim = series_dim.where(F.col("series").isNotNull()).groupBy("series").agg(F.min("network").alias("_network"))
    out = left_lookup(df, dim, [series], ["series"], ["_network"])
    known = (F.col(store) == V.HOST_STORE) & F.col("_network").isNotNull()
    out = out.withColumn(
        store, F.when(known, F.concat("_network", F.lit("-"), store)).otherwise(F.col(store))
    )
    return out.withColumnRenamed("_network", network) if network else out.drop("_network")


def stack_keys(df: DataFrame, keys: Sequence[str], value: str, key: str = "key") -> DataFrame:
    """Several alternative id columns become one id column, one row per id.

    Of several values the one under the earlier id column, then the smallest, is kept.
    """
    options = F.array(*[F.struct(F.lit(i).alias("i"), F.col(k).cast("string").alias("k")) for i, k in enumerate(keys)])
    stacked = df.select(F.explode(options).alias("o"), F.col(value)).where(F.col("o.k").isNotNull())
    return (
        stacked.groupBy(F.col("o.k").alias(key))
        .agg(F.min(F.struct(F.col("o.i").alias("i"), F.col(value).isNull().alias("n"), F.col(value).alias("v"))).alias("m"))
        .select(key, F.col("m.v").alias(value))
    )


def prefer_merge(left: DataFrame, right: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Cell by cell: the left value if known and not zero, else the right one, else the left."""
    out = left_lookup(left, right, on, cols={c: f"_other_{c}" for c in cols})
    return out.withColumns(
        {
            c: F.when(zero(c) != 0, F.col(c)).otherwise(F.coalesce(F.col(f"_other_{c}"), F.col(c)))
            for c in cols
        }
    ).drop(*[f"_other_{c}" for c in cols])


def _year(c: Column, first: int, last: int) -> Column:
    return F.greatest(F.lit(first), F.least(F.lit(last), F.year(c)))


def _swept(starts: Sequence[int], ends: Sequence[int], first: int, last: int) -> list[tuple[int, int | None]]:
    """Moments at which the rule in force changes, within ``first`` to ``last``, each with the rule from then on.

    Rules are given by ascending start, no two with one start; a rule holds until its end, not included.
    A rule that ends in force gives way to the nearest earlier one with a later end; one that
    ends while a later rule is in force changes nothing.
    """
    found: dict[int, int | None] = {}
    before: list[int | None] = []
    open_ones: list[int] = []  # the ends of these get smaller from one to the next
    ended: list[tuple[int, int]] = []
    for i, end in enumerate(ends):
        while open_ones and ends[open_ones[-1]] <= end:
            j = open_ones.pop()
            if starts[i] >= ends[j]:
                ended.append((ends[j], j))  # its first rival came too late
        before.append(open_ones[-1] if open_ones else None)
        open_ones.append(i)
    ended += [(ends[j], j) for j in open_ones]
    for at, j in ended:
        if at <= last:
            found[at] = before[j]
    for i, start in enumerate(starts):
        found[max(start, first)] = i
    return list(found.items())


def interval_spans(
    rules: DataFrame, keys: Sequence[str], start: str, end: str, cols: Sequence[str], first_year: int = 1990, last_year: int = 2060
) -> DataFrame:
    """Rules with both bounds included as disjoint spans: ``keys``, year ``_y``, ``_at``, ``_until`` and ``_v``.

    From ``_at`` until ``_until`` (in microseconds, not included) the latest started rule in force
    is the one whose ``cols`` are in ``_v``. Of rules with one start only the greatest by end and
    values can ever hold. Each (key, year) is swept on its own and has spans of its own, years
    outside the range with the edge years.
    """
    keys = list(keys)
    micros = lambda c: F.unix_micros(F.col(c).cast(NTZ).cast("timestamp"))
    best = F.max(F.struct(F.col(end).alias("_e"), F.struct(*[F.col(c) for c in cols]).alias("_v"))).alias("_best")
    one = rules.where(~_no_key(keys) & (F.col(start) <= F.col(end))).groupBy(*keys, F.col(start).alias("_s")).agg(best)
    years = F.sequence(_year(F.col("_s"), first_year, last_year), _year(F.col("_best._e"), first_year, last_year))
    laid = one.select(*keys, F.explode(years).alias("_y"), "_s", F.col("_best._e").alias("_e"), F.col("_best._v").alias("_v"))
    laid = laid.select(*keys, "_y", micros("_s").alias("_s"), (micros("_e") + 1).alias("_e"), "_v")
    edge = lambda year: int((datetime(year, 1, 1) - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    bounds = [T.StructField(c, T.LongType()) for c in ("_at", "_until")]
    schema = T.StructType([*[laid.schema[k] for k in keys], laid.schema["_y"], *bounds, laid.schema["_v"]])

    def sweep(part: pa.Table) -> pa.Table:
        part = part.take(pc.sort_indices(part["_s"]))
        year = part["_y"][0].as_py()
        first = -(1 << 62) if year <= first_year else edge(year)
        last = 1 << 62 if year >= last_year else edge(year + 1)
        found = sorted(_swept(part["_s"].to_pylist(), part["_e"].to_pylist(), first, last), key=lambda m: m[0])
        spans = [(i, at, until) for (at, i), (until, _) in zip(found, [*found[1:], (last, None)]) if i is not None and at < until]
        winner, at, until = (pa.array([s[k] for s in spans], pa.int64()) for k in range(3))
        same = [part[c].take(winner) for c in [*keys, "_y"]]
        return pa.table([*same, at, until, part["_v"].take(winner)], [*keys, "_y", "_at", "_until", "_v"])

    return laid.groupBy(*keys, "_y").applyInArrow(sweep, schema)


def interval_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, start: str, end: str,
    cols: Sequence[str], first_year: int = 1990, last_year: int = 2060, how: str = "left",
) -> DataFrame:
    """The latest started rule that is in force, both bounds included.

    Rules become disjoint spans of their key and year, so a fact has one partner at most: a join
    on key and year with the span's bounds gathers no rules and makes no pairs, and can be split
    where a key is hot. Years outside the range share the edge years, the bounds are exact.
    Ties on the start go to the greatest end, then the greatest remaining values. Facts
    without a key or a time match nothing and are spread over the partitions.
    """
    keys = list(keys)
    spans = interval_spans(right, keys, start, end, cols, first_year, last_year)
    side = spans.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_y", "_at", "_until", F.col("_v").alias("_hit"), _zero_of("_y").alias("_r0"))
    moment = F.unix_micros(F.col(ts).cast(NTZ).cast("timestamp"))
    facts = left.withColumns({"_fy": _year(F.col(ts), first_year, last_year), "_moment": moment}).withColumn(
        _SPREAD, F.when(_no_key(keys) | F.col(ts).isNull(), _spread_of(left, keys)).otherwise(F.lit(0).cast("bigint"))
    )
    inside = (F.col("_moment") >= F.col("_at")) & (F.col("_moment") < F.col("_until"))
    out = facts.join(side, _same(keys, "_r0") & (F.col("_fy") == F.col("_y")) & inside, "left")
    if how == "inner":
        out = out.where(F.col("_hit").isNotNull())
    return out.select(*left.columns, *[F.col("_hit")[c].alias(c) for c in cols])


def asof_lookup(
    left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, start: str,
    cols: Sequence[str], bucket_days: float = 1,
) -> DataFrame:
    """For each left row the latest right row of its key that started at or before ``ts``.

    Both sides may be large. Time is cut into buckets, each (key, bucket) is scanned
    once in time order, and what was known at the end of earlier buckets is carried in
    from a small per-bucket table. A heavy key is therefore split over its buckets, which
    may be parts of a day, and no pairs are formed. Unmatched left rows stay; those without
    a key or a time match nothing and are spread by a number of their own.
    """
    keys = list(keys)
    payload = F.struct(F.col(start).alias("_s"), *[F.col(c).alias(c) for c in cols])
    micros = int(bucket_days * 86_400_000_000)
    bucket = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / micros)
    l = left.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(ts).alias("_t"), F.lit(1).alias("_side"),
        bucket(F.col(ts)).alias("_b"),
        F.when(_no_key(keys) | F.col(ts).isNull(), _spread_of(left, keys)).otherwise(F.lit(0).cast("bigint")).alias(_SPREAD),
        F.struct(*[F.col(c) for c in left.columns]).alias("_l"),
    )
    r = right.where(~_no_key(keys) & F.col(start).isNotNull()).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(start).alias("_t"), F.lit(0).alias("_side"), bucket(F.col(start)).alias("_b"),
        F.lit(0).cast("bigint").alias(_SPREAD), payload.alias("_r"),
    )
    both = l.unionByName(r, allowMissingColumns=True)
    ks = [f"_k{i}" for i in range(len(keys))]
    known = F.when(F.col("_side") == 0, F.col("_r"))
    ends = both.where(F.col(_SPREAD) == 0).groupBy(*ks, "_b").agg(F.max(known).alias("_end"))
    earlier = Window.partitionBy(*ks).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *[F.col(k).alias(f"{k}c") for k in ks], F.col("_b").alias("_bc"), _zero_of(*ks).alias("_r0"),
        F.max("_end").over(earlier).alias("_carry"),
    ).where(F.col("_carry").isNotNull())
    in_order = (
        Window.partitionBy(*ks, "_b", _SPREAD).orderBy("_t", "_side", "_r")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    scanned = both.withColumn("_now", F.max(known).over(in_order)).where(F.col("_side") == 1)
    condition = _all([F.col(k) == F.col(f"{k}c") for k in ks]) & (F.col("_b") == F.col("_bc")) & (F.col(_SPREAD) == F.col("_r0"))
    joined = scanned.join(carried, condition, "left")
    best = F.coalesce(F.col("_now"), F.col("_carry"))
    return joined.select("_l.*", *[best[c].alias(c) for c in cols])
