"""Group aggregates. Null keys never form a group; an empty sum is 0."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorledger.functions.nulls import ColumnLike, as_col, contains
from motorledger.session import written

#: Characters of one part of a joined text.
PART_CHARS = 1 << 20


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(reduce(and_, (F.col(k).isNotNull() for k in keys)))


def total(c: ColumnLike) -> Column:
    return F.coalesce(F.sum(as_col(c)), F.lit(0))


def first_known(c: ColumnLike, order: Sequence[ColumnLike]) -> Column:
    """First non-null value in the given order, ties by the value itself."""
    c = as_col(c)
    rank = F.struct(*[x for o in order for x in (as_col(o).isNull(), as_col(o))], c)
    return F.min_by(c, F.when(c.isNotNull(), rank))


def join_distinct(c: ColumnLike, sep: str = ",") -> Column:
    """Distinct known values as one text, in value order."""
    return F.array_join(F.sort_array(F.collect_set(as_col(c).cast("string"))), sep)


def join_dates(c: ColumnLike, fmt: str = "yyyy/MM/dd", sep: str = ",") -> Column:
    return join_distinct(F.date_format(as_col(c), fmt), sep)


def item_text(name: ColumnLike, qty: ColumnLike) -> Column:
    """``name*qty``; null when either is unknown. Whole quantities print without decimals."""
    qty = as_col(qty)
    whole = qty.cast("bigint")
    shown = F.when(whole == qty, whole.cast("string")).otherwise(qty.cast("string"))
    return F.concat(as_col(name), F.lit("*"), shown)


def sum_where(c: ColumnLike, predicate: Column) -> Column:
    return F.sum(F.when(F.coalesce(predicate, F.lit(False)), as_col(c)).otherwise(F.lit(0.0)))


def group_sum(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return keyed(df, keys).groupBy(*keys).agg(*[total(c).alias(c) for c in cols])


def group_count(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    return keyed(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def group_agg(df: DataFrame, keys: Sequence[str], spec: Mapping[str, Column]) -> DataFrame:
    return keyed(df, keys).groupBy(*keys).agg(*[c.alias(n) for n, c in spec.items()])


def group_items(
    df: DataFrame, keys: Sequence[str], item: Column, name: str,
    sums: Mapping[str, Column] | None = None, sep: str = ",", mins: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Sums and minima per key plus all item texts joined, duplicates kept, in item order.

    Rows are first combined per (key, item) with a count, so the second step sees each
    distinct item once, however many rows a key has. The text itself names every row:
    that is the result asked for, and it is the only thing as long as the group.
    """
    sums, mins = dict(sums or {}), dict(mins or {})
    parts = (
        keyed(df, keys).withColumn("_item", item).groupBy(*keys, "_item")
        .agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(n) for n, c in sums.items()],
             *[F.min(c).alias(n) for n, c in mins.items()])
    )
    again = lambda x: F.repeat(F.concat(x["_item"], F.lit(sep)), x["_n"].cast("int") - 1)
    repeated = lambda x: F.concat(again(x), x["_item"])
    listed = F.sort_array(F.collect_list(F.when(F.col("_item").isNotNull(), F.struct("_item", "_n"))))
    return parts.groupBy(*keys).agg(
        *[total(n).alias(n) for n in sums],
        *[F.min(n).alias(n) for n in mins],
        F.array_join(F.transform(listed, repeated), sep).alias(name),
    )


def join_all(df: DataFrame, keys: Sequence[str], col: str, name: str, sep: str = ",") -> DataFrame:
    return group_items(df, keys, F.col(col).cast("string"), name, sep=sep)


def joined_parts(
    df: DataFrame, keys: Sequence[str], item: ColumnLike, name: str, sep: str = ",", distinct_items: bool = False, limit: int = PART_CHARS
) -> DataFrame:
    """The item texts of each key, in item order, as numbered parts: ``keys``, ``part`` from 0, and the text.

    The parts of a key, joined by ``sep`` in order, are the text that :func:`join_all` (or, with
    ``distinct_items``, :func:`join_distinct`) gives. A part holds the items that start in its ``limit``
    characters, so it has less than twice as many unless one item is longer. A key without known items has no part.

    No key is gathered anywhere: counted items are laid out by range, each range is numbered on its
    own, and a range learns where it starts in its key from the sizes of the ranges before it.
    Equal items beyond a part's size are dealt to several rows.
    """
    keys = list(keys)
    known = keyed(df, keys).select(*keys, as_col(item).cast("string").alias("_item")).where(F.col("_item").isNotNull())
    copies = F.lit(1).cast("bigint") if distinct_items else F.count(F.lit(1))
    size = F.length("_item") + len(sep)
    most = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(limit) / F.greatest(size, F.lit(1))))
    counted = known.groupBy(*keys, "_item").agg(copies.alias("_n")).withColumn("_most", most)
    runs = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / F.col("_most")))).alias("_run")
    dealt = counted.select(*keys, "_item", "_n", "_most", runs)
    dealt = dealt.select(*keys, "_item", "_run", F.least("_most", F.col("_n") - F.col("_run") * F.col("_most")).alias("_copies"))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = dealt.repartitionByRange(ranges, *keys, "_item", "_run").withColumn("_range", F.spark_partition_id())
    # written, so that both uses below see the same ranges
    laid = written(ranged.withColumn("_size", F.col("_copies") * size), "text-ranges")
    ahead = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = laid.groupBy(*keys, "_range").agg(F.sum("_size").alias("_sum"))
    starts = sizes.select(*keys, "_range", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys, "_range").orderBy("_item", "_run").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = laid.withColumn("_end", F.sum("_size").over(within)).join(starts, [*keys, "_range"])
    slot = F.floor((F.col("_start") + F.col("_end") - F.col("_size")) / F.greatest(F.lit(limit), F.lit(1))).alias("_slot")
    repeated = lambda x: F.concat(F.repeat(F.concat(x["_item"], F.lit(sep)), x["_copies"].cast("int") - 1), x["_item"])
    listed = F.sort_array(F.collect_list(F.struct("_item", "_run", "_copies")))
    text = F.array_join(F.transform(listed, repeated), sep).alias(name)
    slots = placed.select(*keys, slot, "_item", "_run", "_copies")
    found = slots.groupBy(*keys, "_slot").agg(text)
    # long items leave slots empty: the slots alone, without their texts, are counted per key
    number = (F.row_number().over(Window.partitionBy(*keys).orderBy("_slot")).cast("bigint") - 1).alias("part")
    numbers = slots.select(*keys, "_slot").distinct().select(*keys, "_slot", number)
    return found.join(numbers, [*keys, "_slot"]).select(*keys, "part", name)


def distinct(df: DataFrame) -> DataFrame:
    return df.distinct()


def summary(sales: DataFrame, stock: DataFrame, in_stock: str, approximate: bool = False) -> DataFrame:
    """Counts and means of the two application tables, one row per table."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    a = sales.agg(
        F.lit("sales").alias("table_name"), F.count(F.lit(1)).alias("rows"),
        count("store").alias("stores"), count("series").alias("series"),
        F.avg("unit_profit").alias("mean_value"), F.lit(0).cast("bigint").alias("in_stock"),
    )
    b = stock.agg(
        F.lit("stock").alias("table_name"), F.count(F.lit(1)).alias("rows"),
        count("store").alias("stores"), count("series").alias("series"),
        F.avg("stock_days").alias("mean_value"),
        F.count_if(contains("vehicle_status", in_stock)).alias("in_stock"),
    )
    return a.unionByName(b)
