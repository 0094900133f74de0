"""Plans that hold when one key owns a third of the rows, or none is known."""

import contextlib
import random
import time

import pytest
from pyspark.sql import functions as F

from motorledger import values as V
from motorledger.operators import groups, joins, keep
from motorledger.plans import sales
from motorledger.queries import QUERIES
from motorledger.queries.registry import Tables

FOLDER = "/root/testdata/sf0.001"


@contextlib.contextmanager
def conf(spark, **settings):
    names = {k.replace("__", "."): v for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SMALL_PARTITIONS = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20000",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20000",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__shuffle__partitions": "16",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, n=60000):
    """A third of the rows carry one key, another part carries none."""
    key = F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(0, n, 1, 16).withColumn("k", key).withColumn("pad", F.sha2(F.col("id").cast("string"), 256))


def test_lookup_splits_a_hot_key(spark):
    right = spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")).union(spark.sql("SELECT 'HOT', 7L"))
    with conf(spark, **SMALL_PARTITIONS):
        out = joins.left_lookup(skewed(spark), right, ["k"])
        got = out.groupBy((F.col("k") == "HOT").alias("hot")).agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("m"))
        out.write.format("noop").mode("overwrite").save()
        collected = out.collect()
        assert "skew=true" in plan(out)
        assert len(collected) == 60000
        assert sum(1 for r in collected if r["k"] == "HOT" and r["v"] == 7) == 20000
        assert {r["hot"]: (r["n"], r["m"]) for r in got.collect()}[True] == (20000, 20000)


@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_outer_merge_splits_a_hot_key(spark, hot_side):
    many = skewed(spark)
    few = spark.range(600).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")).union(spark.sql("SELECT 'HOT', 7L UNION ALL SELECT NULL, 8L"))
    with conf(spark, **SMALL_PARTITIONS):
        out = joins.outer_merge(many, few, ["k"]) if hot_side == "left" else joins.outer_merge(few, many, ["k"])
        got = out.agg(F.count(F.lit(1)), F.count("v"), F.count_if(F.col("k").isNull()), F.count("id")).first()
        out.write.format("noop").mode("overwrite").save()
        keyed = many.where("k is not null").count()
        alone = 60000 - keyed
        # keys no row of the large side has, and the keyless rows of both sides
        lone = few.join(many.select("k").distinct(), "k", "left_anti").where("k is not null").count()
        assert tuple(got) == (60000 + lone + 1, keyed + lone + 1, alone + 1, 60000)
        out.collect()
        assert "skew=true" in plan(out)


def test_star_join_splits_a_hot_key(spark):
    side = spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")).union(spark.sql("SELECT 'HOT', 7L"))
    with conf(spark, **SMALL_PARTITIONS):
        out = joins.star_join(skewed(spark), "k", [joins.Lookup(side, ["v"]), joins.Lookup(side.withColumnRenamed("v", "w"), ["w"], unique=True)])
        collected = out.collect()
        assert "skew=true" in plan(out)
        assert len(collected) == 60000
        assert sum(1 for r in collected if r["k"] == "HOT" and r["v"] == 7 and r["w"] == 7) == 20000


def test_rows_without_key_spread_over_partitions(spark):
    with conf(spark, **SMALL_PARTITIONS):
        lone = skewed(spark).where("k is null")
        right = spark.sql("SELECT 'a' AS k, 1 AS v")
        out = joins.left_lookup(lone, right, ["k"]).withColumn("p", F.spark_partition_id())
        sizes = [r[0] for r in out.groupBy("p").count().select("count").collect()]
        assert len(sizes) > 8 and max(sizes) < 0.3 * sum(sizes)


def test_attached_groups_spread_the_heaviest_keys(spark):
    with conf(spark, **SMALL_PARTITIONS):
        out = joins.attach_group(skewed(spark), ["k"], {"n": F.count(F.lit(1))})
        placed = out.withColumn("p", F.spark_partition_id()).where("k = 'HOT'").groupBy("p").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("n")).collect()
        assert sum(r["c"] for r in placed) == 20000 and {r["n"] for r in placed} == {20000}
        assert len(placed) > 8
        out.collect()
        assert "ReusedExchange" in plan(out)


def test_one_row_per_key_is_reduced_before_the_shuffle(spark):
    df = keep.latest_per_key(skewed(spark), ["k"], ["id"])
    text = plan(df)
    assert text.count("WindowGroupLimit") == 2
    assert {r["k"]: r["id"] for r in df.collect()}["HOT"] == 59997


def test_item_texts_are_combined_before_the_shuffle(spark):
    df = skewed(spark).withColumn("item", (F.col("id") % 4).cast("string"))
    out = groups.join_all(df, ["k"], "item", "t")
    assert "partial_count" in plan(out)
    hot = out.where("k = 'HOT'").first()["t"]
    assert hot.count(",") + 1 == 20000


def test_scans_are_pruned_and_filtered(spark):
    t = Tables(spark, FOLDER)
    text = plan(QUERIES["s1_projected_scan"].run(spark, FOLDER))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in text
    recent = QUERIES["s3_scan_since_window"].run(spark, FOLDER)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThanOrEqual(o_orderdate" in recent
    lookup = plan(joins.left_lookup(t.lineitem, t.orders, ["l_orderkey"], ["o_orderkey"], ["o_totalprice"]).select("l_tax", "o_totalprice"))
    assert "l_shipdate" not in lookup and "o_orderpriority" not in lookup


PLANNED = [n for n in QUERIES if n[0] in "afjmuw" and not n.startswith(("m11", "m12"))]


@pytest.mark.parametrize("name", PLANNED)
def test_no_pairwise_join(spark, name):
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(QUERIES[name].run(spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_many_rules_of_one_key(spark):
    """Spans of 200,000 overlapping rules of one key, against a plain sweep with a heap."""
    import heapq

    turn = random.Random(2)
    size = 200_000
    starts = turn.sample(range(40 * 365 * 86_400), size)
    rules = [(s, s + turn.choice([0, 60, 3600, 86_400, 40 * 86_400])) for s in starts]
    moment = lambda c: F.timestamp_seconds(F.col(c)).cast("timestamp_ntz")
    right = spark.createDataFrame(rules, "a bigint, b bigint").select(F.lit("k").alias("k"), moment("a").alias("s"), moment("b").alias("e"), F.col("a").alias("n"))
    asked = sorted(turn.sample(range(41 * 365 * 86_400), 3000))
    left = spark.createDataFrame([(t,) for t in asked], "t bigint").select(F.lit("k").alias("k"), moment("t").alias("ts"), "t")
    got = {r["t"]: r["n"] for r in joins.interval_join(left, right, ["k"], "ts", "s", "e", ["n"]).collect()}
    ahead, heap, want = sorted(rules), [], {}
    at = 0
    for t in asked:
        while at < size and ahead[at][0] <= t:
            heapq.heappush(heap, (-ahead[at][0], ahead[at][1]))
            at += 1
        while heap and heap[0][1] < t:
            heapq.heappop(heap)
        want[t] = -heap[0][0] if heap else None
    assert got == want
    assert sum(n is None for n in want.values()) < 3000


def test_one_key_with_all_rows_becomes_many_parts(spark):
    df = spark.range(0, 40_000, 1, 16).select(F.lit("HOT").alias("k"), F.concat(F.lit("item "), F.col("id") % 9_000).alias("item"), (F.col("id") % 7 == 0).alias("same"))
    df = df.withColumn("item", F.when(F.col("same"), F.lit("the same")).otherwise(F.col("item")))
    with conf(spark, **SMALL_PARTITIONS):
        out = groups.joined_parts(df, ["k"], "item", "text", limit=3000)
        parts = out.orderBy("part").collect()
        placed = out.withColumn("p", F.spark_partition_id()).select("p").distinct().count()
    whole = groups.join_all(df, ["k"], "item", "text").first()["text"]
    assert ",".join(r["text"] for r in parts) == whole
    assert [r["part"] for r in parts] == list(range(len(parts))) and len(parts) > 100
    assert max(len(r["text"]) for r in parts) <= 6000
    assert placed > 4


def test_parts_of_long_items_nulls_and_odd_separators(spark):
    rows = [("a", "x" * 50), ("a", "y"), ("a", "y"), ("a", None), ("b", None), (None, "z"), ("c", ""), ("c", "")] + [("a", "w" * 30)] * 5
    df = spark.createDataFrame(rows, "k string, i string")
    for sep, limit in ((",", 20), ("", 7), (" | ", 1), (",", 1000)):
        got = groups.joined_parts(df, ["k"], "i", "t", sep, limit=limit).orderBy("k", "part").collect()
        want = {r["k"]: r["t"] for r in groups.join_all(df, ["k"], "i", "t", sep).collect()}
        for k in ("a", "c"):
            assert sep.join(r["t"] for r in got if r["k"] == k) == want[k]
            assert [r["part"] for r in got if r["k"] == k] == list(range(sum(r["k"] == k for r in got)))
        assert {r["k"] for r in got} == {"a", "c"}
    once = groups.joined_parts(df, ["k"], "i", "t", distinct_items=True).collect()
    assert {r["k"]: r["t"] for r in once} == {"a": ",".join(["w" * 30, "x" * 50, "y"]), "c": ""}
    assert groups.joined_parts(df.limit(0), ["k"], "i", "t").count() == 0


def _final_parts(spark):
    """Two sales (one twice, one that knows no more than a pseudo sale), pseudo sales and a transfer."""
    many = ", ".join(f"c{i} double" for i in range(30))
    known, lost = tuple(float(i) for i in range(30)), (None,) * 30
    day = "timestamp_ntz'1998-05-06 00:00:00'"
    sold = spark.createDataFrame([("V1", "A", "s", "t", 1.0, *known)] * 2 + [(V.USED_CAR, "B", V.USED_CAR, V.USED_CAR, 7.0, *lost)], f"vin string, store string, series string, team string, unit_profit double, {many}")
    sold = sold.withColumns({"sale_date": F.expr(day), "used_rebate": F.lit(None).cast("double")})
    used = spark.createDataFrame([(V.USED_CAR, "B", V.USED_CAR, V.USED_CAR, 7.0)] * 3 + [(V.USED_CAR, "B", V.USED_CAR, V.USED_CAR, 8.0)], "vin string, store string, series string, team string, unit_profit double")
    used = used.withColumns({"receipt_date": F.expr(day), "used_rebate": F.lit("7")})
    moved = spark.createDataFrame([("V1", "C", "调拨车", "其他", 3.0)], "vin string, store string, series string, team string, unit_profit double").withColumn("sale_date", F.expr(day))
    return sold, used, moved


def test_final_sales_group_pseudo_sales_as_short_rows(spark):
    """Most rows of the final table are pseudo sales; the columns only sales know are one record in the groups."""
    sold, used, moved = _final_parts(spark)
    out = sales.sales_final(sold, used, moved)
    assert out.count() == out.distinct().count() == 5
    aggregates = [line for line in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate [" in line]
    assert len(aggregates) == 1 and "c29" not in aggregates[0].split("], [")[0]
    some = sales.sales_final(sold, used, moved, columns=["store", "vin"])
    assert sorted(some.collect()) == [("A", "V1"), ("B", V.USED_CAR), ("C", "V1")]


def test_sparse_distinct_gives_the_rows_of_distinct(spark):
    rows = [(a, b, c) for a in (None, 1) for b in (None, "x", "y") for c in (None, 0.0, -0.0, float("nan"))] * 2
    df = spark.createDataFrame(rows, "a int, b string, c double")
    for shared in ([], ["a"], ["a", "b"], ["c"], ["a", "b", "c"]):
        got = keep.distinct_sparse(df, shared)
        assert got.columns == df.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, df.distinct().collect()))


def test_exported_sales_compare_only_pseudo_sales_as_a_whole(spark):
    """An ordinary sale is the last of its key anyway: its rows are not grouped by every column before."""
    sold, used, moved = _final_parts(spark)
    final = sales.sales_final(sold, used, moved).unionByName(sales.sales_final(sold, used, moved))
    paid = spark.createDataFrame([], "store string, first_receipt string")
    shown, _, _ = sales.export_tables(final, paid, ["team", "store"], ["unit_profit"], "1998-01-01")
    assert sorted((r["vin"], r["store"], r["unit_profit"]) for r in shown.collect()) == [("V1", "A", 1.0), ("V1", "C", 3.0), (V.USED_CAR, "B", 7.0), (V.USED_CAR, "B", 7.0), (V.USED_CAR, "B", 8.0)]
    direct, _, _ = sales.export_tables(sold.withColumn("receipt_date", F.col("sale_date")), paid, ["team", "store"], ["unit_profit"], "1998-01-01")
    below = direct._jdf.queryExecution().optimizedPlan().toString().split("Window [")[1:]
    assert len(below) == 1 and "Aggregate" not in below[0]


def _shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    return {b for b in blocks.split() if b.startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    """What a write has shuffled is deleted as it ends, and the setting is the one before; the rows can be read again."""
    from motorledger.session import _DROP_SHUFFLES, written

    df = spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count()
    before, old = _shuffle_files(spark), spark.conf.get(_DROP_SHUFFLES)
    kept = written(df, "numbers")
    left = _shuffle_files(spark) - before
    for _ in range(50):
        if left:
            time.sleep(0.2)
            left = _shuffle_files(spark) - before
    assert not left and spark.conf.get(_DROP_SHUFFLES) == old
    assert sorted(kept.collect()) == sorted(df.collect()) == sorted(df.collect())


def test_tiebreaks_behind_the_shown_columns_are_not_read(spark):
    rng = random.Random(5)
    rows = [tuple(rng.choice((None, 0, 1)) for _ in range(6)) + (rng.choice((0.0, -0.0, 1.0)),) for _ in range(400)]
    df = spark.createDataFrame(rows, "a int, k int, b int, t int, c int, d int, x double")
    for shown in (["k", "t"], ["k", "a"], ["b", "k", "t"], ["c"], ["k", "b", "x"], ["d", "a", "t", "k"]):
        for pick in (keep.first_per_key, keep.last_per_key):
            got, want = pick(df, ["k"], ["t"], shown), pick(df, ["k"], ["t"]).select(*shown)
            assert got.columns == shown and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    read = keep.last_per_key(df, ["k"], ["t"], ["k", "b"])._jdf.queryExecution().optimizedPlan().toString()
    assert "a#" in read and "b#" in read and not any(f"{c}#" in read.split("LogicalRDD")[0] for c in ("c", "d", "x"))


def _joined_parts(spark):
    """Sales with orders and stock: some twice, some without a number, some as little known as pseudo sales and transfers."""
    day = "timestamp_ntz'1998-05-06 00:00:00'"
    sold, used, moved = _final_parts(spark)
    bare = spark.createDataFrame([("V1", "C", "调拨车", "其他", 3.0, *[None] * 30), (None, "N", "s", "t", 4.0, *[1.0] * 30), (None, "N", "s", "t", 4.0, *[1.0] * 30)], sold.drop("sale_date", "used_rebate").schema)
    bare = bare.withColumns({"sale_date": F.expr(day), "used_rebate": F.lit(None).cast("double")})
    few = spark.createDataFrame([("V9", "D", "s", "t", 5.0, *[None] * 30)] * 2, sold.drop("sale_date", "used_rebate").schema)
    few = few.withColumns({"sale_date": F.expr(day), "used_rebate": F.lit(None).cast("double")})
    booked = spark.createDataFrame([("V1", "I1", 1), ("V1", "I2", 2), ("V9", "I9", 1)], "vin string, id_number string, order_date int")
    homes = spark.createDataFrame([("V2", "H", "S", "E")], "vin string, source_store string, supplier string, engine_no string")
    return sold.unionByName(bare).unionByName(few), used, moved, booked, homes


def test_final_sales_kept_in_parts_are_the_same_rows(spark):
    """Equal sales already lie together behind the joins: their distinct adds no shuffle, and the parts hold the rows of the whole."""
    sold, *parts, booked, homes = _joined_parts(spark)
    rows = lambda df: sorted(map(str, df.collect()))
    # rows without a number that become equal by their date, which the spread of such rows is made of
    late = sold.where("vin IS NULL").withColumns({"receipt_date": F.col("sale_date"), "sale_date": F.lit(None).cast("timestamp_ntz")})
    dated = sold.withColumn("receipt_date", F.col("sale_date")).unionByName(late)
    for some in (sold, dated.select("sale_date", *[c for c in dated.columns if c != "sale_date"])):
        kept = {}
        out = sales.sales_final(some, *parts, booked, homes, keep=lambda df, name: kept.setdefault(name, df))
        want = sales.sales_final(some, *parts, booked, homes)
        assert out.columns == want.columns and out.schema.simpleString() == want.schema.simpleString()
        assert rows(out) == rows(want) and want.count() == want.distinct().count()
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        top, below = str(kept["final-sales"].select("*")._jdf.queryExecution().executedPlan()).split("SortMergeJoin", 1)
    assert "HashAggregate" in top and "Exchange" not in top and "Exchange" in below


def test_export_of_some_columns_reads_no_tiebreak_behind_them(spark):
    sold, used, moved, booked, homes = _joined_parts(spark)
    final = sales.sales_final(sold, used, moved, booked, homes)
    twin = sold.where("vin = 'V1'").withColumns({"store": F.lit("Z"), "c3": F.lit(-1.0)})
    final = final.unionByName(sales.sales_final(twin, used, moved, booked, homes))
    paid = spark.createDataFrame([], "store string, first_receipt string")
    cols = ["vin", "store", "team", "sale_date"]
    whole = sales.export_tables(final, paid, ["team", "store"], ["unit_profit"], "1998-01-01")
    some = sales.export_tables(final, paid, ["team", "store"], ["unit_profit"], "1998-01-01", cols)
    for a, b in ((whole[0], some[0]), (whole[2], some[2])):
        assert b.columns == cols
        assert sorted(map(str, a.select(*cols).distinct().collect())) == sorted(map(str, b.distinct().collect()))
    direct = sales.export_tables(sold.withColumn("receipt_date", F.col("sale_date")), paid, ["team", "store"], ["unit_profit"], "1998-01-01", cols)[0]
    ordered = direct._jdf.queryExecution().optimizedPlan().toString().split("Window [")[1].split("LogicalRDD")[0]
    assert "c29#" not in ordered


def test_used_cars_without_a_number_are_not_dealt_to_the_lookup(spark):
    day = "timestamp_ntz'1998-05-06 00:00:00'"
    rows = [("V1", "b"), ("V1", "b"), ("V2", "b"), ("V2", "B1"), ("", "b"), ("", "B1"), (None, "b"), (None, None), ("V3", None)]
    used = spark.createDataFrame([(v, b, "A", "9", "S", "M", V.RECEIVED) for v, b in rows], "trade_in_vin string, buyer string, store string, other_fee string, lead_by string, model string, receipt_state string")
    used = used.withColumns({"deal_price": F.lit(1.0), "receipt_date": F.expr(day)})
    invoices = spark.createDataFrame([("V1", "I"), ("V3", None), ("", "I")], "vin string, invoice_store string").withColumn("download_time", F.expr(day))
    loose, traded = sales.used_car_parts(used, invoices, ["B1"])
    # V1 has an invoice; V2 has none, the store of V3's is not known, and four have no number
    assert sorted(str(r["buyer"]) for r in loose.collect()) == ["None", "None", "b", "b", "b"] and traded.count() == 5
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        plan = str(loose.select("*")._jdf.queryExecution().executedPlan())
    assert plan.split("SortMergeJoin")[0].count("Exchange") == 0 and "Union" in plan.split("SortMergeJoin")[0]
