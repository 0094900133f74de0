"""Operators on hand-made frames: null keys, ties, copies, repeated runs, partitions."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorledger.operators import columns, deletes, groups, joins, keep, quality, reshape, rows as R, unions, upserts


def at(day):
    return datetime(2025, 1, 1) + timedelta(days=day)


def test_left_lookup_never_matches_null_keys(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "id int, k string")
    right = spark.createDataFrame([("a", 10), (None, 20), ("", 30)], "k string, v int")
    assert rows(joins.left_lookup(left, right, ["k"])) == [(1, "a", 10), (2, None, None), (3, "", 30)]
    assert rows(joins.left_lookup(left, right, ["k"], null_safe=True), "id", "v") == [(1, 10), (2, 20), (3, 30)]
    with pytest.raises(ValueError):
        joins.left_lookup(left, right.withColumn("id", F.lit(1)), ["k"])


def test_anti_keeps_rows_without_key(spark, rows):
    left = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    right = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(joins.anti(left, right, "k")) == [(None,), ("b",)]
    assert rows(joins.semi(left, right, "k")) == [("a",)]


def test_star_join_does_not_fan_out(spark, rows):
    fact = spark.createDataFrame([("v1",), ("v2",), (None,)], "vin string")
    dup = spark.createDataFrame([("v1", 1, at(1)), ("v1", 2, at(2)), ("v1", 3, None), (None, 9, at(9))], "vin string, x int, d timestamp_ntz")
    out = joins.star_join(fact, "vin", [joins.Lookup(dup, ["x", "absent"], ["d"]), joins.Lookup(None, ["y"])])
    assert rows(out) == [(None, None), ("v1", 2), ("v2", None)]


def test_latest_per_key_ties_and_nulls(spark, rows):
    df = spark.createDataFrame([("a", at(1), 2), ("a", at(1), 1), ("a", None, 0), (None, at(5), 7), ("b", None, 4)], "k string, d timestamp_ntz, x int")
    for parts in (1, 7):
        assert rows(keep.latest_per_key(df.repartition(parts), ["k"], ["d"]), "k", "x") == [(None, 7), ("a", 1), ("b", 4)]


def test_allocate_once_with_copies(spark, rows):
    data = [("s", 1, 5.0)] * 3 + [("s", 2, 5.0), ("t", 1, None), (None, 3, 4.0), (None, 4, 4.0)]
    df = spark.createDataFrame(data, "store string, n int, cost double")
    for parts in (1, 5):
        got = rows(keep.allocate_once(df.repartition(parts), ["store"], "cost", ["n"]))
        assert got == [(None, 3, 4.0), (None, 4, 0.0), ("s", 1, 0.0), ("s", 1, 0.0), ("s", 1, 5.0), ("s", 2, 0.0), ("t", 1, None)]


def test_prefer_rows(spark, rows):
    df = spark.createDataFrame([(1, 0), (1, 4), (2, 0), (2, 0), (None, 3)], "id int, out_id int")
    assert rows(R.prefer_rows(df, "id", F.col("out_id") != 0)) == [(1, 4), (2, 0), (2, 0)]


def test_dedupe_except_keeps_pseudo_rows(spark, rows):
    df = spark.createDataFrame([("p", 1), ("p", 2), ("v", 1), ("v", 2)], "vin string, n int")
    assert rows(keep.dedupe_except(df, F.col("vin") == "p", ["vin"], ["n"])) == [("p", 1), ("p", 2), ("v", 2)]


def test_upsert_rules(spark, rows):
    target = spark.createDataFrame([(1, "old", "keep"), (2, "old", "keep")], "id int, a string, b string")
    batch = spark.createDataFrame([(2, "first", 1, 0), (2, None, 2, 0), (3, "new", 1, 0), (None, "x", 1, 0)], "id int, a string, n int, alien int")
    once = upserts.upsert(target, batch, "id", ["n"])
    assert rows(once) == [(1, "old", "keep"), (2, None, "keep"), (3, "new", None)]
    assert rows(upserts.upsert(once, batch, "id", ["n"])) == rows(once)
    assert rows(upserts.replace_rows(target, batch, "id", ["n"])) == [(1, "old", "keep"), (2, None, None), (3, "new", None)]


def test_latest_then_upsert_is_independent_of_input_order(spark, rows):
    target = spark.createDataFrame([("v", 1, "t0", 5.0)], "vin string, id int, create_time string, fee double")
    data = [("v", 2, "t1", 1.0, "2025-01-01"), ("v", 3, "t2", 2.0, "2025/01/03"), ("v", 4, "t3", 3.0, "bad"), ("w", 5, "t4", 4.0, None), (None, 6, "t5", 9.0, None)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        batch = spark.createDataFrame(data, "vin string, id int, create_time string, fee double, ts string")
        assert rows(upserts.latest_then_upsert(target, batch, "vin", "ts")) == [("v", 1, "t0", 2.0), ("w", 5, "t4", 4.0)]


def test_merge_latest_ignores_late_older_rows(spark, rows):
    target = spark.createDataFrame([("v", 1, at(5))], "k string, x int, ts timestamp_ntz")
    batch = spark.createDataFrame([("v", 2, at(1)), ("w", 3, at(1))], "k string, x int, ts timestamp_ntz")
    assert rows(upserts.merge_latest(target, batch, "k", "ts"), "k", "x") == [("v", 1), ("w", 3)]


def test_interval_join_against_brute_force(spark, rows):
    rng = random.Random(3)
    facts = [(i, rng.choice("ab"), at(rng.randrange(1500))) for i in range(200)] + [(900, None, at(1)), (901, "a", None)]
    rules = []
    for n in range(40):
        start = rng.randrange(1500)
        rules.append((rng.choice("ab"), at(start), at(start + rng.choice([0, 3, 400, 90000])), n))
    left = spark.createDataFrame(facts, "id int, k string, ts timestamp_ntz")
    right = spark.createDataFrame(rules, "k string, s timestamp_ntz, e timestamp_ntz, n int")
    expected = []
    for i, k, ts in facts:
        hits = [(s, e, n) for kk, s, e, n in rules if kk == k and ts is not None and s <= ts <= e]
        expected.append((i, max(hits)[2] if hits else None))
    got = joins.interval_join(left, right, ["k"], "ts", "s", "e", ["n"])
    assert rows(got, "id", "n") == sorted(expected, key=lambda r: r[0])
    narrow = joins.interval_join(left, right, ["k"], "ts", "s", "e", ["n"], first_year=2026, last_year=2027)
    assert rows(narrow, "id", "n") == rows(got, "id", "n")


@pytest.mark.parametrize("bucket_days", [1, 30])
def test_asof_lookup_against_brute_force(spark, rows, bucket_days):
    rng = random.Random(5)
    when = lambda: at(0) + timedelta(hours=rng.randrange(24 * 90))
    facts = [(i, rng.choice("aab"), when()) for i in range(300)] + [(900, None, at(1)), (901, "a", None), (902, "z", at(5))]
    marks = [(rng.choice("ab"), when(), n) for n in range(60)] + [(None, at(0), 99)]
    left = spark.createDataFrame(facts, "id int, k string, ts timestamp_ntz")
    right = spark.createDataFrame(marks, "k string, s timestamp_ntz, n int")
    expected = []
    for i, k, ts in facts:
        hits = [(s, n) for kk, s, n in marks if kk is not None and kk == k and ts is not None and s <= ts]
        expected.append((i, max(hits)[1] if hits else None))
    got = joins.asof_lookup(left.repartition(5), right, ["k"], "ts", "s", ["n"], bucket_days)
    assert rows(got, "id", "n") == sorted(expected, key=lambda r: r[0])


def test_stack_keys_prefers_earlier_columns(spark, rows):
    df = spark.createDataFrame([("a", "b", None, 2), ("c", "a", "b", 1)], "p string, s string, c string, d int")
    assert rows(joins.stack_keys(df, ["p", "s", "c"], "d", "id")) == [("a", 2), ("b", 2), ("c", 1)]


def test_prefer_merge(spark, rows):
    left = spark.createDataFrame([("a", 0.0), ("b", 2.0), ("c", None), ("d", 0.0)], "k string, q double")
    right = spark.createDataFrame([("a", 5.0), ("b", 6.0), ("c", None)], "k string, q double")
    assert rows(joins.prefer_merge(left, right, ["k"], ["q"])) == [("a", 5.0), ("b", 2.0), ("c", None), ("d", 0.0)]


def test_qualify_store(spark, rows):
    df = spark.createDataFrame([("直播基地", "S1"), ("直播基地", "S9"), ("直播基地", None), ("X", "S1")], "store string, series string")
    dim = spark.createDataFrame([("S1", "N1"), ("S1", "N1")], "series string, network string")
    assert rows(joins.qualify_store(df, dim, "store", "series")) == [("N1-直播基地", "S1"), ("X", "S1"), ("直播基地", None), ("直播基地", "S9")]


def test_texts_per_group(spark, rows):
    df = spark.createDataFrame([("a", "y", 2.0), ("a", "x", 1.5), ("a", "y", 2.0), ("a", None, 1.0), (None, "z", 1.0), ("b", None, 3.0)], "k string, i string, q double")
    for parts in (1, 6):
        d = df.repartition(parts)
        assert rows(groups.join_all(d, ["k"], "i", "t")) == [("a", "x,y,y"), ("b", "")]
        assert rows(groups.group_items(d, ["k"], groups.item_text("i", "q"), "t", {"s": F.col("q")})) == [("a", 6.5, "x*1.5,y*2,y*2"), ("b", 3.0, "")]
        assert rows(groups.group_agg(d, ["k"], {"t": groups.join_distinct("i")})) == [("a", "x,y"), ("b", "")]


def test_group_sum_and_first_known(spark, rows):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("b", 2.0, None), (None, 5.0, 3)], "k string, x double, o int")
    assert rows(groups.group_sum(df, ["k"], ["x"])) == [("a", 0.0), ("b", 2.0)]
    assert rows(groups.group_agg(df, ["k"], {"f": groups.first_known("o", ["o"])})) == [("a", 1), ("b", None)]


def test_attach_group_leaves_keyless_rows_without_group(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 9)], "k string, x int")
    assert rows(joins.attach_group(df, ["k"], {"top": F.max("x")})) == [(None, 9, None), ("a", 1, 2), ("a", 2, 2)]


def test_schema_operators(spark, rows):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    got, missing = columns.select_existing(df, ["c", "x", "a"])
    assert got.columns == ["c", "a"] and missing == ["x"]
    doubled = df.toDF("a", "b", "a")
    assert rows(columns.dedupe_columns(doubled)) == [(1, 2)]
    nested = spark.createDataFrame([((1, {"k": 1}, [1]),)], "r struct<x: int, m: map<string,int>, l: array<int>>")
    assert columns.flatten_struct(nested).columns == ["r_x", "r_m", "r_l"]


def test_conform(spark, rows):
    raw = spark.createDataFrame([("1.0", "null", "2025/3/1", ["a"], "x"), ("7", "1.5", "", None, "y")], "n string, d string, t string, l array<string>, extra string")
    out = columns.conform(raw, T.StructType.fromDDL("n int, d double, t timestamp_ntz, l string, absent int"))
    assert out.columns == ["n", "d", "t", "l"]
    assert rows(out) == [(None, None, datetime(2025, 3, 1), '["a"]'), (7, 1.5, None, None)]


def test_union_types_meet(spark, rows):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([(2.5, 7)], "n double, t int")
    assert rows(unions.union_outer(a, b)) == [(1.0, "x", None), (2.5, None, 7)]


def test_cutover_union_neither_loses_nor_doubles(spark, rows):
    data = [(i, at(i), "x" if i % 2 else "y") for i in range(6)]
    df = spark.createDataFrame(data, "id int, d timestamp_ntz, area string")
    cut = "2025-01-04"
    both = unions.union_at_cutover(df.withColumn("side", F.lit("new")), df.withColumn("side", F.lit("old")), "d", cut)
    assert rows(both, "id", "side") == [(0, "old"), (1, "old"), (2, "old"), (3, "new"), (4, "new"), (5, "new")]
    wide = unions.union_at_cutover(df.limit(0), df, "d", cut, F.col("area") == "x")
    assert rows(wide, "id") == [(0,), (1,), (2,), (3,), (5,)]


def test_reshape(spark, rows):
    wide = spark.createDataFrame([("s", 1.0, 2.0, 3.0)], "`store` string, `1月得分` double, `2月得分` double, `2月折让系数` double")
    out = reshape.melt_families(wide, "store", {"score": "得分", "factor": "折让系数"})
    assert rows(out) == [("s", "1月", 1.0, None), ("s", "2月", 2.0, 3.0)]
    ids = spark.createDataFrame([(" 1, ,2,",), (None,), ("",)], "ids string")
    assert rows(reshape.explode_ids(ids, "ids", "id"), "id") == [("1",), ("2",)]


def test_deletes_are_idempotent_and_follow_titles(spark, rows):
    log = spark.createDataFrame(
        [("drop order", '{"Logo_IdOrCode": "1, 3", "Arr": []}'), ("drop order", "oops"), ("删除装饰出库数据", '{"Logo_IdOrCode": 8}'), ("unknown", '{"Logo_IdOrCode": "2"}')],
        "title string, contents string",
    )
    tables = {"orders": spark.createDataFrame([(1,), (2,), (3,), (None,)], "code int"), "decor": spark.createDataFrame([(1, 8), (2, 9)], "id int, out_id int"), "plain": spark.createDataFrame([(1,)], "x int")}
    titles = {"drop order": ["orders", "plain"], "删除装饰出库数据": ["decor"]}
    keys = {"orders": "code", "decor": "id", "plain": "code"}
    once = deletes.apply_deletes(tables, log, titles, keys)
    assert rows(once["orders"]) == [(None,), (2,)] and rows(once["decor"]) == [(2, 9)] and rows(once["plain"]) == [(1,)]
    twice = deletes.apply_deletes(once, log, titles, keys)
    assert rows(twice["orders"]) == rows(once["orders"])
    report = rows(deletes.delete_report(tables, log, titles, keys))
    assert report == [("decor", 2, 1), ("delete_log", 4, 0), ("orders", 4, 2), ("plain", 1, 0)]


def test_row_rules(spark, rows):
    df = spark.createDataFrame(
        [(1, "13", "bad", "A B1234"), (2, "3", "2025/1/2", "AB12 34"), (3, None, None, "A-1234"), (4, "3.0", "2025-01-01", "12345")],
        "row int, month string, d string, vin string",
    ).withColumn("f", F.lit("f"))
    rules = [quality.month_rule("month"), quality.date_rule("d"), quality.vin_rule("vin"), quality.text_rule("absent")]
    assert rows(quality.check_rows(df, "f", "row", rules), "row", "rule") == [(1, "date"), (1, "month"), (3, "date"), (3, "month"), (3, "vin"), (4, "month"), (4, "vin")]
    long_vin = quality.check_rows(df, "f", "row", [quality.vin_rule("vin", exact=None)])
    assert rows(long_vin, "row", "rule") == [(3, "full_vin"), (4, "full_vin")]
    order = spark.createDataFrame([(1, "2025/1/2", "2025-01-02"), (2, "2025/1/1", "2025-01-02"), (3, "bad", "2025-01-02"), (4, None, "x")], "row int, a string, b string").withColumn("f", F.lit("f"))
    assert rows(quality.check_rows(order, "f", "row", [], ("a", "b")), "row") == [(1,)]
