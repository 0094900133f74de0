"""Files in, files out: header drift, envelopes, versions, buckets, streams."""

import json
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorledger.operators.documents import collect_json_keys, mask_json_keys
from motorledger.session import cut_lineage
from motorledger.sources import ledgers, pages, sinks, tables
from motorledger.streaming import stream_deletes, stream_upsert


def test_ledger_headers_drift(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text('"Store ",Amount\nS1,5\n"S,2",6\n', encoding="utf-8")
    (tmp_path / "b.x.csv").write_text("amount,store,Note\n7,S3,n\n", encoding="utf-8")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.csv").write_text("﻿Store,Store,\nS4,dup,\n", encoding="utf-8")
    (tmp_path / "empty.csv").write_text("", encoding="utf-8")
    df = ledgers.read_ledger_dir(spark, str(tmp_path), ["store", "amount", "vin"])
    got = rows(df, "store", "amount", "vin", "from_file")
    assert got == [("S,2", "6", None, "a"), ("S1", "5", None, "a"), ("S3", "7", None, "b"), ("S4", None, None, "c")]


def test_no_ledger_files(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("", encoding="utf-8")
    df = ledgers.read_ledger_dir(spark, str(tmp_path), ["store"])
    assert df.columns == ["store", "from_file"] and df.count() == 0


def test_pages(spark, rows):
    bodies = [
        {"Msg": {"Model": [{"id": 1}, {"id": 2}]}}, {"Msg": {"Model": {"list": [{"id": 3}]}}}, {"Msg": {"Model": {"items": [{"id": 4}]}}},
        {"Data": [{"id": 5, "x": {"y": "z"}}]}, {"Data": {"list": [{"id": 6}]}}, {"Data": {"items": []}}, {"Data": {"other": 1}}, {"Msg": {}},
    ]
    df = spark.createDataFrame([(json.dumps(b),) for b in bodies] + [("not json",), (None,)], "body string")
    out = pages.explode_pages(df, "body", "struct<id: bigint, x: struct<y: string>>")
    assert rows(out.select("id", F.col("x.y").alias("y"))) == [(1, None), (2, None), (3, None), (4, None), (5, "z"), (6, None)]


def test_replace_publishes_whole_versions(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    assert sinks.write_replace(df, path) == 3
    assert sinks.write_replace(df.limit(0), path) == 0
    assert sinks.read_current(spark, path).count() == 3
    # reading the current content while writing the next one
    assert sinks.write_replace(sinks.read_current(spark, path).where("id > 0"), path) == 2
    (tmp_path / "t" / "v=9").mkdir()  # a run that never finished
    assert rows(sinks.read_current(spark, path)) == [(1,), (2,)]
    report = rows(sinks.truncate_tables(spark, [path, str(tmp_path / "none")]), "result")
    assert report == [("failed",), ("ok",)] and sinks.read_current(spark, path).count() == 0


def test_keyed_table_rewrites_touched_buckets_only(spark, rows, tmp_path):
    path = str(tmp_path / "k")
    sinks.create_keyed(spark.range(40).select("id", F.lit("a").alias("x")), path, "id", 8)
    before = {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in (tmp_path / "k").glob("bucket=*")}
    batch = spark.createDataFrame([(3, "b")], "id bigint, x string")
    sinks.upsert_table(batch, path, "id", buckets=8)
    after = {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in (tmp_path / "k").glob("bucket=*")}
    assert sum(before[b] != after[b] for b in before) == 1
    assert sinks.read_keyed(spark, path).where("x = 'b'").count() == 1 and sinks.read_keyed(spark, path).count() == 40


def test_delete_can_empty_a_bucket(spark, tmp_path):
    path = str(tmp_path / "d")
    sinks.create_keyed(spark.range(20), path, "id", 4)
    ids = spark.range(20).select(F.col("id").cast("string").alias("_id")).where("_id <> '7'")
    sinks.delete_rows(spark, path, ids, "id", "id", 4)
    assert [r[0] for r in sinks.read_keyed(spark, path).collect()] == [7]
    sinks.delete_rows(spark, path, ids, "id", "id", 4)
    assert sinks.read_keyed(spark, path).count() == 1


def test_streams_are_incremental_and_idempotent(spark, rows, tmp_path):
    landed, table, check = (str(tmp_path / n) for n in ("landed", "table", "check"))
    schema = "id bigint, v string, ts timestamp_ntz"

    def land(*data):
        spark.createDataFrame(list(data), schema).write.mode("append").json(landed)
        stream_upsert(spark.readStream.schema(schema).json(landed), table, "id", "ts", check, 4).awaitTermination()

    land((1, "a", datetime(2025, 1, 2)), (2, "b", datetime(2025, 1, 1)))
    land((1, "late", datetime(2025, 1, 1)), (2, "newer", datetime(2025, 1, 3)), (None, "x", datetime(2025, 1, 3)))
    assert rows(sinks.read_keyed(spark, table), "id", "v") == [(1, "a"), (2, "newer")]
    spark.createDataFrame([("gone", '{"Logo_IdOrCode": "2, 5"}')], "title string, contents string").write.json(str(tmp_path / "log"))
    log = spark.readStream.schema("title string, contents string").json(str(tmp_path / "log"))
    stream_deletes(log, {"t": table, "none": str(tmp_path / "none")}, {"gone": ["t", "none"]}, {"t": "id", "none": "id"}, str(tmp_path / "c2"), 4).awaitTermination()
    assert rows(sinks.read_keyed(spark, table), "id", "v") == [(1, "a")]


def test_save_modes_and_report(spark, rows, tmp_path):
    schema = T.StructType.fromDDL("id bigint, a string, b string")
    conf = sinks.TableConf(str(tmp_path / "s"), schema, "id", [], "replace", 4)
    sinks.save(conf, spark.createDataFrame([("1", "x", "y")], "id string, a string, b string"))
    sinks.save(conf, spark.createDataFrame([("1", "z"), ("2", "w")], "id string, a string"))
    assert rows(sinks.read_keyed(spark, conf.path).select("id", "a", "b")) == [(1, "z", None), (2, "w", None)]


def test_scan_helpers(spark, rows, tmp_path):
    df = spark.range(1000).withColumn("day", F.lit("2025-01-05").cast("timestamp_ntz"))
    assert tables.scan_in(df, {"id": range(0, 500)}).count() == 500
    assert tables.scan_in(df, {"id": [1, 2, 5000]}).count() == 2
    assert tables.scan_since(df, "day", as_of=datetime(2025, 1, 12)).count() == 1000
    assert tables.scan_since(df, "day", as_of=datetime(2025, 1, 13)).count() == 0
    path = str(tmp_path / "docs")
    df.drop("day").write.json(path)
    assert tables.read_documents(spark, path, "id bigint", ["id", "gone"], F.col("id") > 4, 3).count() == 3
    assert [r[0] for r in tables.month_partitions(spark, "2024-11-30", "2025-01-01").collect()] == ["202411", "202412", "202501"]


def test_json_masking_and_collecting(spark):
    body = {"Token": "t", "api_key": 1, "apikeys": 2, "deep": [{"user_password": {"a": 1}, "long": "x" * 201}], "text": '{"token": "q"}'}
    df = spark.createDataFrame([(json.dumps(body),), ("plain",), (None,)], "b string")
    masked = [r[0] for r in df.select(mask_json_keys("b", ["token", "key", "password"])).collect()]
    got = json.loads(masked[0])
    assert got["Token"] == got["api_key"] == got["deep"][0]["user_password"] == "*****"
    assert got["apikeys"] == 2 and got["text"] == {"token": "*****"} and got["deep"][0]["long"].startswith("x" * 200 + "... ")
    assert masked[1:] == ["plain", None]
    nested = spark.createDataFrame([('{"id": 1, "l": [{"id": 1}], "n": [{"v": 2}, {"v": 3}]}',), ("bad",)], "b string")
    found = [r[0] for r in nested.select(collect_json_keys("b", ["id", "v", "none"])).collect()]
    assert found == [{"id": "1", "v": "[2,3]"}, {}]


def test_checkpoint_keeps_rows(spark):
    df = cut_lineage(spark.range(5).withColumn("x", F.col("id") * 2))
    assert df.count() == 5 and "Scan ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
