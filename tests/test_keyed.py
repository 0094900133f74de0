"""Keyed tables: whole batches or none, any split into batches, growth, cleaning."""

from datetime import datetime
from itertools import permutations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorledger.sources import keyed, sinks

SCHEMA = "id bigint, v string, ts timestamp_ntz"


def at(day):
    return datetime(2025, 1, day) if day else None


def table_rows(spark, path):
    return sorted(tuple(r) for r in keyed.read_keyed(spark, path).select("id", "v").collect())


class Killed(Exception):
    pass


@pytest.mark.parametrize("step", ["_staged", "_numbers", "_write", "written", "_publish", "draft", "published"])
@pytest.mark.parametrize("change", ["upsert", "delete"])
def test_a_killed_driver_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step, change):
    path = str(tmp_path / "t")
    keyed.create_keyed(spark.range(30).select("id", F.lit("a").alias("v")), path, "id", 4)
    old = table_rows(spark, path)
    batch = spark.range(20, 40).select("id", F.lit("b").alias("v"))
    gone = spark.range(5).select(F.col("id").cast("string").alias("_id"))
    run = {"upsert": lambda: keyed.upsert_table(batch, path, "id", buckets=4), "delete": lambda: keyed.delete_rows(spark, path, gone, "id", "id", 4)}[change]
    new = sorted({**dict(old), **{i: "b" for i in range(20, 40)}}.items()) if change == "upsert" else old[5:]

    def dying(name, after=False):
        real = getattr(keyed, name)

        def run_and_die(*args, **more):
            if after:
                real(*args, **more)
            raise Killed

        monkeypatch.setattr(keyed, name, run_and_die)

    names = {"written": "_write", "published": "_publish", "draft": "asdict"}  # asdict: in the draft's writing
    dying(names.get(step, step), after=step in ("written", "published"))
    if not (change == "delete" and step == "_staged"):
        with pytest.raises(Killed):
            run()
        assert table_rows(spark, path) == (new if step == "published" else old)
    monkeypatch.undo()
    run()  # the batch is run again, as a scheduler does
    assert table_rows(spark, path) == new


def test_a_failing_task_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.create_keyed(spark.range(30).select("id", F.lit("a").alias("v")), path, "id", 4)
    bad = spark.range(20).select("id", F.when(F.col("id") == 7, F.raise_error(F.lit("bad"))).otherwise(F.lit("b")).cast("string").alias("v"))
    with pytest.raises(Exception, match="bad"):
        keyed.upsert_table(bad, path, "id", buckets=4)
    assert table_rows(spark, path) == [(i, "a") for i in range(30)]


def test_an_interrupted_creation_is_no_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    monkeypatch.setattr(keyed, "_publish", lambda *a: (_ for _ in ()).throw(Killed()))
    with pytest.raises(Killed):
        keyed.upsert_table(spark.range(9), path, "id")
    assert not keyed.is_keyed(spark, path)
    monkeypatch.undo()
    keyed.upsert_table(spark.range(3), path, "id")
    assert keyed.read_keyed(spark, path).count() == 3


def test_a_second_writer_does_not_overwrite_the_first(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.create_keyed(spark.range(3), path, "id", 2)
    mine = keyed.manifest(spark, path)
    keyed.upsert_table(spark.range(9), path, "id", buckets=2)
    with pytest.raises(RuntimeError, match="another writer"):
        keyed._rewrite(spark, path, mine, [0, 1], lambda t: t.limit(0), "id")
    assert keyed.read_keyed(spark, path).count() == 9


def test_any_split_into_batches_gives_the_same_table(spark, tmp_path):
    records = [(1, "b", at(2)), (1, "a", at(2)), (1, None, at(2)), (1, "z", at(1)), (2, "x", None), (2, "y", None), (3, "p", None), (3, "q", at(1)), (4, None, None)]
    found = set()
    for n, order in enumerate(list(permutations(range(len(records))))[::60480]):
        path = str(tmp_path / f"t{n}")
        for first in range(0, len(records), 1 + n):
            part = [records[i] for i in order[first : first + 1 + n]]
            keyed.upsert_table(spark.createDataFrame(part, SCHEMA), path, "id", buckets=2, how="latest", ts="ts")
        found.add(tuple(table_rows(spark, path)))
    assert found == {((1, "a"), (2, "x"), (3, "q"), (4, None))}


def test_buckets_follow_the_size(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(2000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    keyed.create_keyed(rows, path, "id", 2)
    monkeypatch.setattr(keyed, "BUCKET_BYTES", 20_000)
    keyed.upsert_table(rows.where("id = 7").withColumn("v", F.lit("new")), path, "id", buckets=2)
    found = keyed.manifest(spark, path)
    assert (found.declared, found.buckets) == (2, 8) and len(found.folders) == 8
    keyed.delete_rows(spark, path, spark.createDataFrame([("8",), ("none",)], "_id string"), "id", "id", 2)
    got = dict(table_rows(spark, path))
    assert len(got) == 1999 and got[7] == "new" and 8 not in got


def test_old_versions_go_on_request(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.create_keyed(spark.range(10), path, "id", 2)
    before = keyed.read_keyed(spark, path)
    keyed.upsert_table(spark.range(20), path, "id", buckets=2)
    assert before.count() == 10  # a reader of the old version goes on
    assert keyed.read_keyed(spark, path, 1).count() == 10
    assert keyed.clean_keyed(spark, path) == 2 and keyed.versions(spark, path) == [2]
    assert keyed.read_keyed(spark, path).count() == 20
    plain = str(tmp_path / "p")
    for n in (1, 2, 3):
        sinks.write_replace(spark.range(n), plain)
    assert sinks.clean_versions(spark, plain, 2) == 1 and sinks.read_current(spark, plain).count() == 3


def test_an_empty_batch_and_columns_a_table_cannot_have(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.create_keyed(spark.range(5), path, "id", 2)
    keyed.upsert_table(spark.range(5).where("id > 9"), path, "id", buckets=2)
    keyed.upsert_table(spark.createDataFrame([(None,)], "id bigint"), path, "id", buckets=2)
    assert keyed.versions(spark, path) == [1]
    keyed.delete_rows(spark, path, spark.range(5).select(F.col("id").cast("string").alias("_id")), "id", "id", 2)
    assert keyed.read_keyed(spark, path).count() == 0 and keyed.read_keyed(spark, path).columns == ["id"]
    keyed.upsert_table(spark.range(2), path, "id", buckets=2)
    assert keyed.read_keyed(spark, path).count() == 2
    with pytest.raises(ValueError, match="bucket"):
        keyed.create_keyed(spark.range(2).withColumn("bucket", F.lit(1)), str(tmp_path / "u"), "id", 2)


def test_latest_record_on_a_stored_table_keeps_its_id(spark, tmp_path):
    schema = T.StructType.fromDDL("vin string, id bigint, create_time string, price double, at string")
    conf = sinks.TableConf(str(tmp_path / "t"), schema, "vin", mode="latest_record", ts="at")
    load = lambda *rows: sinks.save(conf, spark.createDataFrame(list(rows), schema))
    load(("a", 1, "c1", 1.0, "2025/1/2"), ("a", 2, "c1", 2.0, "2025/1/10"), ("b", 3, "c1", 3.0, None))
    load(("a", 9, "c2", 5.0, "2025/1/1"), ("c", 7, "c2", 6.0, "x"))
    got = sorted(tuple(r) for r in sinks.read_keyed(spark, conf.path).select("vin", "id", "create_time", "price").collect())
    assert got == [("a", 2, "c1", 5.0), ("b", 3, "c1", 3.0), ("c", 7, "c2", 6.0)]
    with pytest.raises(ValueError):
        sinks.save(sinks.TableConf(str(tmp_path / "n"), schema, "vin", mode="latest"), spark.createDataFrame([], schema))


def test_a_load_without_rows_is_told_as_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_replace(spark.range(3), path)
    report = sinks.load_report(spark, {"t": lambda: sinks.write_replace(spark.range(0), path), "u": lambda: sinks.write_replace(spark.range(2), path)})
    assert [tuple(r)[:3] for r in report.collect()] == [("t", "kept", 0), ("u", "ok", 2)]
