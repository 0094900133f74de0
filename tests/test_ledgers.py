"""Ledger files as they come: quoted, broken, blank, repeated and missing headers; the check run."""

import time

import pytest
from pyspark.sql import functions as F

from motorledger.operators import quality
from motorledger.sources import ledgers


def write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_bytes(text.encode())
    return str(folder)


def test_headers_with_quotes_line_breaks_and_blank_lines(spark, rows, tmp_path):
    path = write(
        tmp_path, a='\n,,\n"name, full",amount,"note\nof row"\r\n"x ""q""\ny",5,\n,,\nlast,6,z\n', b="﻿Amount,name,Amount\r\n1,2,3\r\n",
        c="only header,amount\n", d="", e="\n \n", f="amount\n7,beyond\nname, full\n",
    )
    found = ledgers.read_ledger_dir(spark, path, ["amount", "vin"], width=8)
    assert found.columns == ["amount", "vin", "name", "name, full", "noteof row", "only header", "from_file"]
    got = rows(found, "`name, full`", "amount", "`noteof row`", "name", "from_file")
    assert got == [(None, "1", None, "2", "b"), (None, "7", None, None, "f"), (None, "name", None, None, "f"), ("last", "6", "z", None, "a"), ('x "q"\ny', "5", None, None, "a")]
    empty = ledgers.ledgers_without_header(spark, path, width=8)
    assert [r[0][-5:] for r in empty.collect()] == ["e.csv"]  # d.csv has no byte: no scan lists it


def test_rows_that_repeat_the_header_are_no_rows(spark, rows, tmp_path):
    path = write(tmp_path, a="id,x\n1,a\nid,x\nid,y\n1,a\n")
    assert rows(ledgers.read_ledger_dir(spark, path, width=4), "id", "x") == [("1", "a"), ("1", "a"), ("id", "y")]


def test_no_column_is_lost_in_silence(spark, tmp_path):
    path = write(tmp_path, a="a,b,c,d\n1,2,3,4\n")
    assert ledgers.read_ledger_dir(spark, path, width=4).columns == ["a", "b", "c", "d", "from_file"]
    with pytest.raises(Exception, match="more than 3 columns"):
        ledgers.read_ledger_dir(spark, path, width=3).collect()


def test_rows_hold_no_cells_that_a_file_lacks(spark, rows, tmp_path):
    """A row is as wide as it is written, whatever the width that is allowed for."""
    path = write(tmp_path, a="id,x\n1,\n2,b,\n3,,c\n4\n")
    found = ledgers.ledger_rows(spark, path, line_breaks=True)
    assert rows(found, "cells") == [(["1"],), (["2", "b"],), (["3", None, "c"],), (["4"],), (["id", "x"],)]


def test_a_folder_is_parsed_once(spark, tmp_path):
    path = write(tmp_path, a="id,x\n1,a\n", b="x,id\nb,2\n")
    plan = ledgers.read_ledger_dir(spark, path, width=4)._jdf.queryExecution().executedPlan().toString()
    assert "csv" not in plan.lower().replace(".csv", "") and "parquet" in plan.lower()


def test_large_plain_files_are_read_by_several_tasks(spark, tmp_path):
    path = write(tmp_path, a="id,x\n" + "".join(f"{i},v{i}\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        found = ledgers.read_ledger_dir(spark, path, width=3, line_breaks=False)
        assert found.rdd.getNumPartitions() > 1
        assert sorted(int(r["id"]) for r in found.collect()) == list(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_file_names_do_not_pass_the_driver(spark, tmp_path):
    """Reading many headers runs as tasks; only column names are collected."""
    for i in range(40):
        (tmp_path / f"f{i}.csv").write_text(f"id,x{i % 3}\n{i},{i}\n")
    found = ledgers.read_ledger_dir(spark, str(tmp_path), ["id"], width=4)
    assert found.columns == ["id", "x0", "x1", "x2", "from_file"] and found.count() == 40
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_check_run_skips_the_rows_of_files_with_wrong_headers(spark, rows, tmp_path):
    path = write(
        tmp_path, good='month,"push\ndate",store\n13,2025-01-01,S\n,2025-02-30x,T\n2,2025-02-01,S\n', missing="month,store\n99,Q\n", extra="month,pushdate,store,note\n99,x,Q,n\n",
        empty_named="month,pushdate,store,\n1,2025-01-01,S,\n", nothing="\n", mark="month\n5\nx\n",
    )
    templates = {
        "full": quality.Template(["month", "pushdate", "store"], [quality.month_rule("month"), quality.date_rule("pushdate"), quality.store_rule("store", ["S"])]),
        "short": quality.Template(["month"], [quality.month_rule("month")]),
    }
    template = F.when(F.col("file").contains("mark"), "short").otherwise("full")
    report, found = quality.check_ledgers(
        ledgers.ledger_rows(spark, path, 8), ledgers.ledger_headers(spark, path, 8), template, templates, ledgers.laid_out
    )
    name = F.regexp_extract("file", r"([^/]+)\.csv$", 1).alias("file")
    got = rows(report.select(name, "accepted", "missing", "extra", "rows", "data_errors", "error_rows"))
    assert got == [
        ("empty_named", True, [], [], 1, 0, 0), ("extra", False, [], ["note"], 0, 0, 0), ("good", True, [], [], 3, 4, 2),
        ("mark", True, [], [], 2, 1, 1), ("missing", False, ["pushdate"], [], 0, 0, 0),
    ]
    assert rows(found.select(name, "row", "rule")) == [("good", 1, "month"), ("good", 2, "date"), ("good", 2, "month"), ("good", 2, "store"), ("mark", 2, "month")]
    total = quality.run_summary(report).first()
    assert tuple(total) == (5, 2, 5, 6, 3, 50.0)


def test_paths_are_sorted_in_time_that_grows_with_their_length(spark):
    long = "a" * 30000
    paths = ["/film/x.csv", "film", "C:\\film\\own.csv", f"{long}/film/own.csv", f"{long}/film", "/film/a\nb", None]
    df = spark.createDataFrame([(p,) for p in paths * 4], "path string")
    template = quality.classify_source(F.col("path"), [("film", "film")], "film", ["own.csv", "a\nb"], "own")
    start = time.monotonic()
    got = [r[0] for r in df.select(template).collect()]
    assert got[:7] == ["film", "film", "own", "own", "film", "own", "film"]
    assert time.monotonic() - start < 6


def test_one_pass_summary_is_the_old_one(spark):
    df = spark.createDataFrame([("f", 1, "13"), ("f", 1, "2"), ("f", 2, None), ("g", 1, "1"), (None, 1, "x")], "file string, row int, month string")
    rules = [quality.month_rule("month")]
    heads = quality.check_headers(spark, "f", ["a"], ["a", "b"])
    one = quality.summarise(quality.row_errors(df, "file", rules, keep=["row"]), "row", heads).first()
    two = quality.quality_summary(df, quality.check_rows(df, "file", "row", rules), heads, "file").first()
    assert one.asDict() | {"error_rows": 0, "error_rate": 0} == two.asDict() | {"error_rows": 0, "error_rate": 0}
    assert (one["error_rows"], one["files"], one["header_errors"], one["data_errors"], one["total_rows"]) == (3, 2, 1, 3, 5)
    assert quality.summarise(quality.row_errors(df.limit(0), "file", rules, keep=["row"]), "row", heads).first()["error_rate"] == 0.0
