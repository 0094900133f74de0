"""Replaying a log of deletions over the tables it names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorledger import values as V
from motorledger.operators.joins import anti, flag_in
from motorledger.operators.reshape import explode_ids

CONTENTS = "Logo_IdOrCode string, Arr array<struct<ID: string, BillCode: string>>"
_TEXT_DEFAULTS = {"title": "", "type": "", "ip": "", "contents": "{}", "write_time": "", "user_name": ""}


def parse_delete_log(log: DataFrame) -> DataFrame:
    """Read the JSON of each entry; broken JSON gives nulls, missing texts a default."""
    parsed = F.from_json("contents", CONTENTS)
    first = F.get(F.col("_p.Arr"), F.lit(0))
    out = log.withColumn("_p", parsed).withColumns(
        {
            "id_or_code": F.when(F.col("_p.Logo_IdOrCode") != "", F.col("_p.Logo_IdOrCode")),
            "record_id": first["ID"],
            "bill_code": first["BillCode"],
        }
    ).drop("_p")
    present = set(out.columns)
    texts = {
        c: F.coalesce(F.col(c).cast("string"), F.lit(d)) if c in present else F.lit(d)
        for c, d in _TEXT_DEFAULTS.items()
    }
    return out.withColumns(texts)


def targets(
    table: str, titles: Mapping[str, Sequence[str]], keys: Mapping[str, str], columns: Sequence[str]
) -> dict[str, list[str]]:
    """Delete column to the titles that delete by it, for one table."""
    special = {V.DELETE_BY_ID_TITLE: "id", V.DELETE_BY_OUT_ID_TITLE: "out_id"}
    out: dict[str, list[str]] = {}
    for title, tables in titles.items():
        column = special.get(title, keys.get(table))
        if table in tables and column in columns:
            out.setdefault(column, []).append(title)
    return out


def deleted_ids(parsed: DataFrame, titles: Sequence[str]) -> DataFrame:
    """Distinct ids named by log entries with these titles."""
    named = parsed.where(F.col("title").isin(*titles) & F.col("id_or_code").isNotNull())
    return explode_ids(named.select("id_or_code"), "id_or_code", "_id").select("_id").distinct()


def apply_deletes(
    tables: Mapping[str, DataFrame], log: DataFrame,
    titles: Mapping[str, Sequence[str]], keys: Mapping[str, str],
) -> dict[str, DataFrame]:
    """Tables without the rows the log deletes.

    ``titles`` names the tables per log title, ``keys`` the key column per table. Two
    titles delete by a fixed column instead. A table that lacks the column is unchanged.
    """
    parsed = parse_delete_log(log)
    out = {}
    for name, table in tables.items():
        for column, names in targets(name, titles, keys, table.columns).items():
            marked = table.withColumn("_id", F.col(column).cast("string"))
            table = anti(marked, deleted_ids(parsed, names), "_id").drop("_id")
        out[name] = table
    return out


def delete_report(
    tables: Mapping[str, DataFrame], log: DataFrame,
    titles: Mapping[str, Sequence[str]], keys: Mapping[str, str],
) -> DataFrame:
    """Rows and rows to delete per table, and the number of log entries; one pass per table."""
    parsed = parse_delete_log(log)
    entries = log.agg(F.lit("delete_log").alias("table_name"), F.count(F.lit(1)).alias("rows"))
    out = entries.withColumn("deleted", F.lit(0).cast("bigint"))
    for name, table in tables.items():
        hits = targets(name, titles, keys, table.columns)
        marked = table.select(*[F.col(c).cast("string").alias(f"_id{i}") for i, c in enumerate(hits)], F.lit(False).alias("_gone"))
        for i, names in enumerate(hits.values()):
            marked = flag_in(marked, deleted_ids(parsed, names), f"_id{i}", "_hit", True, False, right_on="_id")
            marked = marked.withColumn("_gone", F.col("_gone") | F.col("_hit")).drop("_hit")
        out = out.unionByName(
            marked.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.count_if("_gone").alias("deleted"))
        )
    return out
