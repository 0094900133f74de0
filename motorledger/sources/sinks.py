"""Writing tables.

Replaced tables are written to a fresh ``v=<n>`` folder and become visible when Spark has
committed that folder, so a failed run never leaves a half table. Tables that are merged by key
are in :mod:`motorledger.sources.keyed`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorledger.operators.columns import conform, conform_money, dedupe_columns
from motorledger.operators.unions import union_outer
from motorledger.sources.keyed import (  # noqa: F401 - part of this module's interface
    clean_keyed, create_keyed, delete_rows, file_system, read_keyed, upsert_table,
)

def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def _has_data(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return any(not s.getPath().getName().startswith(("_", ".")) and s.getLen() > 0 for s in fs.listStatus(at))


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    numbers = [int(n[2:]) for n in names if n.startswith("v=")]
    return sorted(n for n in numbers if exists(spark, f"{path}/v={n}/_SUCCESS"))


def write_replace(df: DataFrame, path: str, fmt: str = "parquet", allow_empty: bool = False, **options) -> int:
    """Publish a new content; returns its row count. An empty result keeps the old content."""
    spark = df.sparkSession
    seen = Observation()
    version = max(_versions(spark, path), default=0) + 1
    target = f"{path}/v={version}"
    counted = dedupe_columns(df).observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.format(fmt).options(**options).mode("overwrite").save(target)
    try:
        rows = seen.get["n"]
    except Py4JJavaError:  # a plan proven empty at run time reports no metrics
        rows = spark.read.format(fmt).options(**options).load(target).count() if _has_data(spark, target) else 0
    if rows == 0 and not allow_empty:
        fs, at = file_system(spark, target)
        fs.delete(at, True)
    return rows


def read_current(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, **options
) -> DataFrame:
    """The latest published content."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(path)
    reader = spark.read.format(fmt).options(**options)
    reader = reader if schema is None else reader.schema(schema)
    return reader.load(f"{path}/v={versions[-1]}")


def clean_versions(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete the published versions but the newest ``keep``, and unfinished ones before them."""
    if keep < 1:
        raise ValueError("a table keeps at least its newest version")
    known = _versions(spark, path)
    fs, at = file_system(spark, path)
    first = known[-keep:][0] if known else 0
    old = [s.getPath() for s in (fs.listStatus(at) if known else []) if s.getPath().getName().startswith("v=")]
    return sum(bool(fs.delete(p, True)) for p in old if int(p.getName()[2:]) < first)


def write_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_documents(df: DataFrame, path: str) -> int:
    """Documents with every field present, unknown ones as null."""
    return write_replace(df, path, "json", ignoreNullFields="false")


def write_csv(df: DataFrame, path: str) -> int:
    return write_replace(df, path, "csv", header="true", encoding="UTF-8")


def write_money(df: DataFrame, path: str) -> int:
    return write_replace(conform_money(df), path)


def full_refresh(df: DataFrame, schema: T.StructType, path: str) -> int:
    """Replace a table by a batch fitted to the table's schema."""
    return write_replace(conform(df, schema), path)


def truncate_tables(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Empty each table and tell how that went."""
    out = []
    for path in paths:
        try:
            write_replace(read_current(spark, path).limit(0), path, allow_empty=True)
            out.append((path, "ok", ""))
        except FileNotFoundError:
            out.append((path, "failed", "no such table"))
    return spark.createDataFrame(out, "table_name string, result string, message string")


@dataclass(frozen=True)
class TableConf:
    """How a table is kept: keyed tables are merged, the others replaced.

    ``mode`` is full, or a merge of :func:`upsert_table`; the latest ones need the time column ``ts``.
    """

    path: str
    schema: T.StructType
    key: str | None = None
    order: Sequence[str] = ()
    mode: str = "upsert"
    buckets: int = 8
    ts: str | None = None
    keep: Sequence[str] = ("id", "create_time")


def save(conf: TableConf, batch: DataFrame) -> int | None:
    """Load a batch the way its table asks for."""
    if conf.mode == "full" or conf.key is None:
        return full_refresh(batch, conf.schema, conf.path)
    upsert_table(conform(batch, conf.schema), conf.path, conf.key, conf.order, conf.buckets, conf.mode, conf.ts, conf.keep)
    return None


def incremental_update(source: DataFrame, path: str, key: str, clean: Callable[[DataFrame], DataFrame], window: Callable[[DataFrame], DataFrame], order: Sequence[str] = (), buckets: int = 8) -> None:
    """Window scan, clean, merge by key; running it twice changes nothing."""
    upsert_table(clean(window(source)), path, key, order, buckets)


def load_report(spark: SparkSession, loads: Mapping[str, Callable[[], int]]) -> DataFrame:
    """Run the loads and list rows and outcome per table; a failure does not stop the rest.

    A load without rows leaves its table as it was: the outcome is ``kept``.
    """
    out = []
    for name, load in loads.items():
        try:
            rows = load()
            out.append((name, "kept" if rows == 0 else "ok", rows, ""))
        except Exception as error:  # noqa: BLE001 - the report is the place for it
            out.append((name, "failed", None, type(error).__name__))
    return spark.createDataFrame(out, "table_name string, result string, rows bigint, message string")


def counts_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table in one job."""
    counts = [t.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("rows")) for n, t in tables.items()]
    return union_outer(*counts)
