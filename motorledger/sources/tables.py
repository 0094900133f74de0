"""Table scans. Projection and predicates are left to Catalyst to push down."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorledger.functions.dates import when_at

_log = logging.getLogger(__name__)
#: Values of a list from which on it is no longer written into the plan.
LISTED = 1000


def scan_table(
    spark: SparkSession, path: str, cols: Sequence[str] | None = None, fmt: str = "parquet", **options
) -> DataFrame:
    """A whole table or some columns of it. For a database give ``fmt='jdbc'``, ``path``
    as the table, and the connection and partitioning as options."""
    reader = spark.read.format(fmt).options(**options)
    df = reader.option("dbtable", path).load() if fmt == "jdbc" else reader.load(path)
    return df if cols is None else df.select(*cols)


def scan_since(
    df: DataFrame, date: str, since: str | None = None, as_of: datetime | None = None, days: int = 7
) -> DataFrame:
    """Rows from a moment on; by default the last days before ``as_of``."""
    if since is None:
        since = ((as_of or datetime.now()) - timedelta(days=days)).strftime("%Y-%m-%d")
    return df.where(F.col(date) >= when_at(since))


def scan_in(df: DataFrame, wanted: Mapping[str, Iterable]) -> DataFrame:
    """Rows whose columns are in the given lists; values are brought to the column's type first.

    Short lists stay in the plan and reach the scan; from ``LISTED`` values on a list is a table
    that the rows are joined with, by the same values. Null matches nothing.
    """
    for name, values in wanted.items():
        kind, values = df.schema[name].dataType, list(dict.fromkeys(values))
        if len(values) < LISTED:
            df = df.where(F.col(name).isin(*[F.lit(v).cast(kind) for v in values]))
            continue
        listed = df.sparkSession.createDataFrame(pa.table({"_v": pa.array(values)})).select(F.col("_v").cast(kind).alias("_v")).distinct()
        df = df.join(listed, F.col(name) == F.col("_v"), "left_semi")
    return df


def load_mapped(catalog: Mapping[str, DataFrame], mapping: DataFrame) -> dict[str, DataFrame]:
    """Per table the mapped fields under their business names.

    ``mapping`` has table_name, field, name: one row per field, so its size is that of the
    schema. Tables without an entry are skipped and reported.
    """
    fields: dict[str, dict[str, str]] = {}
    for table, field, name in mapping.select("table_name", "field", "name").collect():
        fields.setdefault(table, {})[field] = name
    out = {}
    for table, df in catalog.items():
        wanted = {f: n for f, n in fields.get(table, {}).items() if f in df.columns}
        if not wanted:
            _log.warning("no mapping for table %s, skipped", table)
            continue
        out[table] = df.select(*[F.col(f).alias(n) for f, n in wanted.items()])
    return out


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None,
    fields: Sequence[str] | None = None, where: Column | None = None, limit: int | None = None,
) -> DataFrame:
    """JSON documents with optional filter, projection and limit."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.json(path)
    if where is not None:
        df = df.where(where)
    if fields is not None:
        df = df.select(*[f for f in fields if f in df.columns])
    return df if limit is None else df.limit(limit)


def profile_table(df: DataFrame, date_cols: Sequence[str] | None = None) -> DataFrame:
    """Rows, number of columns, and first and last value of each date column, in one pass."""
    if date_cols is None:
        temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
        date_cols = [
            f.name for f in df.schema.fields
            if isinstance(f.dataType, temporal) or any(w in f.name.lower() for w in ("date", "time"))
        ]
    bounds = [a for c in date_cols for a in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))]
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"), *bounds
    )


def month_partitions(spark: SparkSession, start: str, as_of: str) -> DataFrame:
    """Every month label ``yyyyMM`` from the start month to the running one."""
    months = F.sequence(
        F.trunc(F.lit(start).cast("date"), "month"),
        F.trunc(F.lit(as_of).cast("date"), "month"),
        F.make_ym_interval(F.lit(0), F.lit(1)),
    )
    return spark.range(1).select(F.explode(months).alias("m")).select(F.date_format("m", "yyyyMM").alias("month"))


def backfill(df: DataFrame, date: str, start: str, as_of: str) -> DataFrame:
    """Rows of the month range with their month label, ready to be written by month."""
    first = F.trunc(F.lit(start).cast("date"), "month")
    day = F.col(date).cast("date")
    return df.where((day >= first) & (day <= F.last_day(F.lit(as_of).cast("date")))).withColumn(
        "month", F.date_format(date, "yyyyMM")
    )
