"""Keyed table maintenance as plain joins: target and batch in, new target out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorledger.functions.dates import parse_ts
from motorledger.operators.keep import Order, last_per_key


def _one_per_key(batch: DataFrame, key: str, order: Order) -> DataFrame:
    return last_per_key(batch.where(F.col(key).isNotNull()), [key], order)


def _merge(target: DataFrame, batch: DataFrame, key: str, keep: Sequence[str], wins: Column) -> DataFrame:
    """Full outer join of unique keys; ``wins`` says where the batch value is taken."""
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("_old"))
    b = batch.select(*[F.col(c).alias(f"b_{c}") for c in batch.columns], F.lit(True).alias("_new"))
    joined = t.join(b, F.col(f"t_{key}") == F.col(f"b_{key}"), "full")
    known = set(batch.columns)
    out = []
    for f in target.schema.fields:
        c = f.name
        if c not in known:
            out.append(F.col(f"t_{c}").alias(c))
            continue
        new = F.col(f"b_{c}").cast(f.dataType)
        take = F.col("_old").isNull() if c in keep else wins
        out.append(F.when(F.coalesce(take, F.lit(False)), new).otherwise(F.col(f"t_{c}")).alias(c))
    return joined.select(*out)


def upsert(target: DataFrame, batch: DataFrame, key: str, order: Order = ()) -> DataFrame:
    """New keys are added, known keys take every batch column, nulls included.

    Columns the batch lacks keep their value, columns the target lacks are ignored. The
    last batch row per key in ``order`` counts.
    """
    return _merge(target, _one_per_key(batch, key, order), key, (), F.col("_new"))


def replace_rows(target: DataFrame, batch: DataFrame, key: str, order: Order = ()) -> DataFrame:
    """Known keys are replaced as whole rows: columns the batch lacks become null."""
    batch = _one_per_key(batch, key, order)
    batch = batch.select(*[c for c in batch.columns if c in target.columns])
    kept = target.join(batch.select(key), key, "left_anti").select(*target.columns)
    return kept.unionByName(batch, allowMissingColumns=True).select(*target.columns)


def latest_then_upsert(
    target: DataFrame, batch: DataFrame, key: str, ts: str, keep: Sequence[str] = ("id", "create_time")
) -> DataFrame:
    """The batch row with the latest time per key, upserted; ``keep`` columns of known rows stay."""
    timed = batch.withColumn("_at", parse_ts(ts))
    latest = _one_per_key(timed, key, ["_at"]).drop("_at")
    return _merge(target, latest, key, keep, F.col("_new"))


def _after(new: str, old: str, ts: str, fields: Sequence[T.StructField]) -> Column:
    """Whether the ``new`` side is the later event: by time, then by the least of the other values.

    This is the order in which one row per key is chosen within a batch; unknown values come last.
    """
    a, b = F.col(f"{new}{ts}"), F.col(f"{old}{ts}")

    def rank(side: str) -> Column:
        parts = [F.lit(0)]
        for f in fields:
            c = F.col(f"{side}{f.name}").cast(f.dataType)
            parts += [c.isNull(), F.to_json(c) if isinstance(f.dataType, (T.MapType, T.VariantType)) else c]
        return F.struct(*[p.alias(f"r{i}") for i, p in enumerate(parts)])

    by_content = rank(new) < rank(old)
    return F.when(a.eqNullSafe(b), by_content).when(a.isNull(), False).when(b.isNull(), True).otherwise(a > b)


def merge_latest(target: DataFrame, batch: DataFrame, key: str, ts: str) -> DataFrame:
    """Upsert by event order: a late batch row that is older than the target never wins.

    The order is total, by time and then content, so any split of the rows into batches leads
    to the same table, as long as the batches have the same columns.
    """
    kinds = {f.name: f for f in target.schema.fields}
    batch = batch.select(*[F.col(c).cast(kinds[c].dataType).alias(c) for c in target.columns if c in batch.columns])
    latest = _one_per_key(batch, key, [ts])
    others = [kinds[c] for c in latest.columns if c not in (key, ts)]
    newer = F.col("_new") & (F.col("_old").isNull() | _after("b_", "t_", ts, others))
    return _merge(target, latest, key, (), newer)
