"""Streams that keep tables current.

Both run every new file once and then stop, the form a scheduler repeats. Each batch is
applied through a merge that gives the same table when it is applied again, so a batch
repeated after a failure does no harm.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from motorledger.operators.deletes import targets, deleted_ids, parse_delete_log
from motorledger.sources.keyed import clean_keyed, delete_rows, is_keyed, read_keyed, upsert_table

#: Versions of a table that a stream leaves: a reader has one batch to finish in.
KEPT_VERSIONS = 2


def stream_upsert(
    records: DataFrame, path: str, key: str, ts: str, checkpoint: str, buckets: int = 8
) -> StreamingQuery:
    """Keep the latest record per key by event time; a late older record never wins.

    Records of one key and time are ordered by their other columns, so the table does not
    depend on how the records were split into batches.
    """

    def apply(batch: DataFrame, _batch_id: int) -> None:
        upsert_table(batch, path, key, buckets=buckets, how="latest", ts=ts)
        if is_keyed(batch.sparkSession, path):
            clean_keyed(batch.sparkSession, path, KEPT_VERSIONS)

    return (
        records.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_deletes(
    log: DataFrame, paths: Mapping[str, str], titles: Mapping[str, Sequence[str]],
    keys: Mapping[str, str], checkpoint: str, buckets: int = 8,
) -> StreamingQuery:
    """Apply a growing log of deletions to keyed tables."""

    def apply(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        parsed = parse_delete_log(batch)
        for table, path in paths.items():
            if not is_keyed(spark, path):
                continue
            columns = read_keyed(spark, path).columns
            for column, names in targets(table, titles, keys, columns).items():
                delete_rows(spark, path, deleted_ids(parsed, names), column, keys[table], buckets)
            clean_keyed(spark, path, KEPT_VERSIONS)

    return (
        log.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
