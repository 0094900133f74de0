"""Keyed tables: rows in hash buckets of their key, published by a manifest.

A batch writes new folders for the buckets it touches and no others, and then a manifest that
names one folder for each bucket. The manifest appears by a single rename, so a driver that dies
at any moment leaves the table before the batch or the table after it. Readers take the newest
manifest and list only the folders it names; a reader that holds an older one still finds its
folders until they are cleaned away on request. A table has one writer at a time; a second one
fails at the rename's check instead of losing the first one's batch.

The number of buckets follows the size of the table: when the buckets hold more than
``BUCKET_BYTES`` on average, the next batch lays the table out in a larger power of two.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorledger.operators.joins import anti
from motorledger.operators.keep import Order
from motorledger.operators.upserts import latest_then_upsert, merge_latest, replace_rows, upsert

BUCKET = "bucket"
#: Size of a bucket at which a table gets more of them.
BUCKET_BYTES = 256 << 20
_BATCH = "_batch"
_MANIFESTS = "_manifests"
_STAGED = "_staged"

Change = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Manifest:
    """What a table consists of: ``folders`` has the folder and bytes of every bucket that has rows.

    ``declared`` is the number of buckets the table was created with, ``buckets`` the present one.
    """

    version: int
    declared: int
    buckets: int
    schema: str
    folders: dict[str, tuple[str, int]]

    def paths(self, numbers: Sequence[int] | None = None) -> list[str]:
        wanted = sorted(self.folders, key=int) if numbers is None else [str(n) for n in numbers if str(n) in self.folders]
        return [f"{BUCKET}={n}/{_BATCH}={self.folders[n][0]}" for n in wanted]

    def wanted_buckets(self) -> int:
        found = self.buckets
        while sum(size for _, size in self.folders.values()) > found * BUCKET_BYTES:
            found *= 2
        return found


def file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[:-5]) for n in _names(spark, f"{path}/{_MANIFESTS}") if n.endswith(".json") and n[:-5].isdigit())


def is_keyed(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def _read_text(spark: SparkSession, path: str) -> str:
    fs, at = file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    """The newest manifest of a table, or the one of a version."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(path)
    found = json.loads(_read_text(spark, f"{path}/{_MANIFESTS}/{known[-1] if version is None else version:010d}.json"))
    return Manifest(**{**found, "folders": {n: (folder, size) for n, (folder, size) in found["folders"].items()}})


def _publish(spark: SparkSession, path: str, new: Manifest) -> None:
    """Make a manifest the newest one by one rename."""
    fs, draft = file_system(spark, f"{path}/{_MANIFESTS}/draft-{uuid.uuid4().hex}")
    _, final = file_system(spark, f"{path}/{_MANIFESTS}/{new.version:010d}.json")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(asdict(new)).encode()))
    finally:
        stream.close()
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"another writer has published version {new.version} of {path}")


def bucket_of(key: str | Column, buckets: int) -> Column:
    c = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(c.cast("string")), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str, key: str, buckets: int) -> dict[str, tuple[str, int]]:
    """Write rows into fresh folders and tell the folder and bytes of every bucket that got some."""
    if BUCKET in df.columns or _BATCH in df.columns:
        raise ValueError(f"a keyed table cannot have columns named {BUCKET} or {_BATCH}")
    spark, name = df.sparkSession, f"{uuid.uuid4().hex}.parquet"
    laid = df.withColumn(BUCKET, bucket_of(key, buckets)).withColumn(_BATCH, F.lit(name))
    # rebalancing lets adaptive execution split a big bucket into several files
    laid.hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET, _BATCH).parquet(path)
    fs, pattern = file_system(spark, f"{path}/{BUCKET}=*/{_BATCH}={name}/*")
    sizes: dict[str, int] = {}
    for status in fs.globStatus(pattern) or []:
        number = status.getPath().getParent().getParent().getName().removeprefix(f"{BUCKET}=")
        sizes[number] = sizes.get(number, 0) + status.getLen()
    return {number: (name, size) for number, size in sizes.items()}


def _rows(spark: SparkSession, path: str, of: Manifest, numbers: Sequence[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(of.schema))
    paths = [f"{path}/{p}" for p in of.paths(numbers)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def create_keyed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Publish a table with this content, in place of what it had."""
    spark = df.sparkSession
    known = versions(spark, path)
    if known:
        _check(path, manifest(spark, path), buckets)
    folders = _write(df, path, key, buckets)
    _publish(spark, path, Manifest(max(known, default=0) + 1, buckets, buckets, _nullable(df.schema).json(), folders))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _check(path: str, found: Manifest, buckets: int) -> None:
    """A batch that names another number of buckets than the table was created with is refused."""
    if found.declared != buckets:
        raise ValueError(f"{path} is laid out in {found.declared} buckets, not {buckets}")


def read_keyed(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return _rows(spark, path, manifest(spark, path, version))


def _numbers(touched: DataFrame) -> list[int]:
    """Bucket numbers, at most as many as the table has buckets."""
    return [r[0] for r in touched.distinct().collect()]


def _rewrite(spark: SparkSession, path: str, old: Manifest, numbers: list[int], change: Change, key: str) -> None:
    """Apply ``change`` to the rows of these buckets and publish the result."""
    if not numbers:
        return
    buckets = old.wanted_buckets()
    if buckets != old.buckets:
        fresh, kept = _write(change(_rows(spark, path, old)), path, key, buckets), {}
    else:
        fresh = _write(change(_rows(spark, path, old, numbers)), path, key, buckets)
        kept = {n: folder for n, folder in old.folders.items() if int(n) not in set(numbers)}
    _publish(spark, path, replace(old, version=old.version + 1, buckets=buckets, folders=kept | fresh))


def _staged(batch: DataFrame, path: str) -> tuple[DataFrame, Callable[[], None]]:
    """A batch written beside its table, read for its buckets and again for the merge, and how to drop it."""
    spark, folder = batch.sparkSession, f"{path}/{_STAGED}/{uuid.uuid4().hex}"
    batch.write.parquet(folder)
    fs, at = file_system(spark, folder)
    return spark.read.schema(batch.schema).parquet(folder), lambda: fs.delete(at, True)


def upsert_table(
    batch: DataFrame, path: str, key: str, order: Order = (), buckets: int = 8, how: str = "upsert",
    ts: str | None = None, keep: Sequence[str] = ("id", "create_time"),
) -> None:
    """Merge a batch into a keyed table, which it creates if need be.

    ``how`` is upsert; replace (whole rows); latest (by event time ``ts``, whichever batch brings
    it); or latest_record (the latest batch row by a time text ``ts`` wins, ``keep`` columns of
    known rows stay).
    """
    changes = {
        "upsert": lambda t, b: upsert(t, b, key, order),
        "replace": lambda t, b: replace_rows(t, b, key, order),
        "latest": lambda t, b: merge_latest(t, b, key, ts),
        "latest_record": lambda t, b: latest_then_upsert(t, b, key, ts, keep),
    }
    if how not in changes or (how.startswith("latest") and ts is None):
        raise ValueError(f"no such merge: {how} by {ts}")
    spark = batch.sparkSession
    batch = batch.where(F.col(key).isNotNull())
    if not is_keyed(spark, path):
        create_keyed(changes[how](batch.limit(0), batch), path, key, buckets)
        return
    old = manifest(spark, path)
    _check(path, old, buckets)
    known = [f["name"] for f in json.loads(old.schema)["fields"]]
    names = [o if isinstance(o, str) else o[0] for o in order]
    used = [c for c in batch.columns if c in {*known, key, ts, *names}]
    staged, drop = _staged(batch.select(*used), path)
    try:
        touched = _numbers(staged.select(bucket_of(key, old.buckets)))
        _rewrite(spark, path, old, touched, lambda t: changes[how](t, staged), key)
    finally:
        drop()


def delete_rows(spark: SparkSession, path: str, ids: DataFrame, column: str, key: str, buckets: int = 8) -> None:
    """Remove rows whose ``column`` is among ``ids._id``. A bucket that loses all its rows leaves the manifest."""
    old = manifest(spark, path)
    _check(path, old, buckets)
    if column == key:
        touched = ids.select(bucket_of("_id", old.buckets))
    else:
        found = _rows(spark, path, old).select(F.col(column).cast("string").alias("_id"), bucket_of(key, old.buckets).alias(BUCKET))
        touched = found.join(ids, "_id", "left_semi").select(BUCKET)

    def change(table: DataFrame) -> DataFrame:
        return anti(table.withColumn("_id", F.col(column).cast("string")), ids, "_id").drop("_id")

    numbers = [n for n in _numbers(touched) if str(n) in old.folders]
    _rewrite(spark, path, old, numbers, change, key)


def clean_keyed(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete manifests but the newest ``keep``, and all folders no kept one names; tells how many folders.

    To be called by the table's writer between two batches, once no reader holds an older version.
    """
    known = versions(spark, path)
    if keep < 1 or not known:
        raise ValueError("a table keeps at least its newest version")
    named = {p for v in known[-keep:] for p in manifest(spark, path, v).paths()}
    fs, _ = file_system(spark, path)
    gone = 0
    for status in fs.globStatus(file_system(spark, f"{path}/{BUCKET}=*/{_BATCH}=*")[1]) or []:
        at = status.getPath()
        if f"{at.getParent().getName()}/{at.getName()}" not in named:
            gone += bool(fs.delete(at, True))
    for name in _names(spark, f"{path}/{_MANIFESTS}"):
        if name not in {f"{v:010d}.json" for v in known[-keep:]}:
            fs.delete(file_system(spark, f"{path}/{_MANIFESTS}/{name}")[1], False)
    fs.delete(file_system(spark, f"{path}/{_STAGED}")[1], True)
    return gone
