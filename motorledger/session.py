"""Session settings the library is designed for."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings; every one is a plain SQL conf, so they can also be given on submit.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # of a key that an object repeats the last value counts, as with other readers of JSON
    "spark.sql.variant.allowDuplicateKeys": "true",
}

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", shuffle: int = 8) -> SparkSession:
    """A session for tests and benches on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("motorledger")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def cut_lineage(df):
    """Checkpoint ``df`` in the shared folder named by ``spark.checkpoint.dir``.

    The folder is read from the session. Only where none is named, as in tests on
    one machine, a scratch folder is used.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="motorledger-checkpoint-")
        context.setCheckpointDir(named)
    return df.checkpoint()


@contextlib.contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Shuffle files of what is run inside are deleted as it ends, not when the driver next collects its garbage."""
    old = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_DROP_SHUFFLES) if old is None else spark.conf.set(_DROP_SHUFFLES, old)


def written(df, name: str):
    """Write ``df`` to the shared folder and read it back, for results used several times."""
    path = shared_folder(df.sparkSession, name)
    with _shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder all executors can reach, below the one ``spark.checkpoint.dir`` names.

    A scratch folder of this machine is only used by local sessions that name none.
    """
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="motorledger-")
    return f"{base}/{name}-{uuid.uuid4().hex}"
