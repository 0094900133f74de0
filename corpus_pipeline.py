"""From raw documents to packed sequences: five stages, each a whole-table job of one operator.

Every stage judges each row on its own: rows with a null or repeated id count like others, and
repeated rows have one fate in all stages but near duplicates, where one of them stays. A null
text counts as empty. Extra columns, whatever their names, are kept as they are. An empty table
gives an empty table.

:func:`run` deletes the intermediate tables of a stage once its result is written, and each result
once the next one is. Stages that are called one by one write their results between calls: a
stage then begins by deleting the intermediate tables of the last call of the stage before it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorledger.llm import decontaminate, packing, quality_model, quality_rules, simhash
from motorledger.llm.common import id_remainder, noting, numbered, prepared, release, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Intermediate tables of the last call of each stage, while stages are called one by one.
_left: dict[str, list[str]] = {}


def _stage(build: Stage) -> Stage:
    @wraps(build)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        at = [f.__name__ for _, f in STAGES].index(build.__name__)
        release(prepared(spark), _left.pop(STAGES[at - 1][1].__name__, []) if at else [])
        with noting() as folders:
            found = build(spark, docs, sf_dir)
        _left[build.__name__] = folders
        return found

    return run_stage


@_stage
def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality rules accept. A null or unknown language is compared with all of them."""
    rows = docs.select(F.struct("*").alias("row"), "lang", "text")
    return quality_rules.accepted(rows, quality_rules.references(docs)).select("row.*")


@_stage
def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the classifier predicts to be good.

    It is fitted on labelled rows of the documents table: earlier stages drop most bad examples.
    """
    model = quality_model.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), id_remainder(5) != 0)
    found = quality_model.classified(docs.select(F.struct("*").alias("row"), "text"), model)
    return found.filter("q.predicted = 1").select("row.*")


@_stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the one with the least id, then the first row."""
    rows = numbered(docs.select(F.struct("*").alias("row"), "doc_id", "text"), "near-duplicate-rows")
    groups = simhash.near_duplicates(rows, "row_id").select("key", "component")
    ids = rows.select(F.col("row_id").alias("key"), "doc_id")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    kept = groups.join(ids, "key").groupBy("component").agg(F.min(first).alias("first")).select(F.col("first.key").alias("row_id"))
    # the kept ids grow with the table: one plan, a sorted join, at every size
    return rows.hint("merge").join(stored(kept, "kept-rows"), "row_id", "left_semi").select("row.*")


@_stage
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain a passage of the benchmark."""
    rows = numbered(docs.select(F.struct("*").alias("row"), "text"), "benchmark-rows")
    found = decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"), "row_id")
    hit = stored(found.filter("n_hit > 0").select("row_id"), "contaminated-rows")
    return rows.join(hit, "row_id", "left_anti").select("row.*")


@_stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences; one row per piece."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("simhash_near_duplicates", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The classifier, the fingerprints and the tokens are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; every result is written and read again.

    The tables of one run are its own: several runs in one process do not touch each other's.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with noting() as used:
            found = stage.__wrapped__(spark, docs, sf_dir)
        with noting() as written:
            docs = stored(found, name)
        release(spark, used)
        release(spark, before)
        before = written
    return STAGES[-1][1].__wrapped__(spark, docs, sf_dir)
