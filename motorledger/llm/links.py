"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorledger.llm.common import stored


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("low", "high")), F.bit_xor(F.xxhash64("high", "low"))).first())


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on the least of them: the larger ones, or the smaller ones."""
    both = links.select(F.col("low").alias("node"), F.col("high").alias("other"))
    if large:
        both = both.unionByName(links.select(F.col("high").alias("node"), F.col("low").alias("other")))
    else:
        both = links.select(F.col("high").alias("node"), F.col("low").alias("other"))
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("least", "node").alias("least"))
    moved = both.join(least, "node").filter(F.col("other") > F.col("node") if large else F.lit(True))
    out = moved.select(F.col("other").alias("node"), "least")
    if not large:
        out = out.unionByName(least)
    return out.filter("node != least").select(F.col("least").alias("low"), F.col("node").alias("high")).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of ``links`` (low < high).

    Every round is written to the shared folder. Rounds grow with the logarithm of the longest
    chain; a table that has not settled after ``rounds`` raises rather than give a wrong answer.
    """
    state = _state(links)
    for _ in range(rounds):
        if state[0] == 0:
            break
        links = stored(_star(_star(links, large=True), large=False), "stars")
        after = _state(links)
        if after == state:
            break
        state = after
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    return links.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
        links.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    )
