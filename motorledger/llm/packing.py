"""Packing documents into sequences as a cutting-stock problem.

Every document is cut into whole sequences, one piece on a grid of lengths, and a short rest, so
that the histogram of piece lengths has few classes however many documents there are. Which
lengths share a sequence is a linear program over patterns: columns are priced by a knapsack
dynamic program on the dual values until the bound says that nothing is left to gain. The
rounded patterns, and greedily filled ones for the remainder, are then given to the documents by
their rank within a length. Only the histogram reaches the driver.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorledger.llm.common import slices, stored
from motorledger.llm.tokens import encoder, tokenizer_path

SEQUENCE = 2048
#: Lengths from EXACT on are cut to multiples of GRID; the rest becomes a piece of its own.
EXACT = 64
GRID = 32
END_ID = 1
#: The linear program ends once its value is this close to its lower bound.
GAP = 1e-4
_PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long"


def cuts(tokens: int, sequence: int = SEQUENCE) -> list[int]:
    """Lengths of the pieces of a document of ``tokens`` ids."""
    full, rest = divmod(tokens, sequence)
    out = [sequence] * full
    if rest >= EXACT:
        out.append(rest - rest % GRID)
        rest %= GRID
    return [*out, rest] if rest else out


def _knapsack(lengths: np.ndarray, price: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of lengths within ``capacity``: one dynamic-programming row per length."""
    best = [np.zeros(capacity + 1)]
    for size, value in zip(lengths.tolist(), price.tolist()):
        if value <= 1e-12:
            best.append(best[-1])
            continue
        rows = -(-(capacity + 1) // size)
        grid = np.full(rows * size, -np.inf)
        grid[: capacity + 1] = best[-1]
        worth = np.arange(rows)[:, None] * value
        grid = np.maximum.accumulate(grid.reshape(rows, size) - worth, axis=0) + worth
        best.append(grid.reshape(-1)[: capacity + 1])
    counts, room = np.zeros(len(lengths), np.int64), capacity
    for at in range(len(lengths) - 1, -1, -1):
        if best[at + 1] is best[at]:
            continue
        most = room // int(lengths[at])
        ways = best[at][room - np.arange(most + 1) * int(lengths[at])] + np.arange(most + 1) * price[at]
        counts[at] = int(np.argmax(ways))
        room -= counts[at] * int(lengths[at])
    return float(best[-1][capacity]), counts


def solve(lengths: np.ndarray, demand: np.ndarray, capacity: int = SEQUENCE, gap: float = GAP, most: int = 5000) -> list[tuple[int, np.ndarray]]:
    """(times, counts per length) patterns that use every piece exactly once."""
    size = len(lengths)
    if not size:
        return []
    columns = [np.eye(size, dtype=np.int64)[i] * (capacity // int(lengths[i])) for i in range(size)]
    cost = np.ones(size)
    inverse = np.diag([1.0 / c.max() for c in columns])
    need = demand.astype(np.float64)
    for _ in range(most):
        amount = inverse @ need
        dual = cost @ inverse
        value, pattern = _knapsack(lengths, dual, capacity)
        bound = float(np.maximum(dual, 0) @ need) / max(value, 1.0)
        surplus = int(np.argmin(dual))
        if dual[surplus] < -1e-9:  # using more of a length than needed is free
            column, price = -np.eye(size, dtype=np.int64)[surplus], 0.0
        elif value <= 1 + 1e-9 or float(cost @ amount) <= bound * (1 + gap):
            break
        else:
            column, price = pattern, 1.0
        turn = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(turn > 1e-9, np.maximum(amount, 0) / turn, np.inf)
        leave = int(np.argmin(ratio))
        if not np.isfinite(ratio[leave]):
            break
        inverse[leave] /= turn[leave]
        other = np.arange(size) != leave
        inverse[other] -= np.outer(turn[other], inverse[leave])
        columns[leave], cost[leave] = column, price
    amount = inverse @ need
    left, out = demand.astype(np.int64).copy(), []
    for times, column in sorted(((int(a + 1e-7), c) for a, c, p in zip(amount, columns, cost) if p > 0), key=lambda x: -x[0]):
        used = column > 0
        times = min(times, int((left[used] // column[used]).min()))
        if times > 0:
            out.append((times, column))
            left -= times * column
    order = np.argsort(-lengths)
    while left.any():  # at most a few pieces per pattern remain: fill sequences longest first
        room, column = capacity, np.zeros(size, np.int64)
        for at in order:
            column[at] = min(int(left[at]), room // int(lengths[at]))
            room -= int(column[at]) * int(lengths[at])
        used = column > 0
        times = int((left[used] // column[used]).min())
        out.append((times, column))
        left -= times * column
    return out


def _piece_task(path: str, end_id: int, sequence: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch, texts in slices(batches, most=4 << 20):
            out: list[tuple] = []
            for key, ids in zip(batch.column(0).to_pylist(), encode(texts)):
                data = np.append(ids, np.uint32(end_id)).astype("<u4")
                at = 0
                for length in cuts(len(data), sequence):
                    out.append((key, at, length, zlib.crc32(data[at : at + length].tobytes()), len(data)))
                    at += length
            columns = list(zip(*out)) if out else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            )

    return run


def pieces(docs: DataFrame, path: str | None = None, end_id: int = END_ID, sequence: int = SEQUENCE) -> DataFrame:
    """One row per piece: its document, place, length and checksum. A null text is the end id alone."""
    pairs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return pairs.mapInArrow(_piece_task(path or tokenizer_path(), end_id, sequence), _PIECES)


def _ranked(cut: DataFrame, total: int) -> DataFrame:
    """A number from 0 within each length, in two steps so that no length is one task's work."""
    parts = max(1, math.isqrt(total))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    offsets = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    return (
        cut.withColumn("at", F.row_number().over(within) - 1)
        .join(offsets, ["length", "part"])
        .withColumn("rank", F.col("before") + F.col("at"))
        .drop("part", "at", "before")
    )


def _places(lengths: np.ndarray, patterns: list[tuple[int, np.ndarray]]) -> list[tuple[int, ...]]:
    """Per pattern and length: ranks from, to, how many per sequence, first sequence, first offset."""
    taken, sequence, out = np.zeros(len(lengths), np.int64), 0, []
    for times, column in patterns:
        offset = 0
        for at in np.argsort(-lengths):
            if each := int(column[at]):
                first = int(taken[at])
                out.append((int(lengths[at]), first, first + each * times, each, sequence, offset))
                taken[at] += each * times
                offset += each * int(lengths[at])
        sequence += times
    return out


def packed(docs: DataFrame, path: str | None = None, end_id: int = END_ID, sequence: int = SEQUENCE) -> DataFrame:
    """Every piece of every document with ``sequence_id`` and its ``offset`` there.

    Each id of each document lies in one piece; pieces of a sequence follow each other without
    gaps from offset 0. Null and empty texts are one piece of the end id; rows that share an id
    are packed one by one; an empty table gives no sequences.
    """
    cut = stored(pieces(docs, path, end_id, sequence), "pieces")
    histogram = cut.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most EXACT + sequence / GRID rows
    histogram.sort(key=lambda r: r["length"])
    lengths = np.array([r["length"] for r in histogram], np.int64)
    counts = np.array([r["n"] for r in histogram], np.int64)
    places = _places(lengths, solve(lengths, counts, sequence))
    spark = docs.sparkSession
    runs = spark.createDataFrame(places, "place_length int, first long, stop long, each long, base long, shift long")
    found = _ranked(cut, int(counts.sum())).join(
        F.broadcast(runs),  # patterns times lengths, both bounded by the histogram
        (F.col("length") == F.col("place_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("stop")),
    )
    step: Column = F.col("rank") - F.col("first")
    return found.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("base") + F.floor(step / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("shift") + F.pmod(step, F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )
