"""Language-model scores by a hashed maximum-entropy model with class-factored softmax.

Words are output through 256 units: the commonest words and the end have one each, all others
share units by their ending. A unit is a class and a member, so a token costs two small
softmaxes: the class given the context, the member given class and context. The context enters
through hashed features: the previous word, the previous two units, and the units two and three
places back (skips). Within a unit, a word has its smoothed share of the unit's count. The
weights come from minibatch gradient steps in every task over its part of the training
documents; after each round the tasks' changes are averaged by number of tokens.

Texts are cut into blocks of a few megabytes. A block lists its distinct words once; corpus
counts are joined to those lists, not to tokens, and come back to the block for scoring.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorledger.llm.common import slices, stored

CLASSES = MEMBERS = 16
UNITS = CLASSES * MEMBERS
OWN = 64  # units of single words; unit 0 is the end
ENDING = 2  # characters
_ROWS1, _ROWS2 = 1 << 12, 1 << 13
_BATCH = 1 << 14
ROUNDS = 2
RATE = 0.15
SMOOTHING = 0.1
_END_HASH = 0x5EED
_BLOCKS = "block long, key long, held boolean, codes binary, no int, word string, train long"
_BLOCKS_ARROW = pa.schema(
    [("block", pa.int64()), ("key", pa.int64()), ("held", pa.bool_()), ("codes", pa.binary()), ("no", pa.int32()), ("word", pa.string()), ("train", pa.int64())]
)


def tokens_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def _block_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 24
    for number, (batch, texts) in enumerate(slices(batches)):
        lists = [tokens_of(t) for t in texts]
        sizes = np.array([len(x) for x in lists], np.int64)
        coded = pa.array([w for x in lists for w in x], pa.binary()).dictionary_encode()
        del lists
        codes = coded.indices.to_numpy().astype("<u4")
        held = np.array(batch.column(1).to_pylist(), np.bool_)
        stops = np.cumsum(sizes)
        train = np.bincount(codes[~np.repeat(held, sizes)], minlength=len(coded.dictionary))
        here = pa.array(np.full(len(sizes), base + number))
        yield pa.RecordBatch.from_arrays(
            [
                here, batch.column(0), batch.column(1), pa.array([codes[b - n : b].tobytes() for b, n in zip(stops.tolist(), sizes.tolist())], pa.binary()),
                pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.string()), pa.nulls(len(sizes), pa.int64()),
            ],
            schema=_BLOCKS_ARROW,
        )
        words = coded.dictionary.cast(pa.string())
        for at in range(0, len(words), 50_000):
            part = words.slice(at, 50_000)
            size = len(part)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size, base + number)), pa.nulls(size, pa.int64()), pa.nulls(size, pa.bool_()), pa.nulls(size, pa.binary()),
                    pa.array(np.arange(at, at + size, dtype=np.int32)), part, pa.array(train[at : at + size]),
                ],
                schema=_BLOCKS_ARROW,
            )


def _shared_unit(word: str) -> int:
    return OWN + zlib.crc32(word[-ENDING:].encode()) % (UNITS - OWN)


def _unit_column(own: list[str]) -> Column:
    """The same unit as a column expression over ``word``."""
    shared = F.lit(OWN) + F.pmod(F.crc32(F.substring("word", -ENDING, ENDING)), F.lit(UNITS - OWN)).cast("int")
    if not own:
        return shared
    known = F.create_map(*[x for i, w in enumerate(own) for x in (F.lit(w), F.lit(i + 1))])
    return F.coalesce(F.try_element_at(known, F.col("word")), shared)


@dataclass
class Weights:
    """Logits: constant ones per class and member, and hashed rows per feature."""

    class_bias: np.ndarray
    member_bias: np.ndarray
    class_rows: np.ndarray
    member_rows: np.ndarray

    @staticmethod
    def start(unit_counts: np.ndarray) -> "Weights":
        counts = (unit_counts + 1.0).reshape(CLASSES, MEMBERS)
        return Weights(
            np.log(counts.sum(1) / counts.sum()).astype(np.float32), np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32),
            np.zeros((_ROWS1, CLASSES), np.float32), np.zeros((_ROWS2, MEMBERS), np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.class_bias, self.member_bias, self.class_rows, self.member_rows]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.reshape(-1) for p in self.parts()])

    @staticmethod
    def of(flat: np.ndarray) -> "Weights":
        shapes = [(CLASSES,), (CLASSES, MEMBERS), (_ROWS1, CLASSES), (_ROWS2, MEMBERS)]
        cuts = np.cumsum([0, *[math.prod(s) for s in shapes]])
        return Weights(*[flat[a:b].reshape(s).astype(np.float32) for a, b, s in zip(cuts[:-1], cuts[1:], shapes)])


def _back(values: np.ndarray, place: np.ndarray, by: int, none: int) -> np.ndarray:
    """The value ``by`` tokens back in the same document; ``place`` is the token's number there."""
    out = np.full(len(values), none, np.int64)
    out[by:] = values[:-by] if len(values) > by else values[:0]
    out[place < by] = none
    return out


def _features(hashes: np.ndarray, units: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Feature numbers of every token, four each: word bigram, unit trigram, two skips."""
    h1, u1 = _back(hashes, place, 1, 1), _back(units, place, 1, UNITS)
    u2, u3 = _back(units, place, 2, UNITS), _back(units, place, 3, UNITS)
    raw = np.stack([h1 * 4, (u1 * 263 + u2) * 4 + 1, u2 * 4 + 2, u3 * 4 + 3], axis=1).astype(np.uint64)
    return ((raw * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64)


def _softmax(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities and the logarithm of their normaliser; logits stay far inside single precision."""
    e = np.exp(np.clip(logits, -60, 60, out=logits), out=np.empty_like(logits))
    whole = e @ np.ones(e.shape[1], np.float32)
    e /= whole[:, None]
    return e, np.log(whole)


def _forward(w: Weights, features: np.ndarray, units: np.ndarray):
    classes, members = units >> 4, units & 15
    rows1 = features % _ROWS1
    rows2 = (features * 31 + classes[:, None] * 7919) % _ROWS2
    first = w.class_rows[rows1[:, 0]]
    second = w.member_rows[rows2[:, 0]]
    for k in range(1, features.shape[1]):
        first += w.class_rows[rows1[:, k]]
        second += w.member_rows[rows2[:, k]]
    first += w.class_bias
    second += w.member_bias[classes]
    p1, z1 = _softmax(first)
    p2, z2 = _softmax(second)
    at = np.arange(len(units))
    return rows1, rows2, classes, members, p1, p2, first[at, classes] - z1 + second[at, members] - z2


def log_probabilities(w: Weights, hashes: np.ndarray, units: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Natural logarithm of every token's unit probability, in sparse batches."""
    features = _features(hashes, units, place)
    out = np.empty(len(units))
    for at in range(0, len(units), _BATCH):
        out[at : at + _BATCH] = _forward(w, features[at : at + _BATCH], units[at : at + _BATCH])[-1]
    return out


def _add_rows(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """``into[rows] += values`` with repeated rows summed; rows are few enough for 16 bits."""
    short = rows.astype(np.uint16)
    order = np.argsort(short, kind="stable")
    short = short[order]
    starts = np.flatnonzero(np.concatenate([[True], short[1:] != short[:-1]]))
    into[short[starts]] += np.add.reduceat(values[order], starts, axis=0)


def _descend(w: Weights, squares: list[np.ndarray], hashes: np.ndarray, units: np.ndarray, place: np.ndarray, rate: float) -> None:
    """One pass of adaptive gradient steps over the tokens, in place."""
    features = _features(hashes, units, place)
    for at in range(0, len(units), _BATCH):
        rows1, rows2, classes, members, p1, p2, _ = _forward(w, features[at : at + _BATCH], units[at : at + _BATCH])
        spot = np.arange(len(classes))
        p1[spot, classes] -= 1
        p2[spot, members] -= 1
        gradients = [p1.sum(0), *[np.zeros(part.shape, np.float32) for part in w.parts()[1:]]]
        _add_rows(gradients[1], classes, p2)
        for k in range(rows1.shape[1]):
            _add_rows(gradients[2], rows1[:, k], p1)
            _add_rows(gradients[3], rows2[:, k], p2)
        for part, square, gradient in zip(w.parts(), squares, gradients):
            step = gradient / np.float32(len(classes))
            square += step * step
            part -= np.float32(rate) * step / (np.sqrt(square) + np.float32(1e-6))


class _Words:
    """Hash and unit of the words of a batch."""

    def __init__(self, own: list[str]):
        self.own = {w: i + 1 for i, w in enumerate(own)}

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        hashes = np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words))
        units = np.fromiter((self.own.get(w) or _shared_unit(w) for w in words), np.int64, len(words))
        return hashes, units


def _with_ends(codes: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes with the end's code after every document, and each token's number in its document."""
    stops = np.cumsum(sizes)
    out = np.insert(codes.astype(np.int64), stops, end)
    place = np.arange(len(out)) - np.repeat(np.concatenate([[0], (stops + np.arange(1, len(sizes) + 1))[:-1]]), sizes + 1)
    return out, place


def _train_task(flat: np.ndarray, own: list[str], rate: float, pieces: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, lookup, tokens = Weights.of(flat), _Words(own), 0
        squares = [np.full(p.shape, 1e-4, np.float32) for p in w.parts()]
        for _, texts in slices(batches):
            lists = [tokens_of(t) for t in texts]
            sizes = np.array([len(x) for x in lists], np.int64)
            coded = pa.array([x for one in lists for x in one], pa.binary()).dictionary_encode()
            hashes, units = lookup(coded.dictionary.cast(pa.string()).to_pylist())
            hashes, units = np.append(hashes, _END_HASH), np.append(units, 0)
            codes, place = _with_ends(coded.indices.to_numpy(), sizes, len(hashes) - 1)
            _descend(w, squares, hashes[codes], units[codes], place, rate)
            tokens += len(codes)
        if tokens:
            change = (w.flat() - flat) * np.float32(tokens)
            parts = [p.astype("<f4").tobytes() for p in np.array_split(change, pieces)]
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(pieces, dtype=np.int32)), pa.array(np.full(pieces, task)), pa.array(np.full(pieces, tokens)), pa.array(parts, pa.binary())],
                ["piece", "task", "tokens", "change"],
            )

    return run


_CHANGE = "piece int, task long, tokens long, change binary"


def _added(changes: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), "<f4").astype(np.float64) for x in changes.column("change"))
    return pa.table(
        {
            "piece": changes.column("piece").slice(0, 1).cast(pa.int32()), "task": changes.column("task").slice(0, 1),
            "tokens": pa.array([sum(changes.column("tokens").to_pylist())]), "change": pa.array([total.astype("<f4").tobytes()], pa.binary()),
        }
    )


def _trained(texts: DataFrame, start: Weights, own: list[str], rounds: int, rate: float) -> Weights:
    """Rounds of local gradient steps; each document takes part in one round."""
    flat, pieces = start.flat(), 16
    for number in range(rounds):
        mine = texts.filter(F.pmod(F.xxhash64("key", "text"), F.lit(rounds)) == number).select("text")
        changes = stored(mine.mapInArrow(_train_task(flat, own, rate, pieces), _CHANGE), "gradients")
        # added up in two steps, so that no task reads a piece of every other task at once
        step = max(1, math.isqrt(changes.select("task").distinct().count()))
        some = changes.withColumn("task", F.pmod("task", F.lit(step))).groupBy("piece", "task").applyInArrow(_added, _CHANGE)
        total = some.groupBy("piece").applyInArrow(_added, _CHANGE).orderBy("piece").collect()  # one model
        if total and total[0]["tokens"]:
            flat = flat + np.concatenate([np.frombuffer(bytes(r["change"]), "<f4") for r in total]) / np.float32(total[0]["tokens"])
    return Weights.of(flat.astype(np.float32))


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score_task(flat: np.ndarray, total: int, distinct: int, ends: int, unit_total: np.ndarray, unit_distinct: np.ndarray):
    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        w = Weights.of(flat)
        size = words.num_rows
        count, hashes, units = np.zeros(size + 1), np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
        name, known = words.column("name").to_numpy(), words.column("known").to_numpy()
        no = name >> 32
        count[no], hashes[no], units[no] = known >> 8, name & 0xFFFFFFFF, known & 0xFF
        count[size], hashes[size], units[size] = ends, _END_HASH, 0
        raw = docs.column("codes").to_pylist()
        sizes = np.array([len(x) // 4 for x in raw], np.int64)
        codes, place = _with_ends(np.frombuffer(b"".join(raw), "<u4"), sizes, size)
        base = np.log10((count + SMOOTHING) / (total + SMOOTHING * (distinct + 1)))
        inside = np.log10((count + SMOOTHING) / (unit_total[units] + SMOOTHING * (unit_distinct[units] + 1)))
        inside[(units > 0) & (units < OWN)] = 0.0  # a unit of one word
        inside[size] = 0.0
        model = log_probabilities(w, hashes[codes], units[codes], place) / math.log(10) + inside[codes]
        first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        return pa.table(
            {
                "doc_id": docs.column("key"), "held_out": docs.column("held"), "n_tokens": pa.array(sizes + 1),
                "n_known": pa.array(np.add.reduceat((count > 0)[codes].astype(np.int64), first)),
                "base_score": pa.array(np.add.reduceat(base[codes], first)), "score": pa.array(np.add.reduceat(model, first)),
            }
        )

    return run


def scored(docs: DataFrame, held_out: Column, rounds: int = ROUNDS, rate: float = RATE) -> DataFrame:
    """Scores of every row of ``docs`` by a model of the rows for which ``held_out`` is false.

    Null and empty texts consist of the end alone. Words that the training documents lack share
    the smoothing mass. Rows that share an id are scored one by one. Without any training
    document every unit is equally likely and the base probability of a word is 1.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("key"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col("text").cast("string").alias("text")
    )
    blocks = stored(rows.mapInArrow(_block_task, _BLOCKS), "word-blocks")
    texts, words = blocks.filter("word IS NULL").select("block", "key", "held", "codes"), blocks.filter("word IS NOT NULL").select("block", "no", "word", "train")
    counts = stored(words.filter("train > 0").groupBy("word").agg(F.sum("train").alias("c")), "word-counts")
    ends = texts.filter("NOT held").count()
    own = [r["word"] for r in counts.orderBy(F.desc("c"), "word").limit(OWN - 1).collect()]
    by_unit = counts.groupBy(_unit_column(own).alias("unit")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    unit_total, unit_distinct = np.zeros(UNITS), np.zeros(UNITS)
    for unit, c, v in by_unit:
        unit_total[unit], unit_distinct[unit] = c, v
    total, distinct = int(unit_total.sum()) + ends, int(unit_distinct.sum()) + (ends > 0)
    start = unit_total.copy()
    start[0] = ends
    weights = _trained(rows.filter("NOT held").select("key", "text"), Weights.start(start), own, rounds, rate)
    # two numbers per word of a block: its number there and hash, its count and unit
    known = words.join(counts, "word", "left").select(
        F.col("block").alias("owner"), (F.shiftleft(F.col("no").cast("long"), 32) + F.crc32("word")).alias("name"),
        (F.shiftleft(F.coalesce("c", F.lit(0)).cast("long"), 8) + _unit_column(own)).alias("known"),
    )
    run = _score_task(weights.flat(), total, distinct, ends, unit_total, unit_distinct)
    found = texts.groupBy("block").cogroup(known.groupBy("owner")).applyInArrow(run, _SCORES)
    return found.withColumn("train_tokens", F.lit(total).cast("long"))
