"""Token-id files: an adaptive context-mixing range coder in independent, checksummed blocks.

A block holds the ids of whole documents. Its ids are dealt to lanes, equal runs of neighbouring
ids, and all lanes are coded in step, one id of each lane at a time, with one shared model:

* order 2: the id last seen after the two previous ids (hashed), with a confidence;
* order 1: the id last seen after the previous id, with a confidence;
* order 0: adaptive frequencies of all ids, renewed every few steps.

The three predictions divide the coding interval in proportions that are counted, as coding
goes on, for each pair of confidences. The id's part of the interval drives a carry-less range
coder with 64-bit state that emits 16-bit words. Encoder and decoder make the same updates, so
the model is never stored; it starts anew with every block, and a block's checksums cover its
header, its words and its ids. Blocks are rows of Parquet files, which gives atomic commits.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorledger.llm.common import give_back, slices, stored
from motorledger.llm.tokens import encoder, tokenizer_path

END_ID = 2
#: Ids of a block; it is closed with the document that reaches this number.
BLOCK_IDS = 1 << 20
LANES = 4096
#: A slice of texts is tokenized once it holds so many bytes.
_TEXT_BYTES = 4 << 20
_HEADER = struct.Struct("<4sIIIIII")  # magic, ids, lanes, vocabulary, words, crc of words, crc of ids
_MAGIC = b"IDB1"
_PAIR_BITS, _SHARE_BITS, _FREQ_BITS = 17, 14, 18
_RENEW = 16  # steps between renewals of the order-0 frequencies
_TOP, _BOTTOM = np.uint64(1 << 48), np.uint64(1 << 46)
_WORD = np.uint64(16)


#: What a guess's confidence becomes, by (was right) * 8 + confidence; a wrong guess of none is replaced.
_SHIFT = np.array([0, -1, -2, -2, -2, -2, -2, -2, 1, 1, 1, 1, 1, 1, 1, 0], np.int32)


class _Model:
    """The shared predictions; the same calls in the same order give the same state on both sides.

    A context's state is one number, its guess times 8 plus the confidence from 0 to 7.
    """

    def __init__(self, vocabulary: int, lanes: int):
        self.state1 = np.zeros(vocabulary, np.int32)
        self.state2 = np.zeros(1 << _PAIR_BITS, np.int32)
        self.outcomes = np.tile(np.array([0.4, 0.4, 0.4]), (64, 1))
        self.counts = np.ones(vocabulary, np.float64)
        self.shares = np.empty(vocabulary, np.float64)
        self.freq, self.until = np.empty(vocabulary, np.uint64), np.empty(vocabulary, np.uint64)
        self.fresh: list[np.ndarray] = []  # ids not yet counted
        self.told: list[np.ndarray] = []  # classes with outcomes not yet counted
        self.last = np.zeros(lanes, np.int64)
        self.slot = np.zeros(lanes, np.int64)
        self.steps = 0
        self._renew()

    def _renew(self) -> None:
        if self.fresh:
            met = np.bincount(np.concatenate(self.fresh), minlength=len(self.counts))
            met *= 24
            self.counts += met
            self.outcomes += np.bincount(np.concatenate(self.told), minlength=192).reshape(64, 3)
            self.fresh, self.told = [], []
        free = (1 << _FREQ_BITS) - len(self.counts)
        freq = self.freq.view(np.int64)  # tables are renewed in place
        np.copyto(freq, np.multiply(self.counts, free / self.counts.sum(), out=self.shares), casting="unsafe")
        freq += 1
        freq[-1] += (1 << _FREQ_BITS) - int(freq.sum())  # what rounding left
        np.cumsum(self.freq, out=self.until)
        self.until -= self.freq
        self.owner: np.ndarray | None = None
        whole = self.outcomes.sum(1, keepdims=True)
        shares = 1 + ((self.outcomes[:, :2] / whole) * ((1 << _SHARE_BITS) - 3)).astype(np.int64)
        both = shares.sum(1)
        #: by class: where order 2 and order 1 end, and the share of order 0
        self.end2, self.end1 = shares[:, 0] << _FREQ_BITS, both << _FREQ_BITS
        self.rest = (1 << _SHARE_BITS) - both
        #: by class * 3 + outcome: a part's start, its size, and what an id's order-0 interval is scaled by
        self.scales = np.stack([0 * both, 0 * both, self.rest], 1).reshape(-1).astype(np.uint64)
        self.starts = np.stack([0 * both, self.end2, self.end1], 1).reshape(-1).astype(np.uint64)
        self.sizes = np.stack([self.end2, self.end1 - self.end2, 0 * both], 1).reshape(-1).astype(np.uint64)

    def holder(self, value: np.ndarray) -> np.ndarray:
        """The id whose order-0 interval holds ``value``."""
        if self.owner is None:
            self.owner = np.repeat(np.arange(len(self.counts), dtype=np.int32), self.freq.astype(np.int64))
        return self.owner.take(value)

    def look(self):
        """What is predicted for every lane: the states of both contexts, both guesses, and their class."""
        s2, s1 = self.state2.take(self.slot), self.state1.take(self.last)
        return s2, s1, s2 >> 3, s1 >> 3, ((s2 & 7) << 3) | (s1 & 7)

    def learn(self, ids: np.ndarray, told: np.ndarray, look) -> None:
        """Take in the ids of a step; ``told`` is class * 3 + outcome."""
        s2, s1, g2, g1, _ = look
        short = ids.astype(np.int32)
        new = short << 3
        for table, spot, state, said in ((self.state2, self.slot, s2, g2), (self.state1, self.last, s1, g1)):
            mark = ((said == short).view(np.int8) << 3) | (state & 7).astype(np.int8)
            then = state + _SHIFT.take(mark)
            np.copyto(then, new, where=mark == 0)
            table[spot] = then
        self.told.append(told)
        self.fresh.append(ids)
        self.slot = ((self.last * 0x9E3779B1 + ids * 0x85EBCA6B) >> 12) & ((1 << _PAIR_BITS) - 1)
        self.last = ids
        self.steps += 1
        if self.steps % _RENEW == 0 or self.steps < 4:
            self._renew()


def _interval(model: _Model, ids: np.ndarray, outcome: np.ndarray, kind: np.ndarray):
    """Class with outcome (0, 1, 2 for order 2, 1, 0), and the id's start and size out of 2**32."""
    told = (kind * 3 + outcome).astype(np.intp)
    scale = model.scales.take(told)  # 0 but for order 0
    start = model.starts.take(told) + scale * model.until.take(ids)
    return told, start, model.sizes.take(told) + scale * model.freq.take(ids)


def _cut(low: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """The ranges of lanes that must give out a word, shortened where the top word is not settled."""
    open_ = (low ^ (low + wide)) >= _TOP
    return np.where(open_, (~low + np.uint64(1)) & (_TOP - np.uint64(1)), wide)


def encode_block(ids: np.ndarray, vocabulary: int) -> bytes:
    """One self-contained block of ``ids`` (uint32, all below ``vocabulary``)."""
    count = len(ids)
    lanes = max(1, min(LANES, count // 64))
    steps = -(-count // lanes)
    dealt = np.zeros(lanes * steps, np.int64)
    dealt[:count] = ids
    dealt = np.ascontiguousarray(dealt.reshape(lanes, steps).T)
    model = _Model(vocabulary, lanes)
    low, wide = np.zeros(lanes, np.uint64), np.full(lanes, np.uint64((1 << 64) - 1))
    owners: list[np.ndarray] = []
    words: list[np.ndarray] = []
    for now in dealt:
        look = model.look()
        g2, g1, kind = look[2:]
        outcome = (g2 != now).view(np.int8) * (2 - (g1 == now).view(np.int8))
        told, start, size = _interval(model, now, outcome, kind)
        unit = wide >> np.uint64(32)
        low += start * unit
        wide = size * unit
        at = np.flatnonzero(wide < _BOTTOM)
        while len(at):
            part = low[at]
            reach = _cut(part, wide[at]) << _WORD
            owners.append(at)
            words.append((part >> np.uint64(48)).astype(np.uint16))
            low[at], wide[at] = part << _WORD, reach
            at = at[reach < _BOTTOM]
        model.learn(now, told, look)
    for shift in (48, 32, 16, 0):
        owners.append(np.arange(lanes))
        words.append((low >> np.uint64(shift)).astype(np.uint16))
    owner = np.concatenate(owners).astype(np.uint16)  # of 16 bits: sorted by digits
    stream = np.concatenate(words)[np.argsort(owner, kind="stable")]
    body = np.bincount(owner, minlength=lanes).astype("<u4").tobytes() + stream.astype("<u2").tobytes()
    head = (_MAGIC, count, lanes, vocabulary, len(stream), zlib.crc32(body), zlib.crc32(ids.astype("<u4").tobytes()))
    return _HEADER.pack(*head) + body


def decode_block(block: bytes) -> np.ndarray:
    """The ids of one block; raises if a checksum fails."""
    magic, count, lanes, vocabulary, length, words_crc, ids_crc = _HEADER.unpack_from(block)
    body = block[_HEADER.size :]
    if magic != _MAGIC or zlib.crc32(body) != words_crc:
        raise ValueError("damaged token block")
    sizes = np.frombuffer(body, "<u4", lanes).astype(np.int64)
    stream = np.concatenate([np.frombuffer(body, "<u2", length, 4 * lanes).astype(np.uint64), np.zeros(4, np.uint64)])
    spot = np.cumsum(sizes) - sizes
    code = np.zeros(lanes, np.uint64)
    for _ in range(4):
        code = (code << _WORD) | stream[spot]
        spot += 1
    steps = -(-count // lanes)
    out = np.empty((steps, lanes), np.int64)
    model = _Model(vocabulary, lanes)
    low, wide = np.zeros(lanes, np.uint64), np.full(lanes, np.uint64((1 << 64) - 1))
    for step in range(steps):
        look = model.look()
        g2, g1, kind = look[2:]
        unit = wide >> np.uint64(32)
        value = np.minimum((code - low) // unit, np.uint64((1 << 32) - 1)).astype(np.int64)
        end1 = model.end1.take(kind)
        beyond = value >= end1
        outcome = (value >= model.end2.take(kind)).view(np.int8) + beyond.view(np.int8)
        # below 2**32 by at most 2**14, whole numbers: the quotient of doubles never rounds up to the next
        inner = (np.maximum(value - end1, 0) / model.rest.take(kind)).astype(np.int64)
        plain = model.holder(np.minimum(inner, (1 << _FREQ_BITS) - 1))
        now = np.where(beyond, plain, np.where(outcome == 0, g2, g1)).astype(np.int64)
        # a guess of the lower order that order 2 made as well is never coded by that order
        told, start, size = _interval(model, now, outcome, kind)
        low += start * unit
        wide = size * unit
        at = np.flatnonzero(wide < _BOTTOM)
        while len(at):
            part = low[at]
            reach = _cut(part, wide[at]) << _WORD
            code[at] = (code[at] << _WORD) | stream[spot[at]]
            spot[at] += 1
            low[at], wide[at] = part << _WORD, reach
            at = at[reach < _BOTTOM]
        out[step] = now
        model.learn(now, told, look)
    ids = np.ascontiguousarray(out.T).reshape(-1)[:count].astype(np.uint32)
    if zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("token block does not give back its ids")
    return ids


_BLOCKS = "part int, block int, n_ids long, doc_ids array<long>, lengths array<int>, payload binary"


def _write_task(path: str, end_id: int, block_ids: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        vocabulary = max(encode.tokenizer.get_vocab_size(), end_id + 1)
        part, number = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate(held)
            columns = [
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(ids)], pa.int64()),
                pa.array([keys], pa.list_(pa.int64())), pa.array([[len(h) for h in held]], pa.list_(pa.int32())),
                pa.array([encode_block(ids, vocabulary)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["part", "block", "n_ids", "doc_ids", "lengths", "payload"])

        for batch, texts in slices(batches, most=_TEXT_BYTES):
            for key, ids in zip(batch.column(0).to_pylist(), encode.encode(texts)):
                keys.append(key)
                held.append(np.append(ids, np.uint32(end_id)))
                size += len(ids) + 1
                if size >= block_ids:
                    yield block()
                    keys, held, size, number = [], [], 0, number + 1
        if held:
            yield block()
        keys, held = [], []
        give_back()

    return run


def write_ids(docs: DataFrame, path: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write the ids of all texts, each followed by ``end_id``, in ascending ``doc_id``; the written blocks.

    Null ids come first, ties are ordered by text; null texts are the end id alone; an empty table
    writes no blocks. Blocks are numbered within the parts of the range partitioning.
    """
    pairs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = pairs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(_write_task(path or tokenizer_path(), end_id, block_ids), _BLOCKS), "token-ids")


def _read_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            ids = decode_block(one.column("payload")[0].as_py())
            lengths = np.array(one.column("lengths")[0].as_py(), np.int64)
            stops = np.cumsum(lengths)
            data = ids.astype("<u4")
            sums = [zlib.crc32(data[b - n : b]) for b, n in zip(stops.tolist(), lengths.tolist())]
            repeat = lambda name: pa.array([one.column(name)[0].as_py()] * len(lengths), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [repeat("part"), repeat("block"), one.column("doc_ids")[0].values, pa.array(stops - lengths), pa.array(lengths), pa.array(sums, pa.int64())],
                ["part", "block", "doc_id", "inner", "n_tokens", "ids_crc32"],
            )
    give_back()


def read_ids(blocks: DataFrame) -> DataFrame:
    """One row per document as decoded from ``blocks``: where its ids start, how many, their checksum."""
    spark = blocks.sparkSession
    totals = sorted(tuple(r) for r in blocks.groupBy("part").agg(F.sum("n_ids")).collect())  # a row per written part
    begins, at = [], 0
    for part, total in totals:
        begins.append((part, at))
        at += total
    parts = spark.createDataFrame(begins, "part int, base long")
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    places = blocks.select("part", "block", "n_ids").withColumn("inside", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    places = places.join(parts, "part").select("part", "block", (F.col("base") + F.col("inside")).alias("base"))
    found = blocks.select("part", "block", "doc_ids", "lengths", "payload").mapInArrow(
        _read_task, "part int, block int, doc_id long, inner long, n_tokens long, ids_crc32 long"
    )
    return found.join(places, ["part", "block"]).select(
        "doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )
