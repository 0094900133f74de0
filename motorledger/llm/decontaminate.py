"""Benchmark decontamination over a positional inverted index of the training texts.

The index is cut by documents: every task turns its texts into segments of a few megabytes and
stores, per segment and term, the ascending word positions as gaps. One row without a term
lists the segment's documents. A term that is hot in the whole collection is short in every
segment, so no list outgrows one, and building the index moves no rows between tasks.

A query takes its windows in blocks of bounded size. Per block the lists of the block's terms
are read and met by segment; a window's lists are intersected after shifting each by the
term's offset, the shortest (rarest) list first, so most windows end after one look-up.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorledger.llm.common import SLICE_BYTES, slices, stored

WINDOW_WORDS = 10
#: Text of the windows looked up in one pass.
BLOCK_BYTES = 4 << 20
#: Lower-cases A-Z; every other ASCII byte but digits and letters becomes a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_INDEX = "segment long, term string, gaps array<int>, keys array<long>, lengths array<int>"
_FOUND = "segment long, doc int, key long, n_words long, starts array<int>, ends array<int>, items array<string>, near array<string>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


def _as_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema
    )


_INDEX_ARROW = pa.schema(
    [
        ("segment", pa.int64()), ("term", pa.string()), ("gaps", pa.list_(pa.int32())),
        ("keys", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())),
    ]
)


def _segment(number: int, keys: pa.Array, texts: list[bytes | None]) -> Iterator[pa.RecordBatch]:
    lengths, tokens = [], []
    for text in texts:
        found = words_of(text)
        lengths.append(len(found))
        tokens += found
    yield _as_batch(
        _INDEX_ARROW,
        segment=pa.array([number]),
        keys=pa.array([keys.to_pylist()], pa.list_(pa.int64())),
        lengths=pa.array([lengths], pa.list_(pa.int32())),
    )
    if not tokens:
        return
    # one unused position between documents, so that no phrase runs across
    positions = np.arange(len(tokens), dtype=np.int32) + np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    coded = pa.array(tokens, pa.binary()).dictionary_encode()
    del tokens
    rank = np.empty(len(coded.dictionary), np.int64)
    sorting = pc.sort_indices(coded.dictionary).to_numpy()
    rank[sorting] = np.arange(len(sorting))
    codes = rank[coded.indices.to_numpy()]
    order = np.argsort(codes, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(rank)))])
    gaps = np.diff(positions[order], prepend=np.int32(0))
    gaps[offsets[:-1]] = positions[order][offsets[:-1]]
    terms = coded.dictionary.take(pa.array(sorting)).cast(pa.string())
    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(gaps))
    for at in range(0, len(terms), 50_000):
        part = terms.slice(at, 50_000)
        yield _as_batch(
            _INDEX_ARROW, segment=pa.array(np.full(len(part), number)), term=part, gaps=lists.slice(at, len(part))
        )


def _index_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 24
    for count, (batch, texts) in enumerate(slices(batches, most=SLICE_BYTES)):
        yield from _segment(base + count, batch.column(0), texts)


def build_index(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The stored positional index of ``docs``; a null text has no words but keeps its row.

    Columns: ``segment``, ``term`` (ascending within a segment) and ``gaps``, the first word
    position and the distances to the next ones; a row with a null term holds the segment's
    document ``keys`` and word counts ``lengths``.
    """
    pairs = docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    return stored(pairs.mapInArrow(_index_task, _INDEX), "postings")


def lower_words(text: Column) -> Column:
    """The same words as column expression, for short texts such as benchmark items."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lowered, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))


def windows(benchmark: DataFrame, width: int = WINDOW_WORDS) -> DataFrame:
    """Distinct ``words`` windows with their ``item``; items without a word have none."""
    listed = benchmark.select(F.col("item_id").cast("string").alias("item"), lower_words(F.col("text")).alias("w"))
    listed = listed.filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (width - 1)))
    return listed.select("item", "w", F.explode(starts).alias("at")).select(
        F.slice("w", F.col("at"), F.lit(width)).alias("words"), "item"
    ).distinct()


def _shifted(lists: dict[str, np.ndarray], words: tuple[str, ...]) -> np.ndarray | None:
    """Positions at which all words stand in a row: offset-adjusted lists met from the rarest."""
    found = [(lists.get(w), at) for at, w in enumerate(words)]
    if any(have is None for have, _ in found):
        return None
    found.sort(key=lambda pair: len(pair[0]))
    starts = found[0][0] - found[0][1]
    for have, at in found[1:]:
        spot = np.searchsorted(have, starts + at)
        spot[spot == len(have)] = 0
        starts = starts[have[spot] == starts + at]
        if not len(starts):
            return None
    return starts


def _close(lists: dict[str, np.ndarray], words: tuple[str, ...], slop: int, document: np.ndarray) -> np.ndarray | None:
    """Positions of the longest word that have every other word within ``slop`` words in the same document."""
    middle = max(set(words), key=lambda w: (len(w), w))
    spots = lists.get(middle)
    found = [lists.get(w) for w in set(words) if w != middle]
    if spots is None or any(have is None for have in found):
        return None
    for have in sorted(found, key=len):
        after = np.searchsorted(have, spots)
        right, left = have[np.minimum(after, len(have) - 1)], have[np.maximum(after - 1, 0)]
        near = lambda other: (np.abs(other - spots) <= slop) & (document[other] == document[spots])
        spots = spots[near(right) | near(left)]
        if not len(spots):
            return None
    return spots


def _matcher(block: list[tuple[tuple[str, ...], list[str]]], slop: int | None):
    """Match one segment's lists against a block of windows; one row per document of the segment."""

    def run(segment: pa.Table) -> pa.Table:
        terms = segment.column("term").to_pylist()
        head = terms.index(None)
        keys, lengths = segment.column("keys")[head].as_py(), np.array(segment.column("lengths")[head].as_py(), np.int64)
        column = segment.column("gaps").combine_chunks()
        offsets, flat = column.offsets.to_numpy(), column.values.to_numpy()
        lists = {t: np.cumsum(flat[offsets[i] : offsets[i + 1]]) for i, t in enumerate(terms) if t is not None}
        first = np.cumsum(lengths + 1) - (lengths + 1)
        total = int(first[-1] + lengths[-1] + 1)
        document = np.repeat(np.arange(len(lengths)), lengths + 1) if slop is not None else None
        edges = np.zeros(total + 1, np.int64)
        items: dict[int, set[str]] = {}
        near: dict[int, set[str]] = {}
        for words, owners in block:
            starts = _shifted(lists, words)
            if starts is not None:
                np.add.at(edges, starts, 1)
                np.add.at(edges, starts + len(words), -1)
                for doc in set((np.searchsorted(first, starts, "right") - 1).tolist()):
                    items.setdefault(doc, set()).update(owners)
            if slop is not None and (spots := _close(lists, words, slop, document)) is not None:
                for doc in set(document[spots].tolist()):
                    near.setdefault(doc, set()).update(owners)
        inside = np.concatenate([[False], np.cumsum(edges[:total]) > 0, [False]])
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        begins, stops = turns[::2], turns[1::2]
        where = np.searchsorted(first, begins, "right") - 1
        cuts = np.searchsorted(where, np.arange(len(lengths) + 1)).astype(np.int32)
        as_lists = lambda values: pa.ListArray.from_arrays(pa.array(cuts), pa.array((values - first[where]).astype(np.int32)))
        named = lambda found: pa.array([sorted(found.get(d, ())) for d in range(len(lengths))], pa.list_(pa.string()))
        return pa.table(
            {
                "segment": pa.array(np.full(len(lengths), segment.column("segment")[0].as_py(), np.int64)),
                "doc": pa.array(np.arange(len(lengths), dtype=np.int32)), "key": pa.array(keys, pa.int64()),
                "n_words": pa.array(lengths), "starts": as_lists(begins), "ends": as_lists(stops),
                "items": named(items), "near": named(near),
            }
        )

    return run


def _merged(rows: DataFrame) -> DataFrame:
    """Put the findings of several blocks together: spans united, items distinct."""

    def run(part: pa.Table) -> pa.Table:
        out: dict[int, list] = {}
        for row in part.to_pylist():
            have = out.setdefault(row["doc"], [row["segment"], row["doc"], row["key"], row["n_words"], [], set(), set()])
            have[4] += zip(row["starts"], row["ends"])
            have[5].update(row["items"])
            have[6].update(row["near"])
        done = []
        for segment, doc, key, n_words, spans, items, near in out.values():
            flat: list[list[int]] = []
            for a, b in sorted(spans):
                if flat and a <= flat[-1][1]:
                    flat[-1][1] = max(flat[-1][1], b)
                else:
                    flat.append([a, b])
            done.append(
                dict(segment=segment, doc=doc, key=key, n_words=n_words, starts=[a for a, _ in flat],
                     ends=[b for _, b in flat], items=sorted(items), near=sorted(near))
            )
        return pa.Table.from_pylist(done, part.schema)

    return rows.groupBy("segment").applyInArrow(run, _FOUND)


def find_windows(
    index: DataFrame, wanted: DataFrame, proximity: int | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """All documents of ``index`` with the spans and items of the ``wanted`` windows they contain.

    Exact matches give ``starts`` and ``ends`` (word spans, united, end exclusive) and ``items``.
    With ``proximity``, ``near`` lists the items of windows whose words all stand within that many
    words of an occurrence of the longest one (of equals, the last in order). Windows of a null item mark words but name no item. Windows are
    looked up in blocks of about ``block_bytes``, so only a block is ever sent to the tasks.
    """
    wanted = stored(wanted, "windows")
    bytes_all = wanted.agg(F.sum(F.length(F.array_join("words", " ")) + 80)).first()[0] or 0
    blocks = max(1, math.ceil(bytes_all / block_bytes))
    found = None
    for number in range(blocks):
        mine = wanted.filter(F.pmod(F.xxhash64("words", "item"), F.lit(blocks)) == number)
        owners: dict[tuple[str, ...], list[str]] = {}
        for words, item in mine.toLocalIterator():
            owners.setdefault(tuple(words), []).extend([] if item is None else [item])
        # the terms of one block, bounded by block_bytes
        terms = F.broadcast(mine.select(F.explode("words").alias("term")).distinct().withColumn("wanted", F.lit(True)))
        read = index.join(terms, "term", "left").filter("wanted OR term IS NULL").drop("wanted")
        part = read.groupBy("segment").applyInArrow(_matcher(list(owners.items()), proximity), _FOUND)
        found = part if found is None else found.unionByName(part)
    return found if blocks == 1 else _merged(found)


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", width: int = WINDOW_WORDS,
    proximity: int | None = None, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of ``docs``: key, n_words, n_hit, spans and items of the benchmark windows inside it.

    Null and empty texts have no words and no hits. Rows that share a key are judged one by one.
    Items without a word have no window; an empty benchmark leaves every document clean.
    """
    found = find_windows(build_index(docs, key), windows(benchmark, width), proximity, block_bytes)
    hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0), lambda x, y: x + y)
    return found.select(
        F.col("key").alias(key), "n_words", hit.cast("long").alias("n_hit"), "starts", "ends", "items", "near"
    )
