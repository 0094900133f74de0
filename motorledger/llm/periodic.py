"""Periodic runs of words, found by multi-scale minimizers.

A run of period q and length at least 4q repeats every group of k words at distance q. At the
scale k the groups of k words are hashed and each window of k/2 groups selects its least one.
Inside a run the choice repeats with the period, so some selected group comes again exactly q
words later; as k is at least q, it does not come earlier. Neighbouring equal selections at a
distance in (k/2, k] are therefore seeds of all runs with such a period. A seed is extended word by
word to the longest stretch of its period, so hash collisions never make a run. Periods up to
``SHORT`` are scanned directly, word against word, at each lag.

Texts are handled in slices of a few megabytes. The words of a slice are numbered, and texts
stand in one array with a separator of its own after each, so no step loops over texts or words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorledger.llm.common import attached

#: Least length of a run, in words and in periods.
MIN_WORDS = 6
MIN_PERIODS = 4
#: Periods up to this are scanned at each lag; the first scale is twice as long.
SHORT = 8
#: A slice of texts is closed once it holds so many bytes.
TEXT_BYTES = 4 << 20
_FOUND = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def words_of(texts: list[bytes | None]) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in a row, and the number of words of each text."""
    lists = [t.split() if t else [] for t in texts]
    return pa.array([w for words in lists for w in words], pa.large_binary()), np.array([len(x) for x in lists], np.int64)


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and ends of the stretches of true values."""
    turns = np.flatnonzero(np.diff(same.astype(np.int8), prepend=0, append=0))
    return turns[::2], turns[1::2]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _selected(groups: np.ndarray, window: int) -> np.ndarray:
    """Ascending places of the groups that are the least, first ones among equals, of a window."""
    bits = np.uint64(int(len(groups)).bit_length())
    least = (groups >> bits << bits) | np.arange(len(groups), dtype=np.uint64)
    width = 1
    while width < window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    places = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    places = places[np.concatenate([[True], places[1:] != places[:-1]])]
    return np.unique(places)


def _extended(x: np.ndarray, at: int, period: int, side: int) -> int:
    """How many places from ``at`` on, going by ``side``, hold the word of one period later."""
    count, step = 0, 64
    while True:
        if side > 0:
            size = min(step, len(x) - period - at - count)
            differ = x[at + count : at + count + size] != x[at + count + period : at + count + period + size]
        else:
            size = min(step, at + 1 - count)
            low = at + 1 - count - size
            differ = (x[low : low + size] != x[low + period : low + period + size])[::-1]
        if size <= 0:
            return count
        spot = int(differ.argmax())
        if differ[spot]:
            return count + spot
        count, step = count + size, step * 2


def _seeded(x: np.ndarray, groups: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """Runs (start, end, period) with a period in (k/2, k], from neighbouring equal minimizers."""
    places = _selected(groups, k // 2)
    order = np.lexsort((places, groups[places]))
    places = places[order]
    gap = np.diff(places)
    seeds = (groups[places[1:]] == groups[places[:-1]]) & (gap > k // 2) & (gap <= k)
    first, period = places[:-1][seeds], gap[seeds]
    done, covered = 0, -1  # the stretch found last and its period
    for turn in np.lexsort((first, period)):
        at, q = int(first[turn]), int(period[turn])
        if q == done and at < covered:
            continue
        if x[at] != x[at + q]:
            continue  # a collision
        start = at + 1 - _extended(x, at, q, -1)
        end = at + _extended(x, at, q, 1) + q
        done, covered = q, end - q
        if end - start >= max(MIN_WORDS, MIN_PERIODS * q):
            yield start, end, q


def find_runs(x: np.ndarray, longest: int | None = None, short: int = SHORT) -> np.ndarray:
    """All runs of an array of word numbers as rows (start, end, period), by start, then period.

    No run is longer than ``longest``, the longest text in the array. Of two periods of one stretch the smaller counts; as the stretch holds four of them, it
    divides the larger. ``short`` must be a power of two.
    """
    longest = len(x) if longest is None else longest
    found = [np.empty((0, 3), np.int64)]
    for q in range(1, min(short, longest // MIN_PERIODS) + 1):
        starts, ends = _stretches(x[q:] == x[:-q])
        long = ends + q - starts >= max(MIN_WORDS, MIN_PERIODS * q)
        found.append(np.stack([starts[long], ends[long] + q, np.full(int(long.sum()), q)], axis=1))
    groups, k = _mixed(x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), 1
    while MIN_PERIODS * (k // 2 + 1) <= longest:
        if k > short:
            found.append(np.array(list(_seeded(x, groups, k)), np.int64).reshape(-1, 3))
        if len(groups) <= k:
            break
        groups = _mixed(groups[:-k] * np.uint64(0x9E3779B97F4A7C15) + groups[k:])
        k *= 2
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    other = np.ones(len(runs), bool)
    other[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[other]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _runs_of_texts(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs (start, end, period) of texts that stand in a row, as places in ``codes``.

    Longer scales only read the texts that are long enough for them.
    """
    ends = np.cumsum(sizes)
    out = [np.empty((0, 3), np.int64)]
    # texts are grouped by length, so that a scale reads only texts that may hold its periods
    rank = np.ceil(np.log2(np.maximum(sizes, 1) / (2 * SHORT))).clip(0).astype(np.int64)
    for level in np.unique(rank[sizes >= MIN_WORDS]):
        mine = np.flatnonzero((rank == level) & (sizes >= MIN_WORDS))
        lengths = sizes[mine]
        begin = np.cumsum(lengths + 1) - (lengths + 1)
        place = np.arange(int(lengths.sum())) + np.repeat(np.arange(len(mine)), lengths)
        source = np.arange(int(lengths.sum())) + np.repeat(ends[mine] - lengths - (np.cumsum(lengths) - lengths), lengths)
        x = np.empty(int(lengths.sum()) + len(mine), np.int64)
        x[place] = codes[source]
        x[begin + lengths] = -1 - np.arange(len(mine))  # a separator of its own
        runs = find_runs(x, int(lengths.max()))
        text = np.searchsorted(begin, runs[:, 0], "right") - 1
        runs[:, :2] += (ends[mine] - lengths - begin)[text][:, None]
        out.append(runs)
    runs = np.concatenate(out)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _judge(texts: list[bytes | None]) -> pa.StructArray:
    words, sizes = words_of(texts)
    ends = np.cumsum(sizes)
    codes = pc.dictionary_encode(words).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    runs = _runs_of_texts(codes, sizes)
    text = np.searchsorted(ends, runs[:, 0], "right")
    cuts = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
    listed = pa.StructArray.from_arrays(
        [pa.array(runs[:, 0] - (ends - sizes)[text]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])], fields=list(_RUN)
    )
    edges = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 1], -1)
    kept = np.cumsum(edges[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], ends])]
    lists = pa.LargeListArray.from_arrays(pa.array(left), words.filter(pa.array(kept)))
    collapsed = pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))
    return pa.StructArray.from_arrays(
        [pa.array(sizes), pa.ListArray.from_arrays(pa.array(cuts), listed), collapsed.cast(pa.string())], ["n_words", "runs", "collapsed"]
    )


def _finder(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for part in parts:
        texts = part.cast(pa.large_binary()).to_pylist()
        out, first, size = [], 0, 0
        for at, text in enumerate(texts, 1):
            size += len(text) if text else 0
            if size >= TEXT_BYTES or at == len(texts):
                out.append(_judge(texts[first:at]))
                first, size = at, 0
        yield pa.concat_arrays(out) if out else _judge([])


def with_runs(docs: DataFrame, text: str = "text", to: str = "q") -> DataFrame:
    """Every row of ``docs`` with a struct ``to`` of its number of words, runs and collapsed text.

    A run is a stretch of words with smallest period q, at least ``MIN_WORDS`` and
    ``MIN_PERIODS`` periods long, that no neighbouring word extends. ``runs`` are in order of
    start, then period; ``collapsed`` holds the words that no run has after its first period,
    joined by one space. Null, empty and blank texts have no words, no runs and an empty
    collapsed text. Rows are judged one by one, so repeated rows and null or repeated ids need no
    rule; an empty table gives no rows. A column of ``docs`` named like ``to`` is replaced.
    """
    _finder.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return attached(docs, F.arrow_udf(_finder, _FOUND)(F.col(text).cast("string")), to)
