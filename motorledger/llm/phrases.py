"""Phrase mining by dynamic itemset counting.

The texts are dealt into shards, which are scanned in turn, over and over. At first only single
words are counted. A phrase reaches the threshold at the step (one scan of one shard) in which its
count so far does; from the next step on, longer phrases whose two subphrases (without the last
word, without the first) have both reached it are counted as well. Lengths are so interleaved in
one scan, and each phrase is counted for exactly one full cycle of the shards, which makes its
count exact. The scans end one cycle after the last phrase of less than the greatest length has
reached the threshold.

What tasks must know of earlier steps is a table of fixed size: the step at which a phrase reached
the threshold, kept at a slot named by the phrase's hash (the least step where phrases share a
slot, which is final once set). A shared slot may start a rare phrase early or for nothing; it is
then still counted for one full cycle, and never changes the count of another.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorledger.llm.common import give_back, noting, release, slices, stored

#: Shards of the texts, so steps of a cycle.
SHARDS = 4
MIN_COUNT = 30
MAX_WORDS = 4
#: A phrase goes if a longer one that holds it has so many percent of its count.
CLOSED_PERCENT = 80
TOP = 2000
SCORE_SCALE = 2_000_000
#: Slots of the table of reached phrases, one byte each: the bound of what is broadcast and collected.
SLOTS = 1 << 24
#: Parts of a language in which the best phrases are found before those of the language.
PARTS = 32
UNKNOWN = "und"
_NEVER = 255
_MARK = b"\xff"  # no byte of UTF-8 text; ends a piece
_PREPARED = bytes(
    b + 32 if 65 <= b <= 90 else 255 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)
)
_TURN = 0x9E3779B97F4A7C15
#: Odd numbers that weigh the bytes of a word by their place; longer words use them again.
_WEIGHTS = np.random.default_rng(7).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: A slice of texts is closed once it holds so many bytes.
_TEXT_BYTES = 4 << 20
#: Language and phrase as one text, parted by a line end, which no phrase holds.
_COUNTED = "name string, words int, start int, n long"


def _word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit number for each of these binary words. Words may share one: only slots depend on it."""
    offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4)
    flat = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    starts, sizes = (offsets[:-1] - offsets[0]).astype(np.int64), np.diff(offsets)
    place = np.arange(len(flat)) - np.repeat(starts, sizes)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((flat + np.uint64(1)) * _WEIGHTS[place % len(_WEIGHTS)])])
    mixed = sums[starts + sizes] - sums[starts] + sizes.astype(np.uint64) * np.uint64(_TURN)
    return (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)


def _slot_of(hashes: np.ndarray, slots: int) -> np.ndarray:
    return ((hashes * np.uint64(_TURN)) >> np.uint64(64 - (slots - 1).bit_length())).astype(np.int64)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those of all but the last word and of the last word."""
    return (left ^ (left >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + right


def pieces_of(texts: Iterable[bytes | None]) -> pa.Array:
    """The lower-cased words of all texts in a row, with ``_MARK`` after each piece and text."""
    joined = b"\xff".join(t for t in texts if t).translate(_PREPARED).replace(_MARK, b" \xff ") + b" \xff"
    # the kernel parts at ASCII blanks, which are those that are left, and never checks the encoding
    whole = pa.Array.from_buffers(pa.large_utf8(), 1, [None, pa.py_buffer(np.array([0, len(joined)], np.int64)), pa.py_buffer(joined)])
    words = pc.ascii_split_whitespace(whole).flatten().view(pa.large_binary())
    return words.filter(pc.greater(pc.binary_length(words), 0)).cast(pa.binary())


class _Scan:
    """Counts the phrases of one slice of texts of one language that are active at ``step``."""

    def __init__(self, reached: np.ndarray, step: int, shards: int, longest: int):
        self.reached, self.step, self.shards, self.longest = reached, step, shards, longest

    def count(self, lang: str, texts: list[bytes | None]) -> Iterator[pa.RecordBatch]:
        words = pieces_of(texts)
        coded = words.dictionary_encode()
        dictionary = coded.dictionary
        codes = coded.indices.to_numpy().astype(np.int64)
        size_of, mark = len(dictionary), pc.index(dictionary, _MARK).as_py()
        ends = codes == mark
        hashes = _word_hashes(dictionary)
        if self.step < self.shards:  # single words, and all of them together as a phrase of none
            found = np.bincount(codes, minlength=size_of)
            found[mark] = 0
            kept = np.flatnonzero(found)
            yield from self._rows(lang, dictionary.take(pa.array(kept)), 1, np.zeros(len(kept), np.int64), found[kept])
            yield from self._rows(lang, pa.array([b""]), 0, np.zeros(1, np.int64), found.sum(keepdims=True))
        base = _word_hashes(pa.array([lang.encode()], pa.binary()))
        first = _joined(np.repeat(base, size_of), hashes)
        since = self.reached[_slot_of(first, len(self.reached))].astype(np.int64)[codes]
        since[ends] = _NEVER
        # places of phrases that have reached the threshold: their step of that, hash and number
        place, chain, number = np.arange(len(codes)), first[codes], codes
        for size in range(2, self.longest + 1):
            pair = np.flatnonzero((since[:-1] < _NEVER) & (since[1:] < _NEVER) & (place[1:] == place[:-1] + 1))
            start = 1 + np.maximum(since[pair], since[pair + 1])
            place, chain, number = place[pair], chain[pair], number[pair]
            last = codes[place + size - 1]
            # equal phrases have equal numbers: that of all but the last word, and the last word
            number = number * size_of + last
            active = (start <= self.step) & (self.step < start + self.shards)
            if active.any():
                _, at, times = np.unique(number[active], return_index=True, return_counts=True)
                spots = place[active][at]
                parts = [dictionary.take(pa.array(codes[spots + i])) for i in range(size)]
                phrases = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))
                yield from self._rows(lang, phrases, size, start[active][at], times)
            if size < self.longest:
                chain = _joined(chain, hashes[last])
                since = np.maximum(self.reached[_slot_of(chain, len(self.reached))], start).astype(np.int64)
                here = np.flatnonzero(since < _NEVER)
                since, place, chain = since[here], place[here], chain[here]
                number = np.unique(number[here], return_inverse=True)[1]

    @staticmethod
    def _rows(lang: str, phrases: pa.Array, size: int, start: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        names = pc.binary_join_element_wise(pa.scalar(lang.encode(), pa.binary()), phrases, pa.scalar(b"\n", pa.binary())).cast(pa.string())
        for at in range(0, len(n), 50_000):
            part = names[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [
                    part, pa.array(np.full(len(part), size, np.int32)),
                    pa.array(start[at : at + 50_000].astype(np.int32)), pa.array(n[at : at + 50_000].astype(np.int64)),
                ],
                ["name", "words", "start", "n"],
            )


def slots_of(names: pa.Array, slots: int) -> np.ndarray:
    """The slots of phrases, named like counted rows, in the table of reached phrases."""
    parts = pc.split_pattern(names.cast(pa.string()), "\n", max_splits=1, reverse=True)
    value = _word_hashes(pc.list_element(parts, 0).cast(pa.binary()))
    lists = pc.split_pattern(pc.list_element(parts, 1), " ")
    offsets = lists.offsets.to_numpy()
    words, sizes = _word_hashes(lists.flatten().cast(pa.binary())), np.diff(offsets)
    for k in range(int(sizes.max(initial=0))):
        more = sizes > k
        value[more] = _joined(value[more], words[offsets[:-1][more] - offsets[0] + k])
    return _slot_of(value, slots)


def _slots_task(slots: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(slots_of(batch.column(0), slots).astype(np.int32))], ["slot"])

    return run


def _scan_task(reached, step: int, shards: int, longest: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _Scan(np.frombuffer(reached.value, np.uint8), step, shards, longest)
        for batch, texts in slices(batches, most=_TEXT_BYTES):
            langs = batch.column(0).to_pylist()
            for lang in sorted(set(langs)):
                yield from scan.count(lang, [t for t, mine in zip(texts, langs) if mine == lang])
        give_back()

    return run


def counted(
    docs: DataFrame, least: int = MIN_COUNT, longest: int = MAX_WORDS, shards: int = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """``lang``, ``phrase``, ``words`` and the exact count ``n`` of every phrase that occurs ``least`` times or more.

    Phrases stand within a piece of a text and have 1 to ``longest`` words; the row with ``words`` 0
    has the number of all words of its language. ``slots`` is a power of two.
    """
    if shards * longest + longest >= _NEVER:
        raise ValueError("too many shards: the steps must be fewer than 255")
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text"),
        (F.monotonically_increasing_id() % shards).alias("shard"),
    )
    with noting() as shard_folders:
        dealt = stored(rows, "shards", by="shard")
    reached = np.full(slots, _NEVER, np.uint8)
    state, folders, step, last = None, [], 0, -1
    while step < max(shards, last + 1 + shards):
        sent = spark.sparkContext.broadcast(reached.tobytes())
        mine = dealt.filter(F.col("shard") == step % shards).select("lang", "text")
        now = mine.mapInArrow(_scan_task(sent, step, shards, longest), _COUNTED).withColumn("reached", F.lit(None).cast("int"))
        both = now if state is None else now.unionByName(state)
        # words and start are the same in all rows of a phrase
        alike = [F.min(c).alias(c) for c in ("words", "start", "reached")]
        sums = both.groupBy("name").agg(F.sum("n").alias("n"), *alike)
        over = (F.col("n") >= least) | ((F.col("words") == 0) & (F.col("n") > 0))
        # what has had its cycle without reaching the threshold is done with
        sums = sums.filter(over | (F.col("start") + shards - 1 > step))
        marked = sums.withColumn("reached", F.coalesce("reached", F.when(over, F.lit(step))))
        before = folders
        with noting() as folders:
            state = stored(marked, f"phrases-{step}")
        fresh = state.filter((F.col("reached") == step) & F.col("words").between(1, longest - 1))
        found = fresh.select("name").mapInArrow(_slots_task(slots), "slot int").distinct()
        new = found.toArrow().column(0).to_numpy().astype(np.int64)  # `slots` rows at most, by one job
        if len(new):
            reached[new] = np.minimum(reached[new], step)
            last = step
        release(spark, before)
        sent.destroy()
        step += 1
    release(spark, shard_folders)
    phrase = F.substring_index("name", "\n", -1)
    lang = F.left("name", F.length("name") - F.length(phrase) - 1)
    whole = state.filter(F.col("n") >= F.when(F.col("words") == 0, 1).otherwise(least))
    return stored(whole.select(lang.alias("lang"), phrase.alias("phrase"), "words", "n"), "phrase-counts")


def _cuts(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """``phrases`` with the lowest-scoring cut into a first part of count ``l`` and a rest of count ``r``."""
    words = F.split("phrase", " ")
    cut = phrases.select("lang", "phrase", "words", "a", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.select(
        "lang", "phrase", "words", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"),
    )
    known = lambda part, n: counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(n))
    both = cut.join(known("first", "l"), ["lang", "first"]).join(known("rest", "r"), ["lang", "rest"])
    # the product may need more than 64 bits; the quotient is at most half of the scale
    score = F.expr(f"cast({SCORE_SCALE} as decimal(38, 0)) * cast(a as decimal(20, 0)) div (l + r)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return both.groupBy("lang", "phrase", "words", "a").agg(lowest).select("lang", "phrase", "words", "a", "cut.*")


def _closed(phrases: DataFrame, percent: int) -> DataFrame:
    """``phrases`` without those inside a longer one that is nearly as frequent."""
    longer = phrases.filter("words > 2").select("lang", "words", F.col("a").alias("of"), F.split("phrase", " ").alias("w"))
    parts = F.expr(
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), s -> array_join(slice(w, s, m), ' '))))"
    )
    most = longer.select("lang", "of", F.explode(parts).alias("phrase")).groupBy("lang", "phrase").agg(F.max("of").alias("of"))
    joined = phrases.join(most, ["lang", "phrase"], "left")
    return joined.filter(F.col("of").isNull() | (100 * F.col("of") < percent * F.col("a"))).drop("of")


def collocations(
    docs: DataFrame, top: int = TOP, least: int = MIN_COUNT, longest: int = MAX_WORDS, shards: int = SHARDS,
    slots: int = SLOTS, percent: int = CLOSED_PERCENT,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, words, a, l, r, n, score.

    A phrase of 2 to ``longest`` words is a candidate if it occurs ``a`` >= ``least`` times; its score is
    the lowest, over all cuts into two parts, of ``SCORE_SCALE * a / (l + r)``, rounded down. Of equal
    scores the shortest first part counts. Candidates inside a longer one with ``percent`` of their
    count go. Ranks are by score, count, then phrase in byte order; ``n`` is the number of words of the
    language. A null language is ``und``; null, empty and blank texts have no words; a repeated row
    counts each time; other columns are ignored; an empty table gives no rows.
    """
    counts = counted(docs, least, longest, shards, slots)
    candidates = counts.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    found = _cuts(_closed(candidates, percent), counts.filter(F.col("words").between(1, longest - 1)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    # the best of a part first, so that no task ranks a whole language
    found = found.withColumn("at", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).filter(F.col("at") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    sizes = counts.filter("words = 0").select("lang", F.col("n"))
    return found.join(sizes, "lang").select("lang", "rank", "phrase", "words", "a", "l", "r", "n", "score")
