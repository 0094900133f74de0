"""Language identification of mixed-language text.

Every word gets a score per language from hashed byte n-grams inside word marks, learned from
labelled documents. The script of a word's first letter narrows the languages that may claim
it. A Viterbi pass over the words of a text, with a penalty for switching, labels spans.

The Viterbi pass runs in blocks: for all blocks of a batch at once, the best score from every
language before the block to every language at its end; then from block to block of a text;
then back through all blocks at once. The result is that of the plain pass over the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorledger.llm.common import slices, stored

#: Scripts by code point ranges. Fixed values of the Unicode standard.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
}
UNKNOWN = "und"
BINS = 1 << 16
GRAMS = 4
#: The model is fitted on at most so many labelled rows, those with the least hash of their id.
TRAINING_ROWS = 4000
SWITCH = 8.0
#: A language uses a script if this share of its letters, at least, is written in it.
SCRIPT_SHARE = 0.01
_FAR = -60.0  # score of a word for a language that does not use its script
_BLOCK = 64
_REMEMBERED = 300_000
#: ASCII without letters becomes a space; words are what stands between.
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_ANY_LETTER = re.compile(r"[^\W\d_]")


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words, cut at every ASCII character that is no letter."""
    return text.decode().lower().encode().translate(_LETTERS).split() if text else []


def script_of(word: str) -> int:
    """The number of the script of the word's first letter; -1 without a letter in a known script."""
    for letter in word:
        if letter.isalpha():
            code = ord(letter)
            for number, ranges in enumerate(SCRIPTS.values()):
                if any(a <= code <= b for a, b in ranges):
                    return number
            return -1
    return -1


def _grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the n-grams of all words, and for each the number of its word."""
    data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    blank = data == 32
    number = np.cumsum(blank) - 1  # the word that starts after this blank, or that the letter is in
    bins, owner = [], []
    code = data.copy()
    for size in range(1, GRAMS + 1):
        if len(data) < size:
            break
        if size > 1:
            code = code[:-1] * np.uint32(0x01000193) + data[size - 1 :] + np.uint32(size)
        count = len(data) - size + 1
        good = np.ones(count, np.bool_)
        for inner in range(1, size - 1):
            good &= ~blank[inner : inner + count]
        if size == 1:
            good &= ~blank
        if size == 2:
            good &= ~(blank[:count] & blank[1 : 1 + count])
        at = np.flatnonzero(good)
        # a gram that ends in a blank belongs to the word before, one that starts with it to the word after
        bins.append(((code[at] * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64))
        owner.append(number[at])
    return np.concatenate(bins), np.concatenate(owner)


def counted(words: list[bytes], times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin counts and letters per script of ``words``, each taken ``times`` over."""
    if not words:
        return np.zeros(BINS), np.zeros(len(SCRIPTS))
    bins, owner = _grams(words)
    scripts, letters = np.zeros(len(SCRIPTS)), times * np.array([len(w) for w in words])
    kinds = np.array([script_of(w.decode()) for w in words])
    for number in range(len(SCRIPTS)):
        scripts[number] = letters[kinds == number].sum()
    return np.bincount(bins, times[owner], BINS), scripts


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    logs: np.ndarray  # bins by languages
    allowed: np.ndarray  # scripts by languages

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """Scores per word and language; 0 for words without a letter, far below for other scripts."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        if not words:
            return out
        bins, owner = _grams(words)
        for column in range(out.shape[1]):
            out[:, column] = np.bincount(owner, self.logs[bins, column], len(words)) / GRAMS
        out -= out.max(1, keepdims=True)
        for at, word in enumerate(words):
            if not word.isascii():
                text = word.decode()
                kind = script_of(text)
                if not _ANY_LETTER.search(text):
                    out[at] = 0
                elif kind >= 0 and self.allowed[kind].any():
                    out[at, ~self.allowed[kind]] = _FAR
        latin = list(SCRIPTS).index("latin")
        if self.allowed[latin].any() and not self.allowed[latin].all():
            plain = np.fromiter((w.isascii() for w in words), np.bool_, len(words))
            out[np.ix_(plain, ~self.allowed[latin])] = _FAR
        return out


def viterbi(scores: np.ndarray, sizes: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The best language of every word, for texts of ``sizes`` words laid end to end in ``scores``."""
    total, states = scores.shape
    if not total:
        return np.zeros(0, np.int64)
    blocks = -(-sizes // _BLOCK)
    text = np.repeat(np.arange(len(sizes)), blocks)
    first_block = np.cumsum(blocks) - blocks
    inside = np.arange(len(text)) - first_block[text]
    begin = (np.cumsum(sizes) - sizes)[text] + inside * _BLOCK
    length = np.minimum(sizes[text] - inside * _BLOCK, _BLOCK)
    move = np.where(np.eye(states, dtype=np.bool_), 0, -penalty).astype(np.float32)
    best = np.repeat(move[None], len(text), axis=0)  # block, language before, language now
    stays = np.zeros((_BLOCK, len(text), states, states), np.bool_)
    origin = np.zeros((_BLOCK, len(text), states), np.int8 if states < 128 else np.int32)
    for step in range(_BLOCK):
        live = step < length
        if not live.any():
            break
        if step:
            top = best.max(2, keepdims=True) - penalty
            stays[step] = best >= top
            origin[step] = best.argmax(2)
            moved = np.where(stays[step], best, top)
            best = np.where(live[:, None, None], moved, best)
        now = np.where(live[:, None], scores[np.minimum(begin + step, total - 1)], 0)
        best = best + now[:, None, :]
    so_far = np.zeros((len(sizes), states))
    before = np.zeros((len(text), states), np.int64)  # the language at the end of the block before
    for turn in range(int(blocks.max())):
        here = np.flatnonzero(blocks > turn)
        at = first_block[here] + turn
        reach = so_far[here][:, :, None] + best[at]
        before[at] = reach.argmax(1)
        so_far[here] = reach.max(1)
    last, enter = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
    state = so_far.argmax(1)
    for turn in range(int(blocks.max()) - 1, -1, -1):
        here = np.flatnonzero(blocks > turn)
        at = first_block[here] + turn
        last[at] = state[here]
        enter[at] = before[at, state[here]]
        state[here] = enter[at]
    out, every, now = np.zeros(total, np.int64), np.arange(len(text)), last
    for step in range(_BLOCK - 1, -1, -1):
        live = step < length
        out[(begin + step)[live]] = now[live]
        if step:
            back = np.where(stays[step, every, enter, now], now, origin[step, every, enter])
            now = np.where(live, back, now)
    return out


class _Scorer:
    """Word scores remembered across the batches of a task."""

    def __init__(self, model: LanguageModel, penalty: float):
        self.model, self.penalty = model, penalty

    def label(self, texts: list[bytes | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray, np.ndarray]:
        lists = [words_of(t) for t in texts]
        sizes = np.array([len(x) for x in lists], np.int64)
        coded = pa.array([w for x in lists for w in x], pa.binary()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        codes = coded.indices.to_numpy()
        scores = self.model.word_scores(distinct)
        counts = np.fromiter((len(w) if w.isascii() else sum(c.isalpha() for c in w.decode()) for w in distinct), np.int64, len(distinct))
        return lists, sizes, viterbi(scores[codes], sizes, self.penalty), counts[codes]

    def judge(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        _, sizes, labels, letters = self.label(texts)
        states = len(self.model.languages)
        text = np.repeat(np.arange(len(sizes)), sizes)
        votes = np.bincount(text * states + labels, letters, len(sizes) * states).reshape(-1, states)
        whole = votes.sum(1)
        names = [self.model.languages[i] if w > 0 else UNKNOWN for i, w in zip(votes.argmax(1).tolist(), whole.tolist())]
        return names, votes.max(1) / np.maximum(whole, 1)


def _count_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bins: dict[str, list[np.ndarray]] = {}
    for batch, texts in slices(batches):
        langs = batch.column(0).to_pylist()
        for lang in set(langs):
            words = [w for l, t in zip(langs, texts) if l == lang for w in words_of(t)]
            coded = pa.array(words, pa.binary()).dictionary_encode()
            found = counted(coded.dictionary.to_pylist(), np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary)))
            have = bins.setdefault(lang, [np.zeros(BINS), np.zeros(len(SCRIPTS))])
            have[0] += found[0]
            have[1] += found[1]
    for lang, (grams, scripts) in bins.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([grams.astype("<f8").tobytes()], pa.binary()), pa.array([scripts.tolist()])], ["lang", "grams", "scripts"]
        )


def train(docs: DataFrame, usable: Column, rows: int = TRAINING_ROWS) -> LanguageModel:
    """Fit on the documents for which ``usable`` holds and ``lang`` is known, ``rows`` at most.

    Ties of the id hash are broken by id; of the rows of a repeated id the least by language and text is
    used. A table without labelled rows gives a model without languages.
    """
    known = docs.select("doc_id", F.col("lang").cast("string").alias("lang")).filter(usable & F.col("lang").isNotNull())
    chosen = F.broadcast(known.withColumn("rank", F.xxhash64("doc_id")).orderBy("rank", "doc_id", "lang").limit(rows).select("doc_id").distinct())
    pairs = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).filter("lang IS NOT NULL")
    least = pairs.join(chosen, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("row"))
    mine = stored(least.select("row.lang", "row.text"), "language-rows")
    parts = mine.repartition(8).mapInArrow(_count_task, "lang string, grams binary, scripts array<double>").collect()  # 8 rows per language
    grams: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for lang, data, letters in parts:
        grams[lang] = grams.get(lang, 0) + np.frombuffer(bytes(data), "<f8")
        scripts[lang] = scripts.get(lang, 0) + np.array(letters)
    languages = sorted(grams)
    if not languages:
        return LanguageModel([], np.zeros((BINS, 0), np.float32), np.zeros((len(SCRIPTS), 0), np.bool_))
    counts = np.stack([grams[x] for x in languages], axis=1) + 0.1
    letters = np.stack([scripts[x] for x in languages], axis=1)
    allowed = letters >= SCRIPT_SHARE * np.maximum(letters.sum(0), 1)
    return LanguageModel(languages, np.log(counts / counts.sum(0)).astype(np.float32), allowed)


def identified(docs: DataFrame, model: LanguageModel, penalty: float = SWITCH) -> DataFrame:
    """Every row with a column ``q``: ``lang_pred``, the language of most letters, and its share ``score``.

    Null texts and texts without a letter, and all texts of a model without languages, are ``und`` with score 0.
    A repeated row is judged twice with one result; a column of ``docs`` named ``q`` is replaced.
    """
    docs = docs.drop("q")

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _Scorer(model, penalty)
        for part in parts:
            texts = part.cast(pa.large_binary()).to_pylist()
            names, shares = [], []
            first = size = 0
            for at, text in enumerate([*texts, None]):
                if at == len(texts) or size >= 2 << 20:
                    mine = texts[first:at]
                    if model.languages:
                        found = scorer.judge(mine)
                        names += found[0]
                        shares += found[1].tolist()
                    else:
                        names += [UNKNOWN] * len(mine)
                        shares += [0.0] * len(mine)
                    first, size = at, 0
                size += len(text) if text else 0
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(shares, pa.float64())], ["lang_pred", "score"])

    run.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    judge = F.arrow_udf(run, "lang_pred string, score double")
    rows = docs.select(F.struct("*").alias("doc"), judge(F.col("text").cast("string")).alias("q"))
    return rows.select("doc.*", "q")


def spans(text: str | None, model: LanguageModel, penalty: float = SWITCH) -> list[tuple[int, int, str]]:
    """(first word, word after the last, language) of every run of equally labelled words of one text."""
    if not text or not model.languages:
        return []
    _, _, labels, _ = _Scorer(model, penalty).label([text.encode()])
    edges = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
    return [(a, b, model.languages[labels[a]]) for a, b in zip(edges[:-1], edges[1:]) if b > a]
