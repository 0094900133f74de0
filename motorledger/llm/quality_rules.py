"""Quality rules by distribution divergence, in DataFrame expressions only.

A document's histogram over character classes and its histogram over the commonest words of
its language are compared with the language's own histograms, which are counted over the whole
table. The measure is the Jensen-Shannon distance (base 2, from 0 to 1).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorledger.llm.common import stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Largest distance from the language's character classes, and from its common words.
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.42
#: A text may differ from its language's common words by this, and by so many times what chance
#: alone makes of a text of its length.
WORD_DRIFT = 0.12
CHANCE_FACTOR = 1.2
#: It is not compared by words unless chance would leave it without any common word less often than this.
SILENT_CHANCE = 1e-4
#: And it is rejected if it comes so near to the distance of a text without any common word.
SILENT_SHARE = 0.98
COMMON_WORDS = 12
#: A language with a smaller share of all words has no reference of its own, which bounds their number.
REFERENCE_SHARE = 0.001
_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"  # the order has no meaning inside a character class
_CLASSES = ["lower", "upper", "digit", "blank", "mark", "symbol"]
_POOL = "\0all"


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _next(values: str) -> Column:
    return F.expr(f"slice({values}, 2, greatest(size({values}) - 1, 0))")


def _kept_only(text: Column, kept: str) -> Column:
    """The number of characters of ``text`` in the class ``kept``."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", ""))


def _class_counts(text: Column) -> list[Column]:
    """Characters by class but for the first, ``lower``, which is what remains."""
    found = {
        "upper": _kept_only(text, r"\p{Lu}"), "digit": _kept_only(text, "0-9"), "blank": _kept_only(text, _BLANKS),
        "mark": _kept_only(text, r".,;:!?'\"()\-"), "symbol": _kept_only(text, _SYMBOLS),
    }
    return [found[c].cast("long").alias(c) for c in _CLASSES[1:]]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(text, "[\t-\r]", " "), " "), "")


def measured(docs: DataFrame, common: list[str] | None = None) -> DataFrame:
    """``docs`` with a column ``q`` of the counts the rules use, all from whole texts; null counts as empty.

    Holds word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words, the character classes and
    ``words``, the lower-cased words that are in ``common``. Windows of three words are compared by
    64-bit hashes within their text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t\x0B\f\r]"))
    listed = F.filter(_words(F.lower(text)), lambda word: word.isin(common)) if common else F.array().cast("array<string>")
    rows = docs.select(
        F.struct("*").alias("doc"), _words(text).alias("w"), lines.alias("lines"), F.length(text).cast("long").alias("chars"),
        listed.alias("words"), *_class_counts(text),
    )
    others = ["doc", "lines", "chars", "words", *_CLASSES[1:]]
    part = lambda first: F.expr(f"slice(w, {first}, greatest(size(w) - 2, 0))")
    two = F.zip_with(part(1), part(2), lambda a, b: F.xxhash64(a, b))
    rows = rows.select(*others, F.size("w").cast("long").alias("n_words"), F.zip_with(two, part(3), lambda a, b: F.xxhash64(a, b)).alias("three"))
    others.append("n_words")
    # only texts in which some window comes twice need the positions
    again = F.size(F.array_distinct("three")) < F.size("three")
    rows = rows.select(*others, F.when(again, F.sort_array(F.transform("three", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).alias("s"))
    same = F.zip_with("s", _next("s"), lambda a, b: F.coalesce(a["x"] == b["x"], F.lit(False)))
    rows = rows.select(*others, "s", same.alias("same"))
    before = F.expr("concat(array(false), slice(same, 1, size(same) - 1))")
    either = F.zip_with("same", before, lambda a, b: a | b)
    spots = F.sort_array(F.array_compact(F.zip_with("s", either, lambda a, b: F.when(b, a["i"]))))
    rows = rows.select(*others, spots.alias("spots"))
    covered = F.zip_with("spots", _next("spots"), lambda a, b: F.when(b.isNull(), 3).otherwise(F.least(F.lit(3), b - a)))
    repeats = F.coalesce(F.aggregate(covered, F.lit(0), lambda x, y: x + y), F.lit(0)).cast("long")
    lower = F.col("chars") - _sum([F.col(c) for c in _CLASSES[1:]])
    return rows.select(
        "doc.*",
        F.struct(
            "n_words", (F.col("chars") - F.col("blank")).alias("word_chars"), F.col("symbol").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), repeats.alias("n_repeat_words"),
            "words", lower.cast("double").alias("lower"), *[F.col(c).cast("double").alias(c) for c in _CLASSES[1:]],
        ).alias("q"),
    )


def references(docs: DataFrame, words: int = COMMON_WORDS, share: float = REFERENCE_SHARE) -> DataFrame:
    """One row per language, and one for all documents: class shares and the commonest words.

    Counted over all of ``docs``. Languages with less than ``share`` of all words get no row, so
    there are at most ``1 / share + 1`` rows.
    """
    base = docs.select(F.col("lang").cast("string").alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    counted = base.select("lang", F.length("t").cast("long").alias("chars"), *_class_counts(F.col("t")))
    sums = [F.sum(c).alias(c) for c in ["chars", *_CLASSES[1:]]]
    by_lang = stored(counted.groupBy("lang").agg(*sums), "class-counts")
    classes = by_lang.filter("lang IS NOT NULL").unionByName(by_lang.agg(*sums).withColumn("lang", F.lit(_POOL)))
    classes = classes.withColumn("lower", F.col("chars") - _sum([F.col(c) for c in _CLASSES[1:]]))
    classes = classes.select("lang", *[(F.col(c) / F.greatest(F.col("chars"), F.lit(1))).alias(f"ref_{c}") for c in _CLASSES])

    tokens = base.select("lang", F.explode(_words(F.lower("t"))).alias("word"))
    counts = stored(tokens.groupBy("lang", "word").agg(F.count("*").alias("n")), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    everything = counts.agg(F.sum("n")).first()[0] or 0
    pooled = counts.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit(_POOL).alias("lang"), "word", "n")
    best = pooled.orderBy(F.desc("n"), "word").limit(words).unionByName(
        counts.filter("lang IS NOT NULL").withColumn(
            "at", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
        ).filter(F.col("at") <= words).drop("at")
    )
    listed = best.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("n", "word")), asc=False).alias("common"))
    kept = totals.filter("lang IS NOT NULL").unionByName(totals.agg(F.lit(_POOL).alias("lang"), F.sum("total").alias("total")))
    return stored(classes.join(kept.filter(F.col("total") >= share * everything), "lang").join(listed, "lang"), "references")


def _distance(own: Column, ref: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares, 0 to 1."""

    def part(p: Column, q: Column) -> Column:
        half = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)
        return (half(p, q) + half(q, p)) / 2

    total = F.aggregate(F.zip_with(own, ref, part), F.lit(0.0), lambda x, y: x + y)
    return F.sqrt(F.greatest(F.lit(0.0), total))


def _whole(values: Column | str) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda x, y: x + y)


def _rest(values: Column) -> Column:
    """Shares with the share of everything else behind them."""
    return F.concat(values, F.array(1 - _whole(values)))


def _with_silence(reference: DataFrame) -> DataFrame:
    """References with the distance of a text without common words, ``silent``, and the least length to tell."""
    known = F.transform("common", lambda x: x["n"] / F.col("total"))
    none = F.concat(F.transform("common", lambda x: F.lit(0.0)), F.array(F.lit(1.0)))
    missed = F.lit(math.log(SILENT_CHANCE)) / F.nullif(F.log(F.greatest(F.lit(1e-300), 1 - _whole(known))), F.lit(0.0))
    return reference.withColumn("silent", _distance(none, _rest(known))).withColumn("least_words", F.greatest(F.lit(float(MIN_WORDS)), missed))


def judged(
    docs: DataFrame, reference: DataFrame | None = None, words: int = COMMON_WORDS,
    class_limit: float = MAX_CLASS_DISTANCE, word_limit: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """Every row of ``docs`` with a column ``q`` of counts, distances, ``base_failed`` and ``kept``.

    A text is rejected by the base rules if it has fewer than ``MIN_WORDS`` words or more than half
    of its words lie in repeated 3-word windows; by the method if a distance is above its limit.
    Documents whose language is null or has no reference are compared with the pooled one. A
    repeated row is judged twice with one result; a column of ``docs`` named ``q`` is replaced.

    The word limit of a text is the least of ``word_limit``, of what drift and chance explain at its
    length, and of almost the distance that no common word at all makes in its language. A text
    too short for its language's common words to be missed is not compared by words.
    """
    docs = docs.drop("q")
    reference = reference if reference is not None else references(docs, words)
    few = _with_silence(reference.withColumnRenamed("lang", "ref_lang"))
    known_rows = few.select("ref_lang", "common.word").collect()  # at most 1 / REFERENCE_SHARE + 1 rows
    listed = [r["ref_lang"] for r in known_rows]
    rows = measured(docs, sorted({w for r in known_rows for w in r["word"]}))
    known = F.coalesce(F.col("lang").cast("string"), F.lit(_POOL))
    wanted = F.when(known.isin(listed), known).otherwise(F.lit(_POOL)) if listed else F.lit(_POOL)
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "q", wanted.alias("wanted"), F.col("q.words").alias("words"), F.col("q.n_words").alias("n"))
    rows = rows.join(F.broadcast(few), F.col("wanted") == F.col("ref_lang"), "left")  # bounded, see references()
    classes = F.array(*[F.col(f"q.{c}") for c in _CLASSES])
    expected = F.array(*[F.col(f"ref_{c}") for c in _CLASSES])
    hits = [F.coalesce(F.size("words") - F.size(F.array_remove("words", F.get("common", F.lit(i))["word"])), F.lit(0)) for i in range(words)]
    known_words = F.transform("common", lambda x: x["n"] / F.col("total"))
    bounds = ["silent", "least_words"]
    rows = rows.select("doc", "q", "n", *bounds, classes.alias("classes"), expected.alias("expected"), F.array(*hits).alias("hits"), known_words.alias("known"))
    shares = lambda values, total: F.transform(values, lambda x: x / F.greatest(total, F.lit(1.0)))
    rows = rows.select(
        "doc", "q", "n", *bounds, "expected", "known", shares(F.col("classes"), _whole("classes")).alias("classes"),
        shares(F.slice("hits", F.lit(1), F.size("known")), F.col("n").cast("double")).alias("hits"),
    )
    class_distance = _distance(F.col("classes"), F.col("expected"))
    word_distance = F.when(F.col("n") >= F.col("least_words"), _distance(_rest(F.col("hits")), _rest(F.col("known"))))
    chance = F.sqrt((F.size("known") + 1) / (8 * math.log(2) * F.col("n")))
    limit = F.least(F.lit(word_limit), WORD_DRIFT + CHANCE_FACTOR * chance, SILENT_SHARE * F.col("silent"))
    rows = rows.select(
        "doc", "q", "n", class_distance.alias("class_distance"), word_distance.alias("word_distance"),
        F.when(F.col("n") >= F.col("least_words"), limit).alias("word_limit"),
    )
    failed = (F.col("n") < MIN_WORDS) | (100 * F.col("q.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n"))
    passed = (F.coalesce(F.col("class_distance"), F.lit(0.0)) <= class_limit) & F.coalesce(F.col("word_distance") <= F.col("word_limit"), F.lit(True))
    counts = [F.col(f"q.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return rows.select(
        "doc.*",
        F.struct(
            *counts, "class_distance", "word_distance", "word_limit", failed.alias("base_failed"), (~failed & passed).alias("kept")
        ).alias("q"),
    )


def accepted(docs: DataFrame, reference: DataFrame | None = None, **limits) -> DataFrame:
    """The rows of ``docs`` that are kept. The judgement is written first: a filter on it would
    otherwise be pushed into the expressions and evaluate them anew for every use."""
    return stored(judged(docs, reference, **limits), "judged").filter("q.kept").drop("q")
