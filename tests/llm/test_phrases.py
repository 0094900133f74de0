"""Phrases against a brute-force version."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from motorledger.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_phrases(rows, least, longest=4, percent=80, top=2000):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(w)
            counts.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    known = {key: a for key, a in counts.items() if a >= least}
    out = {}
    for (lang, p), a in known.items():
        inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        longer = [b for (other, q), b in known.items() if other == lang and len(q) > len(p) and inside(q)]
        if len(p) < 2 or any(100 * b >= percent * a for b in longer):
            continue
        cuts = [(2_000_000 * a // (known[lang, p[:k]] + known[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), known[lang, p[:k]], known[lang, p[k:]]))
    for lang, found in out.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            yield lang, rank, p.decode(), -a, left, right, sizes[lang], -score


def texts(seed, n=60):
    turn = np.random.default_rng(seed)
    words = ["a", "b", "É", "d\x00", "New", "York", "\x1f", "z"]
    glue = [" ", "\t ", ". ", "  ", ", ", "\r\n"]
    rows = [(None, None), ("en", None), ("en", ""), (None, " ?! "), ("und", "a b " * 9)]
    for i in range(n):
        line = "".join(turn.choice(words) + turn.choice(glue, p=[0.6, 0.1, 0.1, 0.1, 0.05, 0.05]) for _ in range(turn.integers(0, 40)))
        rows.append((["en", "de", None][i % 3], line + " new york city hall" * int(turn.integers(0, 3))))
    return rows + rows[-4:]


@pytest.mark.parametrize("seed, least, shards, slots", [(1, 5, 4, 1 << 16), (2, 12, 3, 1 << 16), (3, 9, 4, 4), (4, 6, 1, 1)])
def test_phrases_by_brute_force(spark, seed, least, shards, slots):
    """Also with so few slots that nearly all phrases share one: counts stay exact."""
    rows = texts(seed)
    docs = spark.createDataFrame([(t, 1, lang) for lang, t in rows], "text string, phrase int, lang string").repartition(3)
    got = phrases.collocations(docs, top=7, least=least, shards=shards, slots=slots)
    got = [tuple(r) for r in got.drop("words").collect()]
    assert sorted(got) == sorted(plain_phrases(rows, least, top=7))
    assert len(got) > 7


def test_a_rare_late_phrase_has_its_full_cycle(spark):
    """The words reach the threshold in the last shard only; earlier shards are scanned again for the pair."""
    rows = [("en", "p q r s")] * 4 + [("en", "x")] * 3
    docs = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string").coalesce(1)
    got = {(r["phrase"], r["n"]) for r in phrases.counted(docs, least=4, shards=7, slots=1 << 10).collect()}
    assert {("p", 4), ("p q", 4), ("p q r", 4), ("q r s", 4), ("p q r s", 4), ("", 19)} <= got


def test_exact_scores_beyond_64_bits(spark):
    big = 7 * 10**17 + 1
    counts = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 4)], "lang string, phrase string, words int, n long")
    pair = spark.createDataFrame([("en", "a b", 2, big)], "lang string, phrase string, words int, a long")
    assert phrases._cuts(pair, counts).first()["score"] == 2_000_000 * big // (2 * big + 4) == 999_999


def test_no_texts(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_a_scan_holds_few_texts_at_a_time(monkeypatch):
    held = []
    monkeypatch.setattr(phrases._Scan, "count", lambda self, lang, texts: held.append(sum(map(len, texts))) or iter(()))
    text = pa.array(["word " * 20_000] * 100)
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 100), text], ["lang", "text"])
    reached = type("Sent", (), {"value": b"\xff" * 16})
    assert list(phrases._scan_task(reached, 0, 4, 4)([batch])) == []
    assert sum(held) == 10_000_000 and max(held) <= (4 << 20) + 100_000


def test_a_step_runs_no_job_for_each_partition(spark, rows):
    docs = spark.createDataFrame([(lang, f"a b c d {lang}{i}") for lang in ("en", "de") for i in range(4)], "lang string, text string")
    changed = {"spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        tracker = spark.sparkContext.statusTracker()
        latest = lambda: max(tracker.getJobIdsForGroup(None), default=0)  # noqa: E731  ids are given in a row
        first = latest()
        found = phrases.counted(docs, least=3, shards=2, slots=1 << 10)
        jobs = latest() - first
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sorted({r[1] for r in rows(found) if r[2] == 4}) == ["a b c d"]
    assert jobs < 50
