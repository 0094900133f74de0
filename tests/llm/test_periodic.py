"""Periodic runs against a brute-force version."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from motorledger.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """(start, length, period) of all runs, by trying every period and dropping multiples of smaller ones."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end - at + q >= max(6, 4 * q):
                found.setdefault((at, end + q - at), q)
            at = end + 1
    return sorted((s, size, q) for (s, size), q in found.items())


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_planted(key, words):
    h, n = zlib.crc32(("" if key is None else str(key)).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def plain_collapsed(words, runs):
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


_PIECES = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(1, 9), st.integers(0, 20)), max_size=6)


@settings(max_examples=300, deadline=None)
@given(_PIECES, st.sampled_from([1, 2, 8]))
def test_runs_by_brute_force(pieces, short):
    words = [x for block, times, more in pieces for x in (block * (times + 1))[: len(block) * times + more]]
    got = periodic.find_runs(np.array(words, np.int64), short=short)
    assert [(s, e - s, q) for s, e, q in got.tolist()] == plain_runs(words)


@pytest.mark.parametrize("period", [9, 16, 17, 33, 100, 257, 640])
def test_runs_of_every_scale(period):
    turn = np.random.default_rng(period)
    for length in (4 * period - 1, 4 * period, 4 * period + 3, 9 * period + 1):
        block = turn.integers(0, 1 << 40, period)
        words = np.concatenate([turn.integers(0, 1 << 40, 50), np.resize(block, length), turn.integers(0, 1 << 40, 70)])
        want = [[50, 50 + length, period]] if length >= 4 * period else []
        assert periodic.find_runs(words).tolist() == want


def test_texts_do_not_run_into_each_other(spark):
    texts = [None, "", " \n\t", "a b " * 3, "a b " * 4, "a b " * 4, "a " * 5, "a " * 6, "x " + "a b c " * 2000 + "y", "c " * 9 + "d " * 9]
    docs = spark.createDataFrame([(i // 2, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, Q int")
    found = periodic.with_runs(docs.coalesce(1))
    assert found.columns == ["doc_id", "text", "q"]
    for r in found.collect():
        words = plain_words(r["text"])
        runs = [tuple(x) for x in r["q"]["runs"]]
        assert runs == plain_runs(words)
        assert (r["q"]["n_words"], r["q"]["collapsed"]) == (len(words), plain_collapsed(words, runs))
    assert periodic.with_runs(docs.limit(0)).count() == 0


def test_query_by_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(80).collect()
    odd = [(None, None), (None, "p q r s " * 9), (10_001, "w"), (10_001, "w"), (10_002, " a\x0bb\x1cc é " * 300), (10_003, None)]
    odd += [(k, f"n{k % 7} m o " * (k % 50)) for k in range(20_000, 20_060)]
    rows = [tuple(r) for r in docs] + odd
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for key, text in rows:
        words = plain_planted(key, plain_words(text))
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((key, len(runs), *tail, sha(lines), sha(plain_collapsed(words, runs))))
    got = queries.op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    text = lambda rows: sorted(map(str, map(tuple, rows)))
    assert text(got.collect()) == text(want)
    assert sum(r[1] > 0 for r in want) > 10
