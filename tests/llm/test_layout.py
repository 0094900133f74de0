"""Results that do not depend on layout, other runs, column names or odd rows."""

import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from motorledger.llm import (
    decontaminate, language, phrases, quality_model, quality_rules, queries, simhash, token_trees, tokenfiles, url_filter,
)
from motorledger.llm.common import give_back, prepared

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    prepared(spark)
    good, bad = "plain words in a row number ", "%%% $$$ ### !!! "
    rows = [(i % 70, (good if i % 3 else bad) * (1 + i % 5) + str(i), "en", 7, "x") for i in range(120)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, q int, tree string")


def test_the_classifier_does_not_depend_on_partitions(spark, texts):
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(70)] + [(5, 0)], "doc_id long, quality int")
    found = []
    for shape in (texts.repartition(1), texts.repartition(7, "text"), texts.orderBy(F.desc("text")), texts.union(texts)):
        model = quality_model.train(shape, labels)
        found.append((model.bias, model.slope, model.offset, model.weight.tobytes(), model.ratio.tobytes()))
    assert len(set(found)) == 1


def test_a_training_bound_on_features(spark, texts, monkeypatch):
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(70)], "doc_id long, quality int")
    monkeypatch.setattr(quality_model, "TRAINING_FEATURES", 400)
    model = quality_model.train(texts, labels)
    assert quality_model.classified(texts, model).count() == 120
    monkeypatch.setattr(quality_model, "TRAINING_FEATURES", 0)
    assert quality_model.classified(texts, quality_model.train(texts, labels)).count() == 120


def plain_features(text):
    """Distinct hashed byte n-grams and repetition marks, one gram at a time."""
    seen = set()
    for size in range(1, 5):
        for at in range(len(text) - size + 1):
            h = 0
            for k, b in enumerate(text[at : at + size]):
                h = (h * 0x01000193 + b + k + 1) % 2**32
            h = h * 0x9E3779B1 % 2**32
            seen.add(32 + (h >> 15) % (quality_model.BINS - 32))
    words = text.split()
    same = [int(a == b) for a, b in zip(words, words[1:])]
    for size in range(1, 5):
        for at in range(len(same) - size + 1):
            seen.add(int("".join(map(str, same[at : at + size])), 2) + (1 << size) - 2)
    return sorted(seen)


def test_classifier_features_and_ratios_by_brute_force():
    texts = [b"", b"a", b"a a b  b b b a", "é\n\t% %".encode(), b"the cat the cat the"]
    rows = [quality_model.features(t) for t in texts]
    assert [r.tolist() for r in rows] == [plain_features(t) for t in texts]
    label = np.array([1.0, -1.0, 1.0, -1.0, 1.0])
    ratio, weights, bias = quality_model._fit(rows, label)
    up, down = (np.array([1.0 + sum(f in set(r) for r, y in zip(map(np.ndarray.tolist, rows), label) if y == side) for f in range(2000)]) for side in (1, -1))
    total = [quality_model.BINS + sum(len(r) for r, y in zip(rows, label) if y == side) for side in (1, -1)]
    assert np.allclose(ratio[:2000], np.log(up / total[0]) - np.log(down / total[1]))
    # the descent ends near the least of the loss: no small change of one weight helps much
    scaled = [ratio[r] / max(np.sqrt(ratio[r] @ ratio[r]), 1e-9) for r in rows]
    cost = quality_model.COST * 5 / (2 * np.where(label > 0, 3, 2))

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + sum(c * max(0, 1 - y * (w[r] @ s + b)) for c, y, r, s in zip(cost, label, rows, scaled))

    least = loss(weights, bias)
    turn = np.random.default_rng(1)
    for _ in range(50):
        step = np.zeros_like(weights)
        step[turn.choice(np.concatenate(rows), 8)] = turn.normal(0, 0.05, 8)
        assert loss(weights + step, bias + turn.normal(0, 0.05)) > least - 0.02


def test_a_column_named_like_the_result_is_replaced(spark, texts):
    model = quality_model.train(texts, spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int"))
    lang = language.train(texts, F.lit(True))
    trees = token_trees.with_trees(texts)
    urls = texts.withColumnRenamed("text", "url")
    for found in (
        quality_model.classified(texts, model), language.identified(texts, lang), quality_rules.judged(texts), url_filter.judged(urls),
        token_trees.edited_counts(trees, F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("stop"), F.lit("x").alias("new")))),
    ):
        assert [c.lower() for c in found.columns].count("q") == 1
        assert found.select("q.*").count() == 120
    assert trees.columns.count("tree") == 1 and trees.schema["tree"].dataType.simpleString() == "binary"


@pytest.mark.parametrize("cut", [(3, 1), (5, 2), (6, 3), (4, 1)])
def test_every_cut_finds_the_same_pairs(spark, cut):
    turn = np.random.default_rng(5)
    values = [0, *turn.integers(0, 1 << 62, 25).tolist()]
    for v in list(values):
        for flips in (1, 2, 3, 4, 5):
            values.append(v ^ sum(1 << int(b) for b in turn.choice(64, flips, replace=False)))
    signed = sorted({v - (1 << 64) if v >= 1 << 63 else v for v in values})
    pairs = simhash.near_pairs(spark.createDataFrame([(v,) for v in signed], "bits long"), cut=cut).collect()
    want = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    assert sorted(map(tuple, pairs)) == sorted(want)


def test_cuts_that_could_miss_pairs_are_refused():
    with pytest.raises(ValueError):
        simhash.keys_of(4, (4, 2))
    for distance in range(8):
        for count in (10, 1 << 24, 1 << 30):
            assert simhash.keys_of(distance, simhash.cut_for(count, distance))


def english(n, seed, common=0.2):
    turn = np.random.default_rng(seed)
    return " ".join(turn.choice(["the", "of", "and", "to", "in"]) if turn.random() < common else "".join(turn.choice(list("abcdefgh"), 6)) for _ in range(n))


def test_gibberish_is_rejected_and_clean_short_texts_stay(spark):
    clean = [(i, "en", english(60 + 40 * (i % 9), i)) for i in range(60)]
    empty_words = [(1000 + i, "en", english(n, 90 + i, common=0)) for i, n in enumerate((50, 60, 200, 2000))]
    short = [(2000 + i, "en", english(52, 500 + i)) for i in range(40)]
    docs = spark.createDataFrame(clean + empty_words + short, "doc_id long, lang string, text string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judged(docs).select("doc_id", "q.kept").collect()}
    assert not any(kept[1000 + i] for i in range(4))
    assert all(kept[i] for i in range(60)) and sum(kept[2000 + i] for i in range(40)) == 40


def plain_distance(p, q):
    half = lambda a, b: sum(x * np.log2(2 * x / (x + y)) for x, y in zip(a, b) if x > 0)
    return np.sqrt(max(0.0, (half(p, q) + half(q, p)) / 2))


def test_distances_by_brute_force(spark):
    rows = [(i, "en" if i % 2 else "de", english(40 + 30 * i, i, 0.1 + 0.05 * (i % 4)) + (" A1, %" * i)) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = {r["doc_id"]: r for r in quality_rules.judged(docs).select("doc_id", "q.*").collect()}
    kinds = ["\\p{Lu}".replace("\\p{Lu}", "A-Z"), "0-9", " \t\n\x0b\x0c\r", ".,;:!?'\"()\\-", "#*$%&|<>"]

    def classes(text):
        counts = [len(re.findall(f"[{k}]", text)) for k in kinds]
        return [len(text) - sum(counts), *counts]

    for lang in ("en", "de"):
        mine = [t for _, x, t in rows if x == lang]
        total = np.sum([classes(t) for t in mine], axis=0)
        words = [w for t in mine for w in t.lower().split()]
        top = sorted(set(words), key=lambda w: (-words.count(w), w))[: quality_rules.COMMON_WORDS]
        known = [words.count(w) / len(words) for w in top]
        known.append(1 - sum(known))
        for key, x, text in rows:
            if x != lang:
                continue
            own = text.lower().split()
            hits = [own.count(w) / len(own) for w in top]
            assert got[key]["class_distance"] == pytest.approx(plain_distance(np.array(classes(text)) / len(text), total / total.sum()))
            silent = plain_distance([0.0] * len(top) + [1.0], known)
            least = max(quality_rules.MIN_WORDS, np.log(quality_rules.SILENT_CHANCE) / np.log(known[-1]))
            if len(own) >= least:
                distance = plain_distance([*hits, 1 - sum(hits)], known)
                assert got[key]["word_distance"] == pytest.approx(distance, abs=1e-6)
                chance = np.sqrt(len(known) / (8 * np.log(2) * len(own)))
                limit = min(quality_rules.MAX_WORD_DISTANCE, quality_rules.WORD_DRIFT + quality_rules.CHANCE_FACTOR * chance, quality_rules.SILENT_SHARE * silent)
                assert got[key]["word_limit"] == pytest.approx(limit)
                fine = got[key]["class_distance"] <= quality_rules.MAX_CLASS_DISTANCE and distance <= limit
                assert got[key]["kept"] == (fine and not got[key]["base_failed"])
            else:
                assert got[key]["word_distance"] is None and got[key]["word_limit"] is None


def test_proximity_by_brute_force(spark):
    turn = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(12)] + ["longest", "longish"]
    texts = [" ".join(turn.choice(vocabulary, int(turn.integers(0, 60)))) for _ in range(60)] + [None, ""]
    items = [(i, " ".join(turn.choice(vocabulary, int(turn.integers(0, 9))))) for i in range(25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string"), width=4, proximity=5).collect()
    for r in got:
        words, near = (texts[r["doc_id"]] or "").split(), set()
        for item, passage in items:
            p = passage.split()
            for window in {tuple(p[i : i + 4]) for i in range(max(1, len(p) - 3))} if p else ():
                middle = max(set(window), key=lambda w: (len(w), w))
                spots = [i for i, w in enumerate(words) if w == middle]
                if any(all(x in words[max(0, i - 5) : i + 6] for x in window) for i in spots):
                    near.add(str(item))
        assert set(r["near"]) == near


def test_proximity_query_holds_every_exact_match(spark):
    got = queries.decontamination_proximity(spark, SF).collect()
    exact = {r["doc_id"]: r["n_items"] for r in queries.op1_decontamination(spark, SF).collect()}
    assert len(got) == len(exact) and all(r["n_near"] >= exact[r["doc_id"]] for r in got)
    assert sum(r["n_near"] for r in got) >= sum(exact.values()) > 0


def test_two_runs_of_the_pipeline_in_one_process(spark):
    import corpus_pipeline as cp

    a, b = cp.run(spark, SF), cp.run(spark, SF)
    assert b.count() == a.count() > 0


def test_stages_with_odd_rows(spark, tmp_path):
    import corpus_pipeline as cp

    long = english(120, 1)
    rows = [(None, long, "en", "s", 1, "a"), (None, None, None, None, None, None), (1, "", "en", "s", 1, "a"), (2, long, None, "s", 1, "a"), (3, english(90, 2), "en", "s", 1, "a"),
            (3, english(90, 2), "en", "s", 1, "a"), (4, english(30_000, 3), "en", "s", 1, "a"), (5, english(80, 5), "xx", None, 2, "b")]
    schema = "doc_id long, text string, lang string, source string, q int, row_id string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 1), (1, 0), (None, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, english(40, 5))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    nothing = docs.limit(0)
    for name, stage in cp.STAGES:
        out = stage(spark, docs, str(tmp_path))
        empty = stage(spark, nothing, str(tmp_path))
        assert empty.count() == 0
        if name != "packing":
            assert out.columns == docs.columns == empty.columns and out.schema == docs.schema
        if name == "simhash_near_duplicates":
            # copies, and the texts without words, are one document each
            assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect()) == [(False, 1), (False, 2), (False, 3), (False, 4), (False, 5)]
        if name == "benchmark_decontamination":
            assert out.count() == 7 and out.filter("doc_id = 5").count() == 0
        if name == "quality_rules":
            assert {(r["doc_id"], r["q"], r["row_id"]) for r in out.collect()} <= {(r[0], r[4], r[5]) for r in rows} and out.filter("text IS NULL OR text = ''").count() == 0
    assert cp.run(spark, str(tmp_path)).count() >= 0


def plain_evidence(counts, url):
    """Log likelihood per character, one character and order at a time; ``counts`` are by order and hash."""
    total, data = 0.0, [*url, 10]
    for at, byte in enumerate(data):
        context, p = 0, 1 / 256
        for order in range(url_filter.ORDERS):
            if order:
                context = (context * 0x01000193 + (data[at - order] if at >= order else 1) + 7) % 2**32
            mixed = (context * 0x85EBCA6B + order) % 2**32
            cell = (((mixed ^ (byte * 0xC2B2AE35 % 2**32)) * 0x9E3779B1) % 2**32) >> 16
            if isinstance(counts, list):  # counting
                counts[order][0][mixed >> 16] = counts[order][0].get(mixed >> 16, 0) + 1
                counts[order][1][cell] = counts[order][1].get(cell, 0) + 1
                continue
            seen = counts[order][0].get(mixed >> 16, 0)
            p = (min(counts[order][1].get(cell, 0), seen) + 2.0 * p) / (seen + 2.0)
        total += np.log(p)
    return total / len(data)


def test_url_evidence_and_limit_by_brute_force(spark):
    turn = np.random.default_rng(8)
    word = lambda letters: "".join(turn.choice(list(letters), int(turn.integers(1, 9))))
    rows = [(f"http://{word('abcde')}.x/{word('abc')}", "allow") for _ in range(150)] + [(f"http://{word('defgh')}.y/{word('gh9')}", "block") for _ in range(150)]
    rows += rows[:20] + [("", "allow"), (None, "block"), ("é/ü", "block"), ("http://q", None)]
    decided = spark.createDataFrame(rows, "url string, verdict string")
    model = url_filter.train(decided.repartition(4))
    apart = {r[0] for r in decided.filter("pmod(xxhash64(url), 5) = 0").select("url").collect()}
    tables = {}
    for verdict in ("allow", "block"):
        tables[verdict] = [({}, {}) for _ in range(url_filter.ORDERS)]
        for url, says in rows:
            if says == verdict and url is not None and url not in apart:
                plain_evidence(tables[verdict], url.encode())
    counted = {v: tuple(t) for v, t in tables.items()}
    urls = [u for u, _ in rows if u is not None]
    want = [plain_evidence(counted["allow"], u.encode()) - plain_evidence(counted["block"], u.encode()) for u in urls]
    assert np.allclose(model.evidence([u.encode() for u in urls]), want, atol=1e-5)
    known = [(e, v) for e, u in zip(want, urls) for x, v in rows if x == u and u in apart and v][: 10**6]
    errors = lambda limit: sum(e < limit for e, v in known if v == "allow") / sum(v == "allow" for _, v in known) + sum(
        e >= limit for e, v in known if v == "block"
    ) / sum(v == "block" for _, v in known)
    assert errors(model.limit) <= min(errors(x) for x in np.linspace(-4, 4, 161)) + 0.1


def test_language_scores_by_brute_force(spark):
    rows = [(i, ("the house " if i % 2 else "дом и сад ") * 3, "en" if i % 2 else "ru") for i in range(20)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    words = [b"the", b"house", "дом".encode(), b"12", "—".encode()]
    bins, owner = language._grams(words)
    scores = np.zeros((len(words), 2))
    for b, w in zip(bins, owner):
        scores[w] += model.logs[b] / language.GRAMS
    scores -= scores.max(1, keepdims=True)
    got = model.word_scores(words)
    assert model.languages == ["en", "ru"]
    # Latin words are English, Cyrillic ones Russian, by script alone; a sign says nothing
    assert got[0, 1] == got[1, 1] == language._FAR and got[2, 0] == language._FAR and (got[4] == 0).all()
    assert np.allclose([got[0, 0], got[1, 0], got[2, 1]], [scores[0, 0], scores[1, 0], scores[2, 1]], atol=1e-5)


def test_workers_give_back_the_memory_of_a_task():
    def held():
        return int(re.search(r"Pss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) >> 10

    blocks = [np.ones(100_000, np.uint8) for _ in range(2000)]  # on the heap, where only its end shrinks by itself
    last, full = np.ones(100_000, np.uint8), held()
    del blocks
    give_back()
    assert held() < full - 100 and last.all()


def test_token_and_phrase_tasks_give_back_memory(monkeypatch):
    done = []
    monkeypatch.setattr(tokenfiles, "give_back", lambda: done.append("read"))
    monkeypatch.setattr(phrases, "give_back", lambda: done.append("scan"))
    assert list(tokenfiles._read_task([])) == []
    assert list(phrases._scan_task(type("Sent", (), {"value": b"\xff" * 16}), 0, 4, 4)([])) == []
    assert done == ["read", "scan"]
