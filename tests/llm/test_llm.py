"""The text operators on small tables: edge cases, brute-force versions, exact round trips."""

import hashlib
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from motorledger.llm import (  # noqa: E402
    decontaminate, language, maxent, packing, quality_model, quality_rules, queries, simhash, token_trees, tokenfiles, url_filter,
)
from motorledger.llm.common import id_remainder, prepared  # noqa: E402
from motorledger.llm.tokens import encoder, tokenizer_path  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_words int, q int, key string"
#: Nulls in every column, empty and blank texts, repeated rows, one long text, clashing names.
ROWS = [
    (None, None, None, None, None, None, None), (1, "", "en", "s", 1, 1, "k"), (2, " \n\t ", "en", None, 1, 1, "k"), (3, "the cat sat", "en", "s", 1, 1, "k"),
    (3, "the cat sat", "en", "s", 1, 1, "k"), (4, "Der Hund ist müde. " * 40, "de", "s", 1, 1, "k"), (5, "the cat of the house " * 5000, None, "s", 1, 1, "k"),
    (6, "\x01 <|endoftext|>  x\n\n\ny 12.5,", "xx", "s", 1, 1, "k"),
]


@pytest.fixture(scope="module")
def docs(spark):
    prepared(spark)
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \n\tab.,'sé1ªß_½\x01!\x1c\xa0　<|>中\0", max_size=25)), max_size=4))
def test_chunk_ids_are_those_of_the_library(texts):
    e = encoder(tokenizer_path())
    for text, ids in zip(texts, e.encode([None if t is None else t.encode() for t in texts])):
        assert e.tokenizer.encode(text or "", add_special_tokens=False).ids == ids.tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" \n\tab.,'sre1é!", max_size=300), st.lists(st.tuples(st.integers(-5, 310), st.integers(0, 40), st.text(alphabet=" \n'reab.1", max_size=12)), max_size=4))
def test_edited_counts_are_those_of_a_full_recount(text, edits):
    count = token_trees.Counter(tokenizer_path())
    tree = token_trees.build(text, count)
    for start, size, new in edits:
        text, _ = token_trees.apply_edit(text, tree, start, start + size, new, count)
        tree = token_trees.unpack(token_trees.pack(tree))
        assert tree.tokens == len(count.tokenizer.encode(text, add_special_tokens=False).ids)
        assert int(tree.sums[1, 0]) == len(text)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 299), min_size=1, max_size=700))
def test_range_coder_round_trip(ids):
    data = np.array(ids, np.uint32)
    assert (tokenfiles.decode_block(tokenfiles.encode_block(data, 300)) == data).all()


def test_damaged_block_is_refused():
    block = bytearray(tokenfiles.encode_block(np.arange(200, dtype=np.uint32), 300))
    block[-3] ^= 1
    with pytest.raises(ValueError):
        tokenfiles.decode_block(bytes(block))


def test_token_files(docs, none, rows):
    expected, at = [], 0
    e = encoder(tokenizer_path()).tokenizer
    for r in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*e.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((r[0], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = tokenfiles.read_ids(tokenfiles.write_ids(docs, block_ids=50))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected
    assert tokenfiles.read_ids(tokenfiles.write_ids(none)).count() == 0


def test_packing_places_every_id_once(docs, none):
    found = packing.packed(docs).collect()
    by = {}
    for r in found:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    e = encoder(tokenizer_path()).tokenizer
    want = Counter()
    for r in ROWS:
        ids = np.array([*e.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for length in packing.cuts(len(ids)):
            want[(r[0], at, length, zlib.crc32(ids[at : at + length].tobytes()), len(ids))] += 1
            at += length
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in found) == want
    assert packing.packed(none).count() == 0


def test_patterns_use_every_piece_once():
    turn = np.random.default_rng(1)
    lengths = np.arange(32, 2049, 32)
    demand, full = np.zeros(len(lengths), np.int64), 3000
    for _ in range(full):  # pieces that fill `full` sequences exactly
        cuts = np.unique(np.concatenate([[0, 64], turn.integers(1, 64, turn.integers(1, 6))]))
        np.add.at(demand, np.diff(cuts) - 1, 1)
    patterns = packing.solve(lengths[demand > 0], demand[demand > 0])
    assert (sum(times * column for times, column in patterns) == demand[demand > 0]).all()
    assert all(column @ lengths[demand > 0] <= 2048 for _, column in patterns)
    assert sum(times for times, _ in patterns) <= full + 3


def brute_contamination(texts, items, width=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    for text in texts:
        w, hit, found = words(text), set(), set()
        for item, passage in items:
            p = words(passage)
            for win in {tuple(p[i : i + width]) for i in range(max(1, len(p) - width + 1))} if p else ():
                for s in range(len(w) - len(win) + 1):
                    if tuple(w[s : s + len(win)]) == win:
                        hit.update(range(s, s + len(win)))
                        found.add(str(item))
        yield len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


@pytest.mark.parametrize("block_bytes", [4 << 20, 200])
def test_contamination_by_brute_force(spark, block_bytes):
    base = "one two three four five six seven eight nine ten eleven twelve"
    items = [(1, base), (2, "Cat, DOG"), (10, "cat dog"), (3, None), (4, "..."), (5, "cat cat cat")]
    texts = [None, "", base, "x " + base.upper() + " y cat dog", "cat dog cat dog", "cat cat cat cat", "dog cat", "é cat-dog é", base[:40]]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs, bench, block_bytes=block_bytes).collect()
    mine = [(r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(sorted(r["items"])).encode()).hexdigest()) for r in sorted(got, key=lambda r: r["doc_id"])]
    assert mine == list(brute_contamination(texts, items))
    near = decontaminate.contamination(docs, bench.filter("item_id = 2"), proximity=1).collect()
    assert {r["doc_id"] for r in near if r["near"]} == {3, 4, 6, 7}


def test_contamination_of_empty_tables(spark, docs, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, bench).filter("n_hit > 0").count() == 0
    assert decontaminate.contamination(docs, bench).count() == len(ROWS)
    assert decontaminate.contamination(none, bench).count() == 0


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_by_brute_force(spark, docs, none):
    texts = [r[1] for r in ROWS]
    assert [simhash.fingerprint(None if t is None else t.encode()) for t in texts[:5]] == [plain_fingerprint(t) for t in texts[:5]]
    turn = np.random.default_rng(5)
    values = [0, *turn.integers(0, 1 << 62, 30).tolist()]
    for v in list(values):
        for flips in (1, 3, 4, 5):
            values.append(v ^ sum(1 << int(b) for b in turn.choice(64, flips, replace=False)))
    signed = sorted({v - (1 << 64) if v >= 1 << 63 else v for v in values})
    pairs = simhash.near_pairs(spark.createDataFrame([(v,) for v in signed], "bits long")).collect()
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    assert sorted(map(tuple, pairs)) == sorted(want)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    assert {r["component"] for r in got if r["bits"] == 0} == {1}
    assert simhash.near_duplicates(none).count() == 0


def test_components_of_long_chains(spark):
    from motorledger.llm.links import components

    found = dict(map(tuple, components(spark.createDataFrame([(i, i + 1) for i in range(60) if i != 30], "low long, high long")).collect()))
    assert all(found[i] == (0 if i <= 30 else 31) for i in found) and len(found) == 61


def brute_rules(text):
    w = [x for x in re.split(r"[ \t\n\x0b\x0c\r]+", text or "") if x]
    wins = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if wins[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit), n < 50 or 100 * len(hit) > 50 * n


def test_rules_by_brute_force(spark, none):
    texts = [r[1] for r in ROWS] + ["a b c a b c\na b c a b c\n \n# x", "w " * 60, " ".join(f"w{i}" for i in range(80)), "x y z x y"]
    docs = spark.createDataFrame([(i, t, None if i % 3 else "en", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, n_words int")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = sorted(quality_rules.judged(docs).select("doc_id", *[f"q.{n}" for n in names], "q.kept").collect())
    assert [tuple(r)[1:7] for r in got] == [brute_rules(t) for t in texts]
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert quality_rules.judged(none.drop("q")).count() == 0


def test_rules_keep_python_out(spark, docs):
    plan = quality_rules.judged(docs.drop("q"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_classifier(spark, docs, none):
    good, bad = "plain words in a row number ", "%%% $$$ ### !!! "
    train = spark.createDataFrame([(i, (good if i % 3 else bad) * (1 + i % 5)) for i in range(90)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(90)] + [(None, 1), (5, None)], "doc_id long, quality int")
    model = quality_model.train(train, labels)
    found = quality_model.classified(train, model).select("doc_id", "q.predicted").collect()
    assert all(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in found)
    edge = quality_model.classified(docs.drop("q"), model).select("q.score").collect()
    assert len(edge) == len(ROWS) and all(0 <= r["score"] <= 1 for r in edge)
    empty = quality_model.train(none, labels)
    assert quality_model.classified(none.drop("q"), empty).count() == 0


def plain_viterbi(scores, penalty):
    best, back = scores[0].astype(float), []
    for row in scores[1:]:
        top = int(best.argmax())
        back.append([s if best[s] >= best[top] - penalty else top for s in range(len(row))])
        best = np.maximum(best, best[top] - penalty) + row
    state = int(best.argmax())
    out = [state]
    for step in reversed(back):
        state = step[state]
        out.append(state)
    return out[::-1]


def test_block_viterbi_is_the_plain_one():
    turn = np.random.default_rng(3)
    sizes = np.array([0, 1, 63, 64, 65, 300, 0, 130])
    scores = turn.normal(0, 3, (int(sizes.sum()), 4)).astype(np.float32)
    got, at = language.viterbi(scores, sizes, 8.0), 0
    for size in sizes:
        if size:
            assert got[at : at + size].tolist() == plain_viterbi(scores[at : at + size], 8.0)
        at += size


def test_languages(spark, docs, none):
    rows = [(i, ("the house of the cat and the dog " if i % 2 else "der Hund und das Haus mit dem Garten ") * 5, "en" if i % 2 else "de") for i in range(40)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    found = language.identified(docs.drop("q"), model).select("doc_id", "q.lang_pred", "q.score").collect()
    pred = {r["doc_id"]: r["lang_pred"] for r in found}
    assert pred[None] == pred[1] == pred[2] == "und" and pred[4] == "de" and pred[5] == "en"
    mixed = language.spans("the cat and the dog of the house und der Hund mit dem Garten das Haus", model)
    assert [m[2] for m in mixed] == ["en", "de"] and mixed[0][0] == 0 and mixed[-1][1] == 16
    assert language.identified(none.drop("q"), language.train(none, F.lit(True))).count() == 0


def test_scores(spark, docs, none):
    found = maxent.scored(docs, id_remainder(10) == 0).collect()
    held = lambda r: zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0
    words = lambda r: (r[1] or "").encode().lower().split() + [None]
    counts = Counter(w for r in ROWS if not held(r) for w in words(r))
    total = sum(counts.values())
    want = sorted(
        (r[0] or -1, held(r), len(words(r)), sum(counts[w] > 0 for w in words(r)), total, round(sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in words(r)), 4))
        for r in ROWS
    )
    got = sorted((r["doc_id"] or -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in found)
    assert got == want and all(r["score"] <= 0 for r in found)
    assert maxent.scored(none, F.lit(False)).count() == 0


def test_scores_beat_the_base_on_held_out_texts(spark):
    got = queries.op5_lm_scoring(spark, "/root/testdata/sf0.01").filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def plain_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0] if rest[len(host) :].startswith("/") else ""
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for site, start, says in url_filter.RULES:
        if (host == site or host.endswith("." + site)) and path.startswith(start) and (best is None or len(site + start) > len(best[0])):
            best = (site + start, says)
    return host, path, best


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://A.Example.NET/en/1?x#y", "https://net", "http://net/", "x://b.net/q", "http://example.org?/fr/", "http://w.org/fr/a://b", "ftp://example.com/de/", "http://q.example.com/zz", "http://a\nb.net/x"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = url_filter.judged(pages).orderBy("page_id").collect()
    for r, url in zip(got, urls):
        host, path, rule = plain_url(url)
        assert (r["q"]["host"], r["q"]["path"], r["q"]["rule"]) == (host, path, rule[0] if rule else None)
        assert r["q"]["verdict"] == rule[1] if rule else r["q"]["verdict"] in ("allow", "block")
    assert url_filter.judged(pages.limit(0)).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    langs = queries.op3_language_id(spark, folder).join(docs, "doc_id").filter("held_out")
    assert langs.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    good = queries.op4_quality_classifier(spark, folder).join(labels, "doc_id").filter("held_out")
    assert good.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.95


def test_token_counts_by_recount(spark, docs):
    trees = token_trees.with_trees(docs.drop("q"))
    got = token_trees.edited_counts(trees, queries.document_edits()).select("text", "source", "q.*").collect()
    e = encoder(tokenizer_path()).tokenizer
    for r in got:
        assert r["n_before"] == len(e.encode(r["text"] or "", add_special_tokens=False).ids)
        assert r["edited"].startswith(f"source: {r['source'] or 'none'}\n") and r["edited"].endswith("\n-- end of document")
        assert r["n_after"] == len(e.encode(r["edited"], add_special_tokens=False).ids)


def test_pipeline(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in cp.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, SF)
        assert docs.columns == before.columns
        docs = spark.createDataFrame(docs.collect(), before.schema)  # written, as the next stage expects
        assert docs.exceptAll(before).count() == 0
        texts = [(r["doc_id"], r["text"]) for r in before.collect()]
        left = {r["doc_id"] for r in docs.collect()}
        if name == "simhash_near_duplicates":
            prints = {}
            for key, text in sorted(texts):
                near = [k for p, k in prints.items() if (p ^ plain_fingerprint(text)).bit_count() <= 4]
                prints.setdefault(plain_fingerprint(text), key)
                assert key not in left or not near
        if name == "benchmark_decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            hits = [n for _, n, _, _ in brute_contamination([t for _, t in texts[:60]], items)]
            assert [k in left for k, _ in texts[:60]] == [n == 0 for n in hits]
    out = {r["doc_id"] for r in cp.run(spark, SF).select("doc_id").collect()}
    assert out == left


def test_pipeline_classifier_learns_from_documents_that_the_rules_drop(spark, tmp_path):
    import corpus_pipeline as cp

    turn = np.random.default_rng(11)
    common = "the of and in".split()
    good, bad = ([f"{a}{b}{c}" for a in start for b in "aeiou" for c in "lmnrst"] for start in ("bdgh", "kpvz"))
    text = lambda words, n: " ".join(turn.choice(common if i % 5 == 0 else words) for i in range(n))
    whole = [(i, text(good, 70), "en", "s") for i in range(60)] + [(i, text(bad, 20), "en", "s") for i in range(60, 100)]
    whole += [(1000, text(bad, 70), "en", "s"), (1001, text(good, 70), "en", "s")]  # without labels
    spark.createDataFrame(whole, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 60)) for i in range(100)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ruled = {r["doc_id"] for r in cp.quality_rules_stage(spark, docs, str(tmp_path)).collect()}
    assert ruled == {*range(60), 1000, 1001}  # short ones go: no label 0 is left, the bad text is
    left = cp.quality_classifier_stage(spark, docs.filter(F.col("doc_id").isin(*ruled)), str(tmp_path)).collect()
    assert {r["doc_id"] for r in left} == {*range(60), 1001}


_BITS = st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", "<|", "|>", " ", "  ", "\n", "a", "!", "'r", "e", "1"]), max_size=60).map("".join)


@settings(max_examples=300, deadline=None)
@given(_BITS, st.lists(st.tuples(st.integers(0, 300), st.integers(0, 20), _BITS.map(lambda t: t[:30])), max_size=4))
def test_added_tokens_count_as_the_library_counts_them(text, edits):
    count = token_trees.Counter(tokenizer_path())
    size = lambda t: len(count.tokenizer.encode(t, add_special_tokens=False).ids)
    tree = token_trees.build(text, count)
    assert tree.tokens == size(text)
    for start, long, new in edits:
        text, _ = token_trees.apply_edit(text, tree, start, start + long, new, count)
        assert tree.tokens == size(text) and int(tree.sums[1, 0]) == len(text)


def test_added_tokens_made_and_broken_by_edits_far_into_a_text():
    count, mark = token_trees.Counter(tokenizer_path()), "<|endoftext|>"
    for lead in range(25, 70):
        for front, behind in ((mark[:k], mark[k:]) for k in range(1, len(mark))):
            text = "a " * lead + "! " + " " * (lead % 3) + front + behind[1:] + " b" * 40
            at = text.index(front + behind[1:]) + len(front)
            tree = token_trees.build(text, count)
            for start, stop, new in ((at, at, behind[0]), (at, at + 1, "")):  # made, then broken
                text, _ = token_trees.apply_edit(text, tree, start, stop, new, count)
                assert tree.tokens == len(count.tokenizer.encode(text, add_special_tokens=False).ids)


def test_added_tokens_in_the_rows_of_token_counts(docs):
    got = token_trees.edited_counts(token_trees.with_trees(docs.drop("q")), queries.document_edits()).select("text", "q.*").collect()
    e = encoder(tokenizer_path()).tokenizer
    for r in got:
        assert r["n_before"] == len(e.encode(r["text"] or "", add_special_tokens=False).ids)
        assert r["n_after"] == len(e.encode(r["edited"], add_special_tokens=False).ids)


def test_score_features_hold_both_skips():
    units, place = np.arange(10, 16), np.arange(6)
    hashes = np.full(6, 5)
    other = units.copy()
    other[2] = 99  # three places in front of the last one
    a, b = maxent._features(hashes, units, place)[5], maxent._features(hashes, other, place)[5]
    assert len(a) == 4 and (a[:3] == b[:3]).all() and a[3] != b[3]
