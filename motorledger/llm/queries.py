"""One query per operator over the given tables, and equivalent SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorledger.llm import (
    decontaminate, language, maxent, packing, periodic, phrases, quality_model, quality_rules, simhash, token_trees, tokenfiles, url_filter, warc,
)
from motorledger.llm.common import id_remainder, stored, table


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    items = F.array_sort("items")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


#: How far the words of a benchmark window may stand from its longest word to count as near it.
PROXIMITY = 2 * decontaminate.WINDOW_WORDS


def decontamination_proximity(spark: SparkSession, folder: str) -> DataFrame:
    """Exact and proximity matches of all documents: reordered or interrupted windows count as near."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), proximity=PROXIMITY)
    near = F.array_sort("near")
    return found.select(
        "doc_id", "n_hit", F.size("near").cast("long").alias("n_near"), F.sha2(F.array_join(near, ","), 256).alias("near_sha256"),
    )


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.train(docs, id_remainder(4) != 2)
    found = language.identified(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (id_remainder(4) == 2).alias("held_out"), "q.lang_pred", "q.score")


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality_model.train(docs, table(spark, folder, "labels"), id_remainder(5) != 0)
    found = quality_model.classified(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (id_remainder(5) == 0).alias("held_out"), "q.score", "q.predicted")


def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    found = maxent.scored(table(spark, folder, "documents"), id_remainder(10) == 0)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    found = url_filter.judged(table(spark, folder, "pages").select("page_id", "url"))
    return found.select("page_id", "q.host", "q.path", "q.rule", "q.verdict", "q.evidence")


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


#: What the token-count query masks: the first address of a text.
_MAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"


def document_edits() -> Column:
    """Edits of a document row: a source line in front, the first mail address masked, an end mark behind."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    head = F.concat(F.lit("source: "), F.coalesce(F.col("source").cast("string"), F.lit("none")), F.lit("\n"))
    mail = F.regexp_extract(text, _MAIL, 0)
    at = F.length(head) + F.instr(text, mail) - 1
    size = F.length(text) + F.length(head)
    edit = lambda start, stop, new: F.struct(start.cast("int").alias("start"), stop.cast("int").alias("stop"), new.alias("new"))
    masked = F.when(mail != "", edit(at, at + F.length(mail), F.lit("<EMAIL>")))
    end = size + F.when(mail != "", F.lit(len("<EMAIL>")) - F.length(mail)).otherwise(F.lit(0))
    return F.array(edit(F.lit(0), F.lit(0), head), masked, edit(end, end, F.lit("\n-- end of document")))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    trees = stored(token_trees.with_trees(docs), "token-trees")
    found = token_trees.edited_counts(trees, document_edits(), keep_text=False)
    return found.select("doc_id", "q.n_before", "q.n_after", "q.n_edits", "q.n_reread", "q.n_chars")


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_rules.judged(table(spark, folder, "documents").select("doc_id", "lang", "text"))
    return found.select("doc_id", "q.*")


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfiles.read_ids(tokenfiles.write_ids(table(spark, folder, "documents")))


def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.write_archives(table(spark, folder, "pages").select("page_id", "url", "html"))
    found = warc.read_archives(spark, archives, with_payload=False).filter("kind = 'record'")
    return found.select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes",
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"), F.col("type").alias("record_type"),
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    found = phrases.collocations(table(spark, folder, "documents").select("lang", "text"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where one document in ten gets a periodic tail.

    With h the crc32 of the id as text, g = h div 10 and n words, a text whose h ends in 0 becomes its
    words joined by spaces, word i from a = g % n on being word a + (i - a) % p, where
    p = 1 + (n - a) div (3 + g % 8). A null id counts as the empty text.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    words = F.array_remove(F.split(F.translate(F.col("text").cast("string"), "\t\n\x0b\x0c\r", "     "), " "), "")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n, g = F.size("w"), F.col("g")
    rows = rows.select("doc_id", "text", "w", "g", F.when(n > 0, (g % n).cast("int")).alias("a"))
    period = 1 + F.floor((n - F.col("a")) / (3 + g % 8)).cast("int")
    rows = rows.select("doc_id", "text", "w", "a", period.alias("p"))
    tail = lambda word, i: F.when(i < F.col("a"), word).otherwise(F.get("w", F.col("a") + (i - F.col("a")) % F.col("p")))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(F.transform("w", tail), " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.with_runs(planted(table(spark, folder, "documents")))
    runs = F.col("q.runs")
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run"))))["run"]
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("q.collapsed"), 256).alias("collapsed_sha256"),
    )
    milli = F.expr("1000 * best.length div best.period")
    return rows.select("doc_id", "n_runs", "best.*", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format("text")} AS w FROM benchmark),
win AS (
    SELECT DISTINCT item, len(w[s:s + 9]) AS n, array_to_string(w[s:s + 9], ' ') AS p
    FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - 8))) AS s FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
    SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS p
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)
),
hit AS (SELECT g.r, g.s, g.n, win.item FROM grams g JOIN win ON g.n = win.n AND g.p = win.p),
covered AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS x FROM hit) GROUP BY r),
items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
    sha256(coalesce(i.names, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c ON d.r = c.r LEFT JOIN items i ON d.r = i.r
"""

OP11_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS data FROM pages),
d AS (SELECT page_id, octet_length(data) AS size, sha256(data) AS digest FROM p),
firsts AS (SELECT digest, min(page_id) AS first FROM d WHERE size >= 100 GROUP BY digest)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
    CASE WHEN first IS NOT NULL AND (page_id IS NULL OR page_id > first) THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id IS NULL OR page_id > first THEN first END AS refers_to
FROM d LEFT JOIN firsts ON d.digest = firsts.digest
"""

OP12_SQL = f"""
WITH pieces AS (
    SELECT coalesce(CAST(lang AS VARCHAR), 'und') AS lang,
        unnest(string_split_regex({_LOWER.format("text")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
),
d AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM d GROUP BY lang),
f AS (
    SELECT lang, k, array_to_string(w[s:s + k - 1], ' ') AS phrase, count(*) AS a
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
    GROUP BY ALL HAVING count(*) >= 30
),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (
    SELECT lang, k, phrase, a, j, array_to_string(w[1:j], ' ') AS first, array_to_string(w[j + 1:], ' ') AS rest
    FROM (SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS j FROM c)
),
scored AS (
    SELECT cut.lang, cut.k, cut.phrase, cut.a, j, x.a AS l, y.a AS r,
        CAST(CAST(2000000 AS HUGEINT) * cut.a // (x.a + y.a) AS BIGINT) AS score
    FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.first AND x.k = j
    JOIN f y ON y.lang = cut.lang AND y.phrase = cut.rest AND y.k = cut.k - j
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_parts AS (
    SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS a
    FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS s FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k)
    GROUP BY ALL
),
kept AS (
    SELECT lowest.* FROM lowest LEFT JOIN inner_parts i ON i.lang = lowest.lang AND i.phrase = lowest.phrase
    WHERE i.a IS NULL OR 100 * i.a < 80 * lowest.a
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "decontamination_proximity": decontamination_proximity,
    "op2_packing": op2_packing,
    "op3_language_id": op3_language_id,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_url_filter": op6_url_filter,
    "op7_simhash": op7_simhash,
    "op8_token_counts": op8_token_counts,
    "op9_quality_rules": op9_quality_rules,
    "op10_token_files": op10_token_files,
    "op11_warc": op11_warc,
    "op12_collocations": op12_collocations,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": pipeline,
}

SQL: dict[str, str] = {"op1_decontamination": OP1_SQL, "op11_warc": OP11_SQL, "op12_collocations": OP12_SQL}
