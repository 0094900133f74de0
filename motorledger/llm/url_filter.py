"""URL filters: host and path rules first, then a ratio of character language models.

Two smoothed variable-order Markov models are counted over all URLs that a rule decides, one
for accepted and one for rejected ones. A URL's evidence is the difference of its log
likelihoods per character. The limit above which a URL is accepted is calibrated on decided
URLs that were held apart from the counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorledger.llm.common import stored

#: (host, path, verdict) as given for the pages table.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
ORDERS = 5  # contexts of 0 to 4 characters
BINS = 1 << 16  # hashed (context, character) cells per order
_STEPS = 401
_REACH = 4.0  # evidence is counted on a grid from -REACH to REACH


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(.*?)://([^/?#]*)", 2)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(.*?)://[^/?#]*(/[^?#]*)?", 2)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for site, start, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(start)
        name, verdict = F.when(fits, F.lit(site + start)).otherwise(name), F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def _cells(urls: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Per order the hashed context and cell of every character, and the URL each character is in."""
    lengths = np.array([len(u) + 1 for u in urls], np.int64)
    data = np.frombuffer(b"".join(u + b"\n" for u in urls), np.uint8).astype(np.uint32)  # an end of its own
    owner = np.repeat(np.arange(len(urls)), lengths)
    place = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    context = np.zeros(len(data), np.uint32)
    contexts, cells = [], []
    for order in range(ORDERS):
        if order:
            before = np.zeros(len(data), np.uint32)
            before[order:] = data[:-order] if len(data) > order else 0
            before[place < order] = 1  # in front of the start
            context = context * np.uint32(0x01000193) + before + np.uint32(7)
        mixed = context * np.uint32(0x85EBCA6B) + np.uint32(order)
        contexts.append((mixed >> np.uint32(16)).astype(np.int64))
        cells.append((((mixed ^ (data * np.uint32(0xC2B2AE35))) * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64))
    return contexts, cells, owner


@dataclass(frozen=True)
class MarkovModel:
    """Counts of contexts and of (context, character) cells, by order."""

    contexts: np.ndarray
    cells: np.ndarray

    def log_likelihoods(self, urls: list[bytes]) -> np.ndarray:
        """Per character, by interpolation from order 0 upwards (each order weighs as often as it was seen)."""
        contexts, cells, owner = _cells(urls)
        p = np.full(len(owner), 1 / 256)
        for order in range(ORDERS):
            seen = self.contexts[order][contexts[order]]
            p = (np.minimum(self.cells[order][cells[order]], seen) + 2.0 * p) / (seen + 2.0)
        whole = np.bincount(owner, np.log(p), len(urls))
        return whole / np.bincount(owner, minlength=len(urls))


@dataclass(frozen=True)
class UrlModel:
    accepted: MarkovModel
    rejected: MarkovModel
    limit: float

    def evidence(self, urls: list[bytes]) -> np.ndarray:
        return self.accepted.log_likelihoods(urls) - self.rejected.log_likelihoods(urls) if urls else np.zeros(0)


def _count_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        urls, says = batch.column("url").cast(pa.binary()).to_pylist(), batch.column("verdict").to_pylist()
        for verdict in set(says):
            mine = [u for u, v in zip(urls, says) if v == verdict]
            contexts, cells, _ = _cells(mine)
            table = totals.setdefault(verdict, np.zeros((2 * ORDERS, BINS), np.int64))
            for order in range(ORDERS):
                table[order] += np.bincount(contexts[order], minlength=BINS)
                table[ORDERS + order] += np.bincount(cells[order], minlength=BINS)
    for verdict, table in totals.items():
        row, cell = np.nonzero(table)
        for at in range(0, len(row), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array([verdict] * len(row[part])), pa.array((row[part] * BINS + cell[part]).astype(np.int64)), pa.array(table[row[part], cell[part]])],
                ["verdict", "cell", "n"],
            )


def _evidence(model: UrlModel):
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array(model.evidence(part.cast(pa.large_binary()).to_pylist()), pa.float64())

    run.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "double")


def train(decided: DataFrame) -> UrlModel:
    """Models and limit from ``url`` and ``verdict`` of all decided URLs; a fifth of them, by hash, only calibrates.

    The limit is where the shares of wrongly accepted and wrongly rejected URLs add up to least;
    the middle of several such places is taken. Without URLs of one verdict the limit accepts all.
    """
    apart = F.pmod(F.xxhash64("url"), F.lit(5)) == 0
    decided = decided.select("url", "verdict").filter("url IS NOT NULL AND verdict IS NOT NULL")
    counts = decided.filter(~apart).mapInArrow(_count_task, "verdict string, cell long, n long")
    summed = counts.groupBy("verdict", "cell").agg(F.sum("n").alias("n")).toArrow()  # at most 2 * 2 * ORDERS * BINS rows
    tables = {}
    for verdict in ("allow", "block"):
        flat = np.zeros(2 * ORDERS * BINS)
        mine = summed.filter(pc.equal(summed.column("verdict"), verdict))
        flat[mine.column("cell").to_numpy()] = mine.column("n").to_numpy()
        flat = flat.reshape(2 * ORDERS, BINS).astype(np.float32)
        tables[verdict] = MarkovModel(flat[:ORDERS], flat[ORDERS:])
    model = UrlModel(tables["allow"], tables["block"], -np.inf)
    grid = F.round((F.greatest(F.lit(-_REACH), F.least(F.lit(_REACH), _evidence(model)(F.col("url")))) + _REACH) / (2 * _REACH) * (_STEPS - 1))
    seen = decided.filter(apart).select("verdict", grid.cast("int").alias("step")).groupBy("verdict", "step").agg(F.count("*").alias("n")).collect()
    sides = {v: np.bincount([r["step"] for r in seen if r["verdict"] == v], [r["n"] for r in seen if r["verdict"] == v], _STEPS) for v in ("allow", "block")}
    if not sides["allow"].sum() or not sides["block"].sum():
        return model
    lost = np.concatenate([[0], np.cumsum(sides["allow"])]) / sides["allow"].sum()  # rejected though accepted, by limit
    let = 1 - np.concatenate([[0], np.cumsum(sides["block"])]) / sides["block"].sum()
    best = np.flatnonzero(np.isclose(lost + let, (lost + let).min()))
    limit = (float(np.median(best)) - 0.5) / (_STEPS - 1) * 2 * _REACH - _REACH
    return UrlModel(model.accepted, model.rejected, limit)


def judged(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Every row of ``pages`` with a column ``q``: host, path, rule, evidence (null where a rule decides), verdict.

    A null URL, or one without ``://``, has an empty host and path, no rule, and is judged by its characters.
    A repeated row is judged twice with one result; a column of ``pages`` named ``q`` is replaced.
    """
    pages = pages.drop("q")
    url = F.col("url").cast("string")
    rows = pages.select(F.struct("*").alias("page"), F.coalesce(url, F.lit("")).alias("url"), url_host(url).alias("host"), url_path(url).alias("path"))
    name, says = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", name).withColumn("verdict", says)
    short = stored(rows.select("url", "verdict").filter("verdict IS NOT NULL"), "decided-urls")
    model = train(short)
    evidence = F.when(F.col("verdict").isNull(), _evidence(model)(F.col("url")))
    rows = rows.withColumn("evidence", evidence)
    final = F.coalesce("verdict", F.when(F.col("evidence") >= F.lit(model.limit), "allow").otherwise("block"))
    return rows.select("page.*", F.struct("host", "path", "rule", "evidence", final.alias("verdict")).alias("q"))
