"""Quality classifier: naive Bayes features in a linear support vector machine.

A text's features are indicators of its hashed byte n-grams (1 to 4 bytes) and of the n-grams of
its repetition marks (does a word equal the one before it). Each indicator is scaled by the
feature's log-count ratio between the two classes; a linear model with hinge loss is fitted to
the scaled, length-normalised vectors by dual coordinate descent, and its margins are turned
into probabilities by a logistic curve fitted to held-apart folds of the training rows.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorledger.llm.common import slices, stored

BINS = 1 << 17
_MARKS = 32  # bins in front of the hashed ones
#: The classifier is fitted on at most so many labelled rows, those with the least hash of their id.
TRAINING_ROWS = 4000
#: And on so many features of these rows in all, 4 bytes each.
TRAINING_FEATURES = 1 << 26
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
THRESHOLD = 0.3


def features(text: bytes | None) -> np.ndarray:
    """Ascending distinct feature numbers of one text; none for a null or empty text."""
    seen = np.zeros(BINS, np.bool_)
    if not text:
        return np.zeros(0, np.int32)
    data = np.frombuffer(text, np.uint8).astype(np.uint32)
    gram = np.zeros(len(data), np.uint32)
    for size in range(1, 5):
        if len(data) < size:
            break
        gram = gram[: len(data) - size + 1] * np.uint32(0x01000193) + data[size - 1 :] + np.uint32(size)
        mixed = gram * np.uint32(0x9E3779B1)
        seen[_MARKS + ((mixed >> np.uint32(15)) % np.uint32(BINS - _MARKS))] = True
    words = text.split()
    if len(words) > 1:
        same = np.fromiter(map(operator.eq, words, words[1:]), np.uint8, len(words) - 1)
        code = np.zeros(len(same), np.uint8)
        for size in range(1, 5):
            if len(same) < size:
                break
            code = code[: len(same) - size + 1] * np.uint8(2) + same[size - 1 :]
            seen[code + np.uint8((1 << size) - 2)] = True
    return np.flatnonzero(seen).astype(np.int32)


def _margins(rows: list[np.ndarray], weights: np.ndarray, ratio: np.ndarray, bias: float) -> np.ndarray:
    out = np.full(len(rows), bias)
    for at, row in enumerate(rows):
        if len(row):
            scaled = ratio[row]
            out[at] += weights[row] @ scaled / max(float(np.sqrt(scaled @ scaled)), 1e-9)
    return out


def _fit(rows: list[np.ndarray], label: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Log-count ratios, then dual coordinate descent for the hinge loss with a constant feature."""
    up, down = np.full(BINS, SMOOTHING), np.full(BINS, SMOOTHING)
    for row, y in zip(rows, label):
        (up if y > 0 else down)[row] += 1
    ratio = np.log(up / up.sum()) - np.log(down / down.sum())
    values = []
    for row in rows:
        scaled = ratio[row]
        values.append(scaled / max(float(np.sqrt(scaled @ scaled)), 1e-9))
    weights, bias, alpha = np.zeros(BINS), 0.0, np.zeros(len(rows))
    square = np.array([v @ v + 1.0 for v in values])
    # the rarer class weighs as much as the other
    cost = COST * len(rows) / (2 * np.where(label > 0, (label > 0).sum(), (label < 0).sum()))
    turn = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in turn.permutation(len(rows)):
            gradient = label[i] * (weights[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * label[i]
                weights[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
    return ratio, weights, bias


def _curve(margin: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of the margins, by Newton steps on smoothed targets."""
    n1, n0 = positive.sum(), (~positive).sum()
    target = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, offset = 1.0, float(np.log((n1 + 1) / (n0 + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        w, g = p * (1 - p) + 1e-9, p - target
        hessian = np.array([[(w * margin**2).sum() + 1e-6, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hessian, np.array([(g * margin).sum(), g.sum()]))
        slope, offset = slope - float(step[0]), offset - float(step[1])
        if np.abs(step).max() < 1e-6:
            break
    return max(slope, 1e-3), offset


@dataclass(frozen=True)
class QualityModel:
    """``weight`` holds weights times ratios, ``ratio`` the ratios themselves, for the norm."""

    weight: np.ndarray
    ratio: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        margin = np.full(len(texts), self.bias)
        for at, text in enumerate(texts):
            row = features(text)
            if len(row):
                scaled = self.ratio[row]
                margin[at] += self.weight[row].sum() / max(float(np.sqrt(scaled @ scaled)), 1e-9)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def fit(rows: list[np.ndarray], positive: np.ndarray) -> QualityModel:
    """The model of the given feature rows. With one class only, or no rows, every text gets its rate."""
    if not positive.any() or positive.all():
        rate = (positive.sum() + 1) / (len(positive) + 2)
        return QualityModel(np.zeros(BINS, np.float32), np.zeros(BINS, np.float32), 0.0, 1.0, float(np.log(rate / (1 - rate))))
    label = np.where(positive, 1.0, -1.0)
    margin, fold = np.zeros(len(rows)), np.arange(len(rows)) % 2
    for part in (0, 1):
        mine, other = np.flatnonzero(fold != part), np.flatnonzero(fold == part)
        if len(set(label[mine])) == 2:
            ratio, weights, bias = _fit([rows[i] for i in mine], label[mine])
            margin[other] = _margins([rows[i] for i in other], weights, ratio, bias)
    slope, offset = _curve(margin, positive)
    ratio, weights, bias = _fit(rows, label)
    return QualityModel((weights * ratio).astype(np.float32), ratio.astype(np.float32), bias, slope, offset)


def _feature_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        found = pa.array([features(t) for t in texts], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int32()), found], ["rank", "label", "row"])


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, rows: int = TRAINING_ROWS) -> QualityModel:
    """Fit on the labelled documents for which ``usable`` (over ``doc_id``) holds, ``rows`` at most.

    A document labelled more than once counts with its lowest label, one that occurs more than once with
    its least text, so the model does not depend on how the tables are laid out. Null labels and ids
    are not used. Rows are taken by the hash of their id until they hold ``TRAINING_FEATURES`` features.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label")).dropna()
    if usable is not None:
        known = known.filter(usable)
    known = known.groupBy("doc_id").agg(F.min("label").alias("label")).withColumn("rank", F.xxhash64("doc_id"))
    chosen = F.broadcast(known.orderBy("rank", "doc_id").limit(rows))  # at most `rows` short rows
    pairs = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(chosen, "doc_id")
    pairs = pairs.groupBy("doc_id", "rank", "label").agg(F.min("text").alias("text"))
    found = stored(pairs.select("rank", "label", "text").mapInArrow(_feature_task, "rank long, label int, row array<int>"), "quality-features")
    sizes = found.select("rank", F.size("row").alias("n")).orderBy("rank").collect()  # `rows` short rows
    within = np.cumsum([r["n"] for r in sizes]) <= TRAINING_FEATURES
    last = sizes[int(within.sum()) - 1]["rank"] if within.any() else None
    collected = found.filter(F.col("rank") <= F.lit(last)).orderBy("rank", "label").toArrow()  # bounded by `rows` and features
    lists = collected.column("row").combine_chunks()
    stops, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    feature_rows = [flat[a:b] for a, b in zip(stops[:-1], stops[1:])]
    return fit(feature_rows, collected.column("label").to_numpy() > 0)


def score_with(model: QualityModel) -> Callable[[Column], Column]:
    """A column function from texts to the probability of label 1; null counts as empty."""

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array(model.score(part.cast(pa.large_binary()).to_pylist()))

    run.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "double")


def classified(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """Every row with a column ``q`` of ``score`` and ``predicted``; null and empty texts score the bias.

    A repeated row is scored twice with one result; a column of ``docs`` named ``q`` is replaced.
    """
    docs = docs.drop("q")
    score = score_with(model)(F.col("text").cast("string"))
    rows = docs.select(F.struct("*").alias("doc"), score.alias("score"))
    return rows.select("doc.*", F.struct("score", (F.col("score") >= threshold).cast("int").alias("predicted")).alias("q"))
