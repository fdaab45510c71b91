"""Quality by positive-unlabelled learning.

Trusted positives are documents labelled good; all other text is unlabelled, whatever its label. A linear model of style
features minimises the non-negative unbiased risk with the logistic loss l:

    pi * E_positive[l(z)] + max(0, E_unlabelled[l(-z)] - pi * E_positive[l(-z)])

where pi is the share of good documents among the unlabelled ones. While the second term is below zero, the step goes the other
way, so the model can't win by calling unlabelled text bad that it has learned by heart. pi is estimated from the same two
samples: of a classifier that tells positives from unlabelled documents, over halves it was not trained on, the least ratio of the
share of unlabelled to the share of positive documents above a score, with an allowance for the sizes of the samples.

Features describe the whole text: shares of each ASCII character and of others, of capitals, of words that repeat the word
before, of different words and lines, mean length of words, words and lines. Labels below "good" are never read.

Bounds: SAMPLE positive and SAMPLE unlabelled ids with the smallest hashes, all outside the held-out fold. Without a positive
document every text gets the score DEFAULT_PRIOR.

Defined cases: null and empty texts have the features of a text without characters; a document with several labels is good if one
says so; null labels are left out; rows without an id are never learned from; of rows with one id the model learns from the first
text in code-point order; an empty table gives an empty result; further columns are ignored unless `keep` names them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import in_chunks, table
from tidemark.session import materialize

SAMPLE, FOLDS, HELD_OUT = 8_000, 4, 2
GOOD_SCORE = 0.7
DEFAULT_PRIOR = 0.5
ROUNDS, RATE = 400, 0.05
#: Ridge in rows: its weight is this over the number of positives.
RIDGE = 0.5
#: Shares are taken as log(1 + SCALE * share).
SCALE = 200.0
WIDTH = 129 + 9


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS == HELD_OUT, F.lit(True))


def features(texts: list[str | None]) -> np.ndarray:
    out = np.zeros((len(texts), WIDTH))
    for row, text in zip(out, texts):
        if not text:
            continue
        data = text.encode("utf-8", "replace")
        count = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
        row[:128] = count[:128] / len(data)
        row[128] = count[128:].sum() / len(data)
        capital, small = int(count[65:91].sum()), int(count[97:123].sum())
        row[129] = capital / max(1, capital + small)
        words = data.split()
        if words:
            row[130] = sum(map(eq, words, words[1:])) / len(words)
            row[131] = len(set(words)) / len(words)
            row[132] = sum(map(bytes.isalpha, words)) / len(words)
        lines = data.split(b"\n")
        row[133] = 1.0 - len(set(lines)) / len(lines)
        row[134:] = len(data) / (1 + len(words)) / SCALE, len(words) / (1 + len(lines)) / SCALE, len(words) / SCALE, 0.0
    return np.log1p(SCALE * out)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _fit(width: int, gradient, rounds: int = ROUNDS) -> np.ndarray:
    """Adam from zero; `gradient` is a function of the weights, the last of which is the bias."""
    w = np.zeros(width + 1)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        grad = gradient(w)
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad ** 2
        w -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return w


def _mean_grad(x: np.ndarray, error: np.ndarray) -> np.ndarray:
    """Gradient of the mean of a loss whose derivative by z is `error`."""
    return np.append(x.T @ error, error.sum()) / len(x)


def _ridge(w: np.ndarray, n: int) -> np.ndarray:
    return RIDGE / n * np.append(w[:-1], 0.0)


def nn_risk_weights(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """Weights of least non-negative unbiased risk."""

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = positive @ w[:-1] + w[-1], unlabelled @ w[:-1] + w[-1]
        as_bad = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        bad = _mean_grad(unlabelled, _sigmoid(zu)) - prior * _mean_grad(positive, _sigmoid(zp))
        good = prior * _mean_grad(positive, _sigmoid(zp) - 1.0)
        return (good + bad if as_bad >= 0 else -bad) + _ridge(w, len(positive))

    return _fit(positive.shape[1], gradient)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, each half judged by a classifier trained on the other."""
    best = []
    for half in (0, 1):
        p, u = positive[half::2], unlabelled[half::2]
        other_p, other_u = positive[1 - half::2], unlabelled[1 - half::2]
        if not min(map(len, (p, u, other_p, other_u))):
            continue

        def gradient(w: np.ndarray) -> np.ndarray:
            zp, zu = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
            return _mean_grad(p, _sigmoid(zp) - 1.0) + _mean_grad(u, _sigmoid(zu)) + _ridge(w, len(p))

        w = _fit(p.shape[1], gradient, ROUNDS // 2)
        zp, zu = np.sort(other_p @ w[:-1] + w[-1]), np.sort(other_u @ w[:-1] + w[-1])
        above_p = 1.0 - np.searchsorted(zp, zp) / len(zp)
        above_u = 1.0 - np.searchsorted(zu, zp) / len(zu)
        slack = np.sqrt(np.log(40) / 2 / len(zu)) + np.sqrt(np.log(40) / 2 / len(zp))
        k = np.argmin((above_u + slack) / above_p)
        best.append(above_u[k] / above_p[k])
    return float(np.clip(np.mean(best), 0.01, 0.99)) if best else DEFAULT_PRIOR


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weight: np.ndarray
    prior: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = (features(texts) - self.mean) / self.spread
        return _sigmoid(np.clip(x, -8, 8) @ self.weight[:-1] + self.weight[-1])


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> Model:
    width = unlabelled.shape[1]
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(width), np.ones(width), np.append(np.zeros(width), np.log(DEFAULT_PRIOR / (1 - DEFAULT_PRIOR))), DEFAULT_PRIOR)
    mean, spread = unlabelled.mean(axis=0), unlabelled.std(axis=0)
    spread[spread < 1e-6] = 1.0
    p, u = (np.clip((x - mean) / spread, -8, 8) for x in (positive, unlabelled))
    prior = class_prior(p, u) if prior is None else prior
    return Model(mean, spread, nn_risk_weights(p, u, prior), prior)


def smallest(ids: DataFrame, seed: str, sample: int) -> DataFrame:
    """The `sample` rows of ids(_id) with the smallest hashes. A bound on the hash keeps all but about twice as many rows out of
    the sort, so what meets in one task does not grow with the table."""
    place = F.xxhash64("_id", F.lit(seed))
    n = ids.count()
    if n > 2 * sample:
        ids = ids.where(place <= F.lit(-(1 << 63) + int((1 << 64) * 2 * sample / n)))
    return ids.orderBy(place, "_id").limit(sample)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on bounded samples outside the held-out fold."""
    outside = docs.where(~held_out(F.col("doc_id"))).select(docs["doc_id"].alias("_id"), docs["text"].alias("_text"))
    good = labels.where((F.col("quality") > 0) & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("_id")).distinct()
    # `sample` ids each: the bound of the broadcasts. Only their texts are read on.
    some = smallest(outside.select("_id").distinct(), "unlabelled", sample)

    def texts(chosen: DataFrame, is_good: int) -> DataFrame:
        own = outside.join(F.broadcast(chosen), "_id", "left_semi").groupBy("_id").agg(F.min("_text").alias("_text"))
        return own.withColumn("_good", F.lit(is_good))

    trusted, drawn = texts(smallest(good, "good", sample), 1), texts(some, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "_text"):
            x = features(batch.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("_id").cast(pa.int64()), batch.column("_good"), pa.array(list(x), pa.list_(pa.float64()))], ["id", "good", "x"])

    shape = "id long, good int, x array<double>"
    taken = materialize(trusted.mapInArrow(run, shape).unionByName(drawn.mapInArrow(run, shape)), "quality-sample")
    rows = taken.orderBy("good", F.xxhash64("id"), "id", "x").toArrow()  # twice `sample` rows of WIDTH numbers
    x = np.array(rows.column("x").to_pylist()).reshape(-1, WIDTH)
    is_good = rows.column("good").to_numpy() == 1
    return fit(x[is_good], x[~is_good])


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns of every row of docs(doc_id, text) with held_out, score and predicted."""
    data = docs.select(*keep, held_out(docs["doc_id"]).alias("_held"), docs["text"].alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "_text"):
            scores = model.score(batch.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores), pa.array((scores >= GOOD_SCORE).astype(np.int32))], [*keep, "held_out", "score", "predicted"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in data.schema.fields[:-2]]
    return data.mapInArrow(run, ", ".join([*fields, "held_out boolean, score double, predicted int"]))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))
