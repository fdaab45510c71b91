"""Positive-unlabelled learning: risk and gradient by brute force, the prior on mixtures, held-out accuracy, edge cases."""

import numpy as np
import pytest

from tidemark.llm import quality


def risk(w, p, u, prior):
    loss = lambda z: np.log1p(np.exp(-z))
    zp, zu = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
    return prior * loss(zp).mean() + max(0.0, loss(-zu).mean() - prior * loss(-zp).mean()) + quality.RIDGE / len(p) / 2 * (w[:-1] ** 2).sum()


@pytest.fixture(scope="module")
def mixture():
    draw = np.random.default_rng(5)
    good, bad = draw.normal(1.0, 1.0, (6_000, 3)), draw.normal(-2.0, 1.0, (4_000, 3))
    return good[:3_000], np.vstack([good[3_000:], bad])[draw.permutation(7_000)]  # 3 of 7 unlabelled rows are good


def test_weights_have_the_least_risk_in_their_neighbourhood(mixture):
    p, u = mixture
    w = quality.nn_risk_weights(p, u, 3 / 7)
    draw, here = np.random.default_rng(1), risk(w, p, u, 3 / 7)
    assert here < risk(np.zeros(4), p, u, 3 / 7)
    assert all(here <= risk(w + step * draw.normal(size=4), p, u, 3 / 7) + 1e-3 for step in (0.05, 0.3) for _ in range(20))


def test_risk_stays_non_negative_where_the_plain_one_does_not():
    """A few wide rows can be learned by heart: the unbiased risk without the bound falls below zero, the bounded one does not."""
    draw = np.random.default_rng(2)
    p, u = draw.normal(size=(20, 100)), draw.normal(size=(20, 100))
    w = quality.nn_risk_weights(p, u, 0.6)
    zp, zu = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
    assert np.logaddexp(0, zu).mean() - 0.6 * np.logaddexp(0, zp).mean() > -0.1


def test_prior_of_a_mixture(mixture):
    assert abs(quality.class_prior(*mixture) - 3 / 7) < 0.06


def test_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    got = quality.op13_quality(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out AND quality IS NOT NULL").collect()
    good, bad = [r for r in got if r.quality], [r for r in got if not r.quality]
    assert sum(r.predicted for r in good) >= 0.95 * len(good) and sum(not r.predicted for r in bad) >= 0.6 * len(bad)
    assert all((r.score >= 0.7) == bool(r.predicted) and 0 <= r.score <= 1 for r in got)


def test_labels_of_the_held_out_fold_and_bad_labels_change_nothing(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    own = quality.learn(docs, labels)
    other = quality.learn(docs, labels.where("quality = 1").where(~quality.held_out(labels["doc_id"])))
    assert np.array_equal(own.weight, other.weight)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Some words of a text."), (4, "Some words of a text."), (None, "no id"), (6, "word " * 40_000), (7, "日本 ünï")]
    docs = spark.createDataFrame([(*r, 0.5, "x", 1) for r in rows], "doc_id long, text string, score double, _text string, predicted int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.score(docs, quality.learn(docs, none)).collect()
    assert len(got) == 8 and {r.score for r in got} == {0.5} and next(r for r in got if r.doc_id is None).held_out
    labels = spark.createDataFrame([(4, 1), (4, None), (4, 0), (None, 1), (9, 1), (6, 1), (7, 0)], "doc_id long, quality int")
    got = quality.score(docs, quality.learn(docs, labels)).collect()
    assert len(got) == 8 and all(0 <= r.score <= 1 for r in got)
    assert quality.score(spark.createDataFrame([], "doc_id long, text string"), quality.learn(spark.createDataFrame([], "doc_id long, text string"), none)).count() == 0
