"""Comparison of rows around a smallest class: no link between components may be lost, whole or in pieces."""

import random

import numpy as np
import pandas as pd
import pytest

from tests.llm.test_llm import brute_components
from tidemark.llm import ngrams
from tidemark.llm.ngrams import _around, join, similar, sketch_of


def top(parent, x):
    while parent.setdefault(x, x) != x:
        x = parent[x]
    return x


def connected(frame, found):
    """Whether two classes around `at` are connected by components and found links."""
    parent = {}
    for at, cid, comp in frame[["at", "cid", "comp"]].itertuples(index=False):
        parent[top(parent, (at, cid))] = top(parent, (at, "comp", comp))
    place = dict(zip(frame["cid"], frame["at"]))
    for a, b in found:
        parent[top(parent, (place[a], a))] = top(parent, (place[b], b))
    return lambda at, a, b: top(parent, (at, a)) == top(parent, (at, b))


def test_forests_lose_no_link():
    rng = np.random.default_rng(1)
    rows = []
    for at in range(6):
        base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        for k in range(25):
            m = int(rng.integers(40, 400))
            row, other = base[:m].copy(), int(rng.integers(0, m // 4 + 1))
            row[rng.choice(m, other, replace=False)] = rng.integers(0, 1 << 63, other, dtype=np.uint64)
            rows.append((at, at * 100 + k, int(rng.integers(0, 12)), np.unique(row)))
    frame = pd.DataFrame([{"i": 0, "j": 0, "at": a, "cid": c, "comp": p, "n": len(r), "piece": 0, "sketch": sketch_of(r), "row": ngrams.packed(r)}
                          for a, c, p, r in rows])
    whole = {(x[1], y[1]) for x in rows for y in rows if x[0] == y[0] and x[1] < y[1] and similar(len(np.intersect1d(x[3], y[3])), len(x[3]), len(y[3]))}
    comp = {x[1]: x[2] for x in rows}
    links = {(a // 100, a, b) for a, b in whole if comp[a] != comp[b]}
    assert links and set(map(tuple, ngrams._near(frame).to_numpy().tolist())) >= {(at, c) for at, a, b in links for c in (a, b)}
    found = _around(frame).to_numpy().tolist()
    assert len(found) < len(rows) and {tuple(sorted(x)) for x in found} <= whole and all(connected(frame, found)(*link) for link in links)
    two = frame.assign(piece=frame["cid"] % 2)
    parts = [two[two["piece"] == 0].assign(i=0, j=0), two[two["piece"] == 1].assign(i=1, j=1), two.assign(i=0, j=1)]
    joint = [x for part in parts for x in _around(part).to_numpy().tolist()]
    assert all(connected(frame, joint)(*link) for link in links)


@pytest.mark.parametrize("rows_a_piece", [4_096, 40])
def test_a_hot_group_of_near_copies_equals_brute_force(spark, monkeypatch, rows_a_piece):
    """Distinct near copies of one text, of which some link only through others and some not at all."""
    monkeypatch.setattr(ngrams, "PIECE_ROWS", rows_a_piece)
    draw, base = random.Random(2), [f"w{i}" for i in range(40)]
    texts = set()
    while len(texts) < 300:
        words = base.copy()
        for at in draw.sample(range(40), 2):
            words[at] = f"x{draw.randrange(12)}"
        texts.add(" ".join(words))
    rows = list(enumerate(sorted(texts)))
    got = sorted(map(tuple, join(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == brute_components(rows) and 1 < len({c for _, _, c in got}) < 300


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_little_reaches_the_driver(spark, monkeypatch, broadcast_rows):
    """Neither a row for each frequent n-gram or marked class, nor the salted classes of a broadcast."""
    monkeypatch.setattr(ngrams, "BROADCAST_ROWS", broadcast_rows, raising=False)
    draw, base, sent, plans = random.Random(2), [f"w{i}" for i in range(40)], [], []
    texts = [" ".join(f"x{draw.randrange(12)}" if draw.random() < 0.08 else w for w in base) for _ in range(300)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    of, collect, to_pandas, stored = type(docs), type(docs).collect, type(docs).toPandas, ngrams.materialize
    with monkeypatch.context() as m:
        m.setattr(of, "collect", lambda df: sent.append(len(got := collect(df))) or got)
        m.setattr(of, "toPandas", lambda df: sent.append(len(got := to_pandas(df))) or got)
        m.setattr(ngrams, "materialize", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString().split("\n")) or stored(df, name))
        found = join(docs)
    assert max(sent) <= 256 and sorted(map(tuple, found.collect())) == brute_components(rows)
    depth = lambda line: len(line) - len(line.lstrip(" :+-|*"))
    salted = 0
    for plan in plans:
        above = []
        for line in plan:
            above = [x for x in above if depth(x) < depth(line)] + [line]
            if "Generate" in line and "[salt#" in line:
                salted += 1
                assert "SortMergeJoin" in [x for x in above if "Join" in x or "BroadcastExchange" in x][-1]
    assert bool(salted) == (broadcast_rows == 0)


def test_sketches_come_to_the_driver_as_bytes(spark):
    draw = random.Random(3)
    want = np.zeros(1 << 12, dtype=np.uint8)
    for at in draw.sample(range(1 << 12), 900):
        want[at] = draw.randrange(1, 250)
    rows = [(int(at), int(want[at])) for at in np.flatnonzero(want)]
    frame = spark.createDataFrame(rows, "at long, n long")
    assert np.array_equal(ngrams._array(frame, 1 << 12, lambda n: n), want)
    assert not ngrams._array(frame.limit(0), 1 << 12, lambda n: n).any()


def test_long_columns_in_pieces_give_the_same_components(spark):
    """A hot group of distinct near copies: no task holds a whole column, and no link is lost."""
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join([*base[:k % 5], *base[5:], f"x{k}", f"y{k % 7}"]) for k in range(90)] + [f"own {k} words of no group {k}" for k in range(20)]
    texts += [" ".join(f"v{i}" for i in range(40)) + f" z{k}" for k in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    whole = sorted(map(tuple, join(docs).collect()))
    assert len({c for _, _, c in whole}) < 30 and sorted(map(tuple, join(docs, long_rows=8).collect())) == whole


def test_a_piece_has_the_smallest_class_of_the_whole_column():
    key = np.arange(1, 6, dtype=np.uint64)
    level = np.zeros(ngrams.SKETCH, dtype=np.uint8)
    level[1:6] = 6  # 64 to 127 rows
    rows = [(cid, key) for cid in range(100, 200)]
    batches = list(ngrams._postings(iter(rows), level, 3, 16))
    least = list(ngrams._smallest(iter(rows), level, 16))
    batches += list(ngrams._to_pieces(iter(least), level, 3, 16))
    frame = pd.concat([b.to_pandas() for b in batches])
    stars, largest = set(), 0
    for _, group in frame.groupby(["block", "piece"]):
        found = ngrams._pairs(group)
        assert (found["many"] == 1).all()
        stars |= set(found[["a", "b"]].itertuples(index=False, name=None))
        largest = max(largest, sum(len(x) for x in group["cid"]) // 8)
    assert stars == {(100, b) for b in range(101, 200)} and largest < 100
