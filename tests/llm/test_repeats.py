"""Periodic runs against brute force, SQL and the edge cases of the docstring."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from tidemark.llm import repeats

LONG = "word " * 40_000


def brute(words):
    found, n = {}, len(words)
    for p in range(1, n // 2 + 1):
        i = p
        while i < n:
            end = i
            while end < n and words[end] == words[end - p]:
                end += 1
            if end - i + p >= max(12, 2 * p):
                found.setdefault((i - p, end - i + p), p)
            i = max(end, i + 1)
    return sorted((start, p, length) for (start, length), p in found.items())


def drawn(draw):
    few, words = draw.choice([1, 2, 2, 3, 5, 30]), []
    while len(words) < draw.choice([0, 5, 20, 60, 150, 300]):
        kind = draw.random()
        if kind < 0.3:
            words.append(draw.randrange(few))
        elif kind < 0.6:
            words += [draw.randrange(few)] * draw.randrange(1, 40)
        elif kind < 0.8 and words:
            a = draw.randrange(len(words))
            words += words[a:draw.randrange(a, len(words) + 1)] * draw.randrange(1, 4)
        else:
            words += [draw.randrange(few) for _ in range(draw.randrange(1, 20))] * draw.randrange(1, 6)
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    draw = random.Random(seed)
    for _ in range(60):
        texts = [drawn(draw) for _ in range(draw.randrange(1, 8))]
        got = [[] for _ in texts]
        for text, start, length, period in zip(*(x.tolist() for x in repeats.find_runs([np.array(t, dtype=np.int64) for t in texts]))):
            got[text].append((start, period, length))
        assert got == [brute(t) for t in texts]


def test_many_places_of_one_word_take_few_steps():
    words = np.zeros(400_000, dtype=np.int64)
    assert [x.tolist() for x in repeats.find_runs([words])] == [[0], [0], [400_000], [1]]
    words[::1001] = 1  # many stretches of one word between others
    _, start, length, period = repeats.find_runs([words])
    assert (0, 400_000, 1001) in set(zip(start.tolist(), length.tolist(), period.tolist()))


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(con.execute(repeats.SQL).fetchall()) == sorted(map(tuple, repeats.op12_periodic_runs(spark, sf).collect()))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, LONG), (4, LONG), (None, "a b " * 6), (5, "a b " * 5 + "a"), (6, "x " + "a b c " * 4 + "y")]
    docs = spark.createDataFrame([(*r, "s", "t") for r in rows], "doc_id long, text string, _text string, runs string")
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in repeats.repeats(docs).collect()]
    assert got[:3] == [(1, [], ""), (2, [], ""), (3, [], "")]
    assert got[3] == got[4] == (4, [(0, 40_000, 1)], "word")
    assert got[5:] == [(None, [(0, 12, 2)], "a b"), (5, [], "a b a b a b a b a b a"), (6, [(1, 12, 3)], "x a b c y")]
    assert repeats.repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_planted_words_and_digests(spark, tmp_path):
    ids = [i for i in range(200) if repeats.crc32(str(i).encode()) % 10 == 0][:5]
    words = [f"w{i}".encode() for i in range(100)]
    folder = str(tmp_path)
    spark.createDataFrame([(i, b" ".join(words).decode()) for i in ids], "doc_id long, text string").write.parquet(folder + "/documents.parquet")
    for row in repeats.op12_periodic_runs(spark, folder).collect():
        made = repeats.planted(row.doc_id, words)
        g = repeats.crc32(str(row.doc_id).encode()) // 10
        a = g % 100
        p = 1 + (100 - a) // (3 + g % 8)
        assert made == [words[a + (i - a) % p if i >= a else i] for i in range(100)]
        runs = brute(made)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, q, n in runs).encode()).hexdigest() and row.n_runs == len(runs)
