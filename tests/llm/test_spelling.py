"""Spelling variants against brute force, SQL and the edge cases of the docstring."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from tidemark.llm import spelling


def near(a, b):
    if a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(count):
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    out = {}
    for w, n in words.items():
        others = sorted((-m, x) for x, m in words.items() if near(w, x))
        form = others[0][1] if others and -others[0][0] >= 2 * n else None
        out[w] = (form, n, len(others), -others[0][0] if form else None)
    rows = []
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, n_near, form_n))
    return sorted(rows, key=lambda r: r[0])


@pytest.fixture(scope="module")
def drawn():
    draw, count = random.Random(3), Counter()
    for _ in range(60):
        word = "".join(draw.choices("abcdeéß", k=draw.randint(5, 9)))
        count[word] += draw.randint(3, 60)
        for _ in range(6):
            at, kind = draw.randrange(len(word)), draw.randrange(3)
            other = word[:at] + ("" if kind == 0 else draw.choice("abcdeéß")) + word[at + (kind != 1):]
            count[other] += draw.randint(1, 20)
            word = draw.choice([word, other])
    count["z" * 70] += 9
    count["z" * 69 + "y"] += 3
    count["z" * 71] += 4
    return count


def test_groups_equal_brute_force(spark, drawn, monkeypatch):
    # Small shards and passes: several filters of a length, several broadcasts.
    monkeypatch.setattr(spelling, "SHARD_WORDS", 40)
    monkeypatch.setattr(spelling, "PASS_BYTES", 300)
    rows = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(sorted(drawn.items()))]
    got = spelling.group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == brute(drawn)
    assert len(spelling.Shards.of(dict(Counter(map(len, drawn)))).passes()) > 1


def test_filters_hold_every_edit_that_is_a_word(drawn):
    words = sorted(w for w in drawn if len(w) >= 5)
    shards = spelling.Shards.of(dict(Counter(min(len(w), spelling.LONGEST) for w in words)))
    held = {}
    for length, rows in spelling.by_length(words).items():
        h = np.bitwise_xor.reduce(spelling.letter_hash(np.arange(length), spelling.codes([words[k] for k in rows])), axis=1)
        for k, x in zip(shards.shard(h, length).tolist(), h.tolist()):
            held.setdefault(k, []).append(x)
    filters = spelling.Filters(shards, {k: spelling.built(np.array(x, dtype=np.uint64), int(shards.blocks[k])) for k, x in held.items()})
    alphabet = np.array(sorted({ord(c) for w in words for c in w}), dtype=np.uint32)
    found = [(words[k], w) for k, w in spelling.neighbours(words, filters, alphabet)]
    exact = sorted(frozenset(p) for p in found if p[1] in set(words))
    assert sorted(map(sorted, exact)) == sorted([a, b] for a in words for b in words if a < b and near(a, b))


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(con.execute(spelling.SQL).fetchall()) == sorted(map(tuple, spelling.op11_spelling_variants(spark, sf).collect()))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "123 !!!"), (None, "Colour colour COLOUR"), (4, "color " * 50_000), (4, "color"), (5, "colxr colxr colxr"), (6, "four"), (7, "hello" * 3)]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, word string, n int")
    got = {r.word: tuple(r)[1:] for r in spelling.group(docs).collect()}
    assert got == {"color": (None, "color", 50_001, 2, None), "colour": ("color", "color", 3, 1, 50_001), "colxr": ("color", "color", 3, 1, 50_001)}
    assert spelling.group(spark.createDataFrame([], "doc_id long, text string")).count() == 0
