"""Operators of the training-data package against brute force, libraries and the edge cases their docstrings state."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import html_text, language, mixing, neighbours, ngrams, pieces, sharding, tokenfile, toxicity
from tidemark.session import shared_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, _text string"
LONG = "word " * 40_000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, further columns with clashing names."""
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "   \n", "en", "a"), (4, "Hello there world", "en", "b"), (4, "Hello there world", "en", "b"),
            (5, LONG, "fr", None), (6, LONG, None, "a"), (None, "no id here at all", "en", "a"), (7, "12345 !!!", "en", "a"), (8, "ünï çödé 日本", "de", "c")]
    return spark.createDataFrame([(*r, 0, 0.5, "x") for r in rows], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def brute_components(rows):
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    sets = []
    for _, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(lower))
        sets.append({tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both and 100 * both >= 75 * (len(sets[x]) + len(sets[y]) - both):
                parent[top(x)] = top(y)
    low = {}
    for x, (i, _) in enumerate(rows):
        low[top(x)] = min(low.get(top(x), i), i)
    return sorted((i, len(sets[x]), low[top(x)]) for x, (i, _) in enumerate(rows))


def test_ngram_join_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    base = "a b c d e f g h i j k l m n o p q r s t u v w x y z".split()
    rows += [(10_000 + i, " ".join([*base[:i], f"new{i}", *base[i + 1:]])) for i in range(26)] + [(20_000, "a b"), (20_001, "A  b"), (20_002, None)]
    got = ngrams.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == brute_components(rows)


def test_ngram_join_odd_rows(odd, none):
    got = {r.doc_id: r for r in ngrams.join(odd).collect()}
    assert got[5].component_id == got[6].component_id == 5 and got[1].n_shingles == 0 and got[4].n_shingles == 1
    assert ngrams.join(none).count() == 0


def test_pieces_equal_the_library():
    import random

    import sentencepiece

    own, lib = pieces.Pieces(public_tokenizers.path(pieces.MODEL)), sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    draw = random.Random(1)
    letters = list("abcdethosinr  \n\t12.,'-_éßñ日本ｱ▁ 😀АБ")
    for _ in range(5_000):
        text = "".join(draw.choices(letters, k=draw.randint(0, 30)))
        ids = lib.encode(text)
        assert own.encode(text) == ids and own.decode(ids) == lib.decode(ids)


def test_pieces_odd_rows(odd, none):
    got = {r.doc_id: r for r in pieces.digests(odd, public_tokenizers.path(pieces.MODEL)).collect()}
    assert got[1].n_tokens == got[2].n_tokens == 1 and got[1].ids_sha256 == hashlib.sha256(b"2").hexdigest()
    assert got[5].decoded_sha256 == hashlib.sha256(LONG.encode()).hexdigest()
    assert pieces.digests(none, public_tokenizers.path(pieces.MODEL)).count() == 0


def test_token_files_round_trip(spark, odd, none):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_tokenizers.path(tokenfile.MODEL))
    folder = f"{shared_folder(spark)}/token-test"
    files = tokenfile.write(odd, public_tokenizers.path(tokenfile.MODEL), folder)
    got = sorted(tokenfile.read(spark, folder, files).collect(), key=lambda r: r.start)
    want = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    at = 0
    for row, (i, text) in zip(got, want, strict=True):
        ids = np.array([*lib.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert tokenfile.write(none, public_tokenizers.path(tokenfile.MODEL), folder + "0") == [] and tokenfile.read(spark, folder, []).count() == 0


def test_mix_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(con.execute(mixing.SQL).fetchall()) == sorted(map(tuple, mixing.op5_mix_sources(spark, sf).collect()))


def test_mix_odd_rows(odd, none):
    got = mixing.mix(odd).collect()
    assert len(got) == 10 and all(0 <= r.taken <= 2 * r.size for r in got) and mixing.mix(none).count() == 0


def least_capacity(sizes, shards):
    low, high = max(sizes) - 1, sum(sizes)
    while high - low > 1:
        mid, used, held = (low + high) // 2, 1, 0
        for s in sizes:
            used, held = (used + 1, s) if held + s > mid else (used, held + s)
        low, high = (low, mid) if used <= shards else (mid, high)
    return high


def test_shards_are_minimax(spark, sf):
    got = sharding.op7_shard_documents(spark, sf).toPandas()
    text = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").toPandas()
    got = got.merge(text, on="doc_id")
    groups = got.groupby("text").agg(first=("doc_id", "min"), size=("size", "sum"), shards=("shard", "nunique")).sort_values("first")
    assert (groups["shards"] == 1).all() and got.groupby("shard")["size"].sum().max() == least_capacity(groups["size"].tolist(), 24)
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))


def test_shards_odd_rows(odd, none):
    assert sharding.shard(odd, 3).count() == 10 and sharding.shard(none).count() == 0


def test_language_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = language.identify(docs, language.learn(docs), keep=("doc_id", "lang")).where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)


def test_language_counts_equal_greedy_parsing():
    data = {"x": "the cat sat on the mat " * 20, "y": "le chat est sur la table " * 20}
    own = language.Parser(tuple((k, (v,)) for k, v in data.items()))
    text = language.plain("The cat, the table and a chat")

    def greedy(sample):
        n = at = 0
        while at < len(text):
            k = 1
            while at + k < len(text) and text[at:at + k + 1] in sample:
                k += 1
            n, at = n + 1, at + k
        return n
    assert own.counts([text])[0].tolist() == [greedy(language.plain(data[k])) for k in ("x", "y")]


def test_language_odd_rows(odd, none):
    got = {r.doc_id: r for r in language.identify(odd, language.learn(odd)).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[7].lang_pred == "und" and got[5].lang_pred != "und"
    assert language.identify(none, language.learn(none)).count() == 0


def test_toxicity_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    got = toxicity.op8_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted and not r.toxic for r in got) == 0 and sum(r.predicted for r in got) >= 0.4 * sum(r.toxic for r in got)


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score(odd, toxicity.learn(odd, labels)).collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got) and toxicity.score(none, toxicity.learn(none, labels)).count() == 0


def test_neighbours_recall(spark, sf):
    got = neighbours.op4_nearest(spark, sf).toPandas()
    data = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids, x = data["vec_id"].to_numpy(), np.array(data["embedding"].tolist(), dtype=np.float64)
    hit = []
    for q, part in got.groupby("query_id"):
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        hit.append(len(set(part.sort_values("rank")["vec_id"]) & set(ids[np.argsort(-score)[:20]])) / 20)
        assert part["rank"].sort_values().tolist() == list(range(1, 21))
    assert np.mean(hit) >= 0.9


def test_neighbours_odd_rows(spark):
    rows = [(i, [1.0, float(i % 3)]) for i in range(30)] + [(40, None), (60, [0.0, 0.0]), (80, [float("nan"), 1.0]), (100, [1.0]), (120, []), (None, [1.0, 1.0])]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=3).collect()
    best = sorted(((r.query_id, r["rank"], r.vec_id) for r in got))
    assert best == [(0, 1, 1), (0, 2, 2), (0, 3, 3)] or {b[0] for b in best} == {0, 20}
    assert [b[2] for b in best if b[0] == 20] == [2, 5, 8]
    assert neighbours.search(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_html_text():
    model = html_text.trained()
    page = ('<html><head><title>T</title></head><body><nav><ul><li><a href="/a">A</a></li></ul></nav><div class="ad">Buy this now.</div><article><h1>Head &amp; line</h1>'
            "<p><b>One  two\nthree four five six seven eight.<br><p>Second &lt;p&gt; of some words, and more of them here.</p></article>"
            '<section id="comments"><p>I think this is a great article, thank you.</p></section><footer>&copy; x</footer></body></html>')
    assert model.text(page) == "Head & line\nOne two three four five six seven eight.\nSecond <p> of some words, and more of them here."
    assert model.text(None) == model.text("") == "" and isinstance(model.text("<p>a<b <'"), str)


def test_pipeline_stages_take_effect(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.near_duplicates(spark, docs, sf)
    want = {c for _, _, c in brute_components([tuple(r) for r in docs.select("doc_id", "text").collect()])}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == want and kept.columns == docs.columns


def test_exact_codes_odd_rows(spark):
    from tidemark.llm import hamming

    rows = [(0, [1.0, -1.0, 1.0]), (1, [1.0, -1.0, 1.0]), (2, [1.0, 1.0, 1.0]), (3, [-1.0, 1.0, -1.0]), (4, None), (5, []), (6, [1.0]), (7, [None, 1.0, 1.0])]
    got = hamming.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=2).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 0), (0, 2, 2, 1)]
    assert hamming.search(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_code_lookup_in_groups_equals_brute_force():
    """One group of an index, looked up in small steps, against all rows."""
    import numpy as np
    import pandas as pd
    from tidemark.llm import hamming

    rng = np.random.default_rng(3)
    bits, low, radii = 8, 6, range(0, 3)
    codes = rng.integers(0, 256, (300, 3))
    data = [c.astype(">u2").tobytes() for c in codes]
    rows = pd.DataFrame({"part": codes[:, 0], "v": np.arange(300), "m": 1, "data": data})
    for g in range(4):
        own = rows[rows["part"] // 64 == g]
        asked = pd.DataFrame({"q": np.arange(40), "own": codes[:40, 0], "g": g, "data": data[:40]})
        got = hamming._lookup(own, asked, bits, low, radii, 5)
        for q in range(40):
            near = [v for v in own["v"] if bin(codes[v, 0] ^ codes[q, 0]).count("1") in radii]
            want = sorted((sum(bin(x).count("1") for x in codes[v] ^ codes[q]), v) for v in near)[:5]
            assert list(got[got["q"] == q][["d", "v"]].itertuples(index=False, name=None)) == want


def test_language_stage_rejects_unlearned_languages_and_noise(spark, sf):
    import random

    import corpus_pipeline
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    finnish = ("Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
               "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.")
    draw = random.Random(1)
    noise = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(600))
    first = docs.orderBy("doc_id").first()
    texts = [(-1, finnish), (-2, noise), (-3, "1234 5678"), (-4, first.text[:20])]
    more = spark.createDataFrame(texts, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    every = docs.unionByName(more, allowMissingColumns=True)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, every, sf).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()} | {-4}


def test_telling_words_count_wherever_they_stand_in_a_block():
    word = next(iter(html_text.SPEECH))
    for filler in (2, 200):
        own, _ = html_text.features(html_text.parse(f"<html><body><p>{'plain text here ' * filler}{word} end.</p></body></html>"))
        assert any(html_text.SPEECH[word] in f for f in own)


def test_words_that_come_again_are_kept_when_what_is_kept_is_full(monkeypatch):
    import sentencepiece

    path = public_tokenizers.path(pieces.MODEL)
    own, lib = pieces.Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
    monkeypatch.setattr(pieces, "CACHE_BYTES", 20_000)
    made, unit = [], own.unit
    monkeypatch.setattr(own, "unit", lambda u: made.append(u) or unit(u))
    for k in range(300):
        text = f"always {'x' * (k % 7)}q{k} again▁▁{k}"
        ids = lib.encode(text) + [lib.eos_id()]
        assert own.digest(text)[::2] == (len(ids), hashlib.sha256(lib.decode(ids).encode()).hexdigest())
        assert own.held <= 20_000 // 2 + 1_000 and own.encode(text) == ids[:-1]
    # Once for all digests, and each time for encode, which keeps nothing.
    assert made.count(" always") == 300 + 1
