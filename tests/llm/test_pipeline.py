"""The pipeline against plain Python stages that feed each other, and each stage on odd rows."""

import hashlib
import math
import random
import re
import zlib

import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidemark.llm import language, mixing, pieces, toxicity
from tests.llm.test_llm import brute_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def greedy(data, sample):
    """Phrases of a text by longest matches, beginning anew every WINDOW bytes."""
    count = 0
    for a in range(0, len(data), language.WINDOW):
        part, at = data[a:a + language.WINDOW], 0
        while at < len(part):
            size = 1
            while at + size < len(part) and part[at:at + size + 1] in sample:
                size += 1
            count, at = count + 1, at + size
    return count


def plain_language(spark, rows):
    docs = spark.createDataFrame(rows, SHAPE)
    sample = {k: b" ".join(filter(None, map(language.plain, v))) for k, v in language.learn(docs.where(~corpus_pipeline.usual(docs)))}
    seen = []
    for r in rows:
        data = language.plain(r[1]) if r[1] else b""
        if any(map(str.isalpha, r[1] or "")):
            count, lang = min((greedy(data, s), k) for k, s in sample.items())
            seen.append((r, lang, count / len(data), len(r[1].encode())))
    usual = [(rate, n) for r, lang, rate, n in seen if crc(r[0]) % 5 == 1 and r[2] == lang]
    mean = sum(rate * n for rate, n in usual) / sum(n for _, n in usual)
    spread = math.sqrt(sum((rate - mean) ** 2 * n for rate, n in usual) / len(usual))
    return [r for r, _, rate, n in seen if rate < min(1.0, corpus_pipeline.RATE * mean + corpus_pipeline.DEVIATIONS * spread / math.sqrt(n))]


def plain_toxicity(spark, rows, labels):
    model = toxicity.learn(spark.createDataFrame(rows, SHAPE), labels)
    kept = []
    for r in rows:
        own = {f for w in re.findall(r"[^\W\d_]+", r[1].lower()) for f in (w, *(f"{w[:n]}~" for n in (4, 5) if len(w) > n))}
        z = model.bias + sum(model.weight.get(f, 0.0) for f in own) + sum(w for w, p in zip(model.pattern, toxicity.PATTERNS) if p.search(r[1]))
        if z < 0:
            kept.append(r)
    return kept


def plain_mix(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in rows]
    total = {}
    for r, n in zip(rows, size):
        total[r[3]] = total.get(r[3], 0) + n
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(total))}
    target, free, left = {}, set(total), 1.5 * sum(size)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level >= 2 * total[s]}
        for s in over or free:
            target[s] = 2.0 * total[s] if over else weight[s] * level
            left -= target[s]
        free -= over or free
    out = []
    for source in total:
        own = sorted((hashlib.md5(f"mix-1:{r[0]}".encode()).hexdigest(), r[0], n, r) for r, n in zip(rows, size) if r[3] == source)
        whole = int(target[source] // total[source])
        need, before = target[source] - whole * total[source], 0
        for _, _, n, r in own:
            out += [r] * (whole + (need > 0 and before + n / 2 <= need))
            before += n
    return out


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    folder, draw = str(tmp_path_factory.mktemp("pipeline")), random.Random(4)
    base = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{base}/documents.parquet").where("doc_id < 160 AND length(text) < 4000").select(*COLUMNS)
    rows = [tuple(r) for r in docs.orderBy("doc_id").collect()]
    long = [r for r in rows if len(r[1].split()) > 60]
    add = [("noise", "".join(draw.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(500))), ("none", "12 34 !!"), ("copy", long[0][1]),
           ("near", " ".join([*long[1][1].split(), "tail"])), ("toxic", long[2][1] + " you worthless idiot, you moron, shut up idiot")]
    rows += [(1_000 + k, text, None, "src1", len(text)) for k, (_, text) in enumerate(add)]
    insults = "worthless idiot", "you moron", "pathetic idiot", "moron and idiot"
    toxic = [(2_000 + k, f"{long[k % 9][1][:300 + k]} {insults[k % 4]} {insults[k % 3]}", "en", "src2", 0) for k in range(40)]
    rows += toxic
    spark.createDataFrame(rows, SHAPE).write.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{base}/labels.parquet").select("doc_id", "toxic")
    labels.unionByName(spark.createDataFrame([(r[0], 1) for r in toxic], labels.schema)).write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def test_pipeline_equals_plain_stages(spark, planted):
    folder, rows = planted
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    known = plain_language(spark, rows)
    assert {r[0] for r in rows} - {r[0] for r in known} >= {1_000, 1_001} and len(known) >= len(rows) - 4
    clean = plain_toxicity(spark, known, labels)
    assert 1_004 not in {r[0] for r in clean} and len(clean) < len(known)
    first = {c for _, _, c in brute_components([r[:2] for r in clean])}
    distinct = [r for r in clean if r[0] in first]
    assert not {1_002, 1_003} & {r[0] for r in distinct}
    mixed = plain_mix(distinct)
    assert len(mixed) != len(distinct)
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    want = []
    for r in mixed:
        ids = [*lib.encode(r[1]), lib.eos_id()]
        want.append((r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    got = corpus_pipeline.run(spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, got.collect())) == sorted(want)


CLASHING = ["_id", "_text", "_times", "_n", "_held", "score", "held_out", "predicted", "lang_pred", "phrase_rate", "bound", "kept", "id", "taken",
            "times", "doc", "a.b"]
ODD = [(1, None, None, None), (2, "", "en", "a"), (3, "   \n", "en", "a"), (4, "Hello there world", "en", "b"), (4, "Hello there world", "en", "b"),
       (5, "word " * 40_000, "fr", None), (None, "no id here at all", "en", "a"), (7, "12345 !!!", "en", "a"), (8, "ünï çödé 日本", "de", "c")]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_clashing_columns(spark, planted, name):
    stage, folder = dict(corpus_pipeline.STAGES)[name], planted[0]
    odd = spark.createDataFrame([(*r, len(r[1] or "")) for r in ODD], SHAPE)
    plain = stage(spark, odd, folder)
    more = odd.withColumns({c: F.lit(f"own {c}") for c in CLASHING})
    got = stage(spark, more, folder)
    last = name == corpus_pipeline.STAGES[-1][0]
    if not last:
        assert got.columns == more.columns and got.dtypes == more.dtypes
        assert all(tuple(row)[5:] == tuple(f"own {c}" for c in CLASHING) for row in got.collect())
    key = [F.coalesce(F.col("doc_id"), F.lit(-1)), *([F.sha2("text", 256)] if not last else [])]
    assert sorted(map(tuple, got.select(*key).collect()), key=str) == sorted(map(tuple, plain.select(*key).collect()), key=str)
    assert stage(spark, odd.limit(0), folder).count() == 0


def test_empty_texts_do_not_stop_the_language_stage(spark, planted):
    folder, rows = planted
    docs = spark.createDataFrame(rows, SHAPE)
    kept = sorted(r.doc_id for r in corpus_pipeline.language_id(spark, docs, folder).collect())
    empty = [(-k, "", lang, "a", 0) for k, lang in enumerate(("en", None, "und", "und", "und", "und", "und", "und"), 1)]
    more = docs.unionByName(spark.createDataFrame(empty, SHAPE))
    assert sorted(r.doc_id for r in corpus_pipeline.language_id(spark, more, folder).collect()) == kept
    # Of labelled texts that add up to no bytes there is no usual rate.
    only = spark.createDataFrame([*empty, (9, "Hello there world", "en", "a", 17)], SHAPE)
    assert {r.doc_id for r in corpus_pipeline.language_id(spark, only, folder).collect()} <= {9}


def test_empty_documents_of_a_capped_source_are_not_taken_more_often_than_allowed(spark):
    rows = [(i, "" if i % 2 else "one two three", "en", "capped") for i in range(20)] + [(100 + i, "w " * 500, "en", f"x{i}") for i in range(3)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert all(r.times <= 2 for r in got)


@pytest.mark.parametrize("stage", ["mix_sources", "near_duplicates"])
def test_texts_stay_where_they_are(spark, sf, stage):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are not tiny
    try:
        plan = getattr(corpus_pipeline, stage)(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)._jdf.queryExecution().simpleString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan
