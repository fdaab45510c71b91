"""Grouping of spelling variants by Bloom-guided neighbourhoods.

The vocabulary is counted over all documents. Every word's edits are generated and probed against blocked Bloom filters of the
vocabulary, one for each length (and part of a length) of words; only edits that a filter holds are shuffled to an exact join
with the vocabulary, which removes the false positives. Being near is mutual, so each pair is generated from one side only: a
word's deletions, and its replacements by letters that come later in code-point order; the insertions of a word are the
deletions of its neighbour.

A word's form is its most frequent near word, if that is at least `factor` times as frequent; the root is where the forms lead.
Counts at least double at each step, so chains are short; they are followed by doubling.

Bounds: a filter takes BITS bits a word and a part of a length has about SHARD_WORDS words; filters are built by tasks and are
broadcast in passes of at most PASS_BYTES, so a larger vocabulary means more passes, not a larger broadcast. Letters are those
that the vocabulary has.

Defined cases: a null or empty text has no words; repeated rows count again; an empty table gives an empty result; a word of any
length is probed whole; of near words that are equally frequent the first in code-point order is the form; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import in_chunks, table
from tidemark.llm.ngrams import LOWER, mixed
from tidemark.llm.repeats import CRC_TABLE, crc_sql
from tidemark.session import materialize

LEAST_CHARS, LEAST_COUNT, FACTOR = 5, 3, 2
#: Maximal runs that are long enough; shorter ones stay too short.
RUNS = re.compile(f"[a-zÀ-ÿ]{{{LEAST_CHARS},}}")
#: Different words that a task counts before it passes their counts on.
COUNTED = 200_000
#: Words of this length and more share filters.
LONGEST = 64
BITS, BLOCK, SHARD_WORDS, PASS_BYTES = 20, 64, 1 << 17, 32 << 20
#: Probes at once.
PROBES = 1 << 18
SEED = np.uint64(0x5E11)
LOW = np.uint64(0xFFFFFFFF)


def _masks(n: int = 4096, ones: int = 5) -> np.ndarray:
    draw = np.random.default_rng(11)
    bits = np.argsort(draw.random((n, BLOCK)), axis=1)[:, :ones].astype(np.uint64)
    return np.bitwise_or.reduce(np.uint64(1) << bits, axis=1)


MASKS = _masks()


def letter_hash(place: np.ndarray, code: np.ndarray) -> np.ndarray:
    """A random number for a letter at a place; a word's hash is the exclusive or of its letters'."""
    return mixed(((place.astype(np.uint64) << np.uint64(21)) | code.astype(np.uint64)) + SEED)


def codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), -1)


def by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        out.setdefault(len(w), []).append(k)
    return out


@dataclass
class Shards:
    """Filters of a vocabulary: for each length the first shard and the number of parts, for each shard its blocks."""

    first: np.ndarray
    parts: np.ndarray
    blocks: np.ndarray

    @classmethod
    def of(cls, counts: dict[int, int]) -> Shards:
        words = np.array([counts.get(n, 0) for n in range(LONGEST + 1)], dtype=np.int64)
        parts = -(-words // SHARD_WORDS)
        blocks = np.maximum(1, -(-words * BITS // (BLOCK * np.maximum(parts, 1))))
        return cls(np.cumsum(parts) - parts, parts, np.repeat(blocks, parts))

    def shard(self, h: np.ndarray, length: int) -> np.ndarray:
        key = min(length, LONGEST)
        parts = int(self.parts[key])
        return self.first[key] + (mixed(h ^ SEED) % np.uint64(parts)).astype(np.int64) if parts > 1 else np.full(len(h), self.first[key])

    def passes(self) -> list[list[int]]:
        """Shards whose filters are broadcast together."""
        out, size = [], PASS_BYTES + 1
        for k, n in enumerate((self.blocks * BLOCK // 8).tolist()):
            if size + n > PASS_BYTES:
                out.append([])
                size = 0
            out[-1].append(k)
            size += n
        return out


def built(h: np.ndarray, blocks: int) -> bytes:
    """The filter of words with these hashes."""
    out = np.zeros(blocks, dtype=np.uint64)
    np.bitwise_or.at(out, (((h & LOW) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64), MASKS[((h >> np.uint64(32)) & np.uint64(4095)).astype(np.int64)])
    return out.tobytes()


class Filters:
    """Some shards' filters, to be probed."""

    def __init__(self, shards: Shards, data: dict[int, bytes]):
        self.shards = shards
        self.start = np.full(len(shards.blocks), -1, dtype=np.int64)
        own = [np.frombuffer(data[k], dtype=np.uint64) for k in sorted(data)]
        self.start[sorted(data)] = np.cumsum([0, *map(len, own)])[:-1]
        self.bits = np.concatenate(own)

    def serves(self, length: int) -> bool:
        key = min(length, LONGEST)
        first, parts = self.shards.first[key], self.shards.parts[key]
        return bool((self.start[first:first + parts] >= 0).any())

    def hits(self, h: np.ndarray, length: int) -> np.ndarray:
        """Places of h that may be words of this length, in the shards at hand."""
        shard = self.shards.shard(h, length)
        own = np.flatnonzero(self.start[shard] >= 0)
        h, shard = h[own], shard[own]
        block = self.start[shard] + (((h & LOW) * self.shards.blocks[shard].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        mask = MASKS[((h >> np.uint64(32)) & np.uint64(4095)).astype(np.int64)]
        return own[(self.bits[block] & mask) == mask]


def neighbours(words: list[str], filters: Filters, alphabet: np.ndarray, least: int = LEAST_CHARS) -> Iterator[tuple[int, str]]:
    """(place, edit) of the deletions and later replacements of words that a filter holds."""
    for length, rows in by_length(words).items():
        shorter, same = length - 1 >= least and filters.serves(length - 1), filters.serves(length)
        if not shorter and not same:
            continue
        step = max(1, PROBES // max(len(alphabet), length))
        for at in range(0, len(rows), step):
            part = rows[at:at + step]
            own = codes([words[k] for k in part])
            places = np.arange(length)
            here = letter_hash(places, own)
            if shorter:
                left = np.bitwise_xor.accumulate(here, axis=1) ^ here
                moved = letter_hash(np.maximum(places - 1, 0), own)
                right = np.bitwise_xor.accumulate(moved[:, ::-1], axis=1)[:, ::-1] ^ moved
                new = np.ones(own.shape, dtype=bool)
                new[:, 1:] = own[:, 1:] != own[:, :-1]  # of equal neighbours one deletion is enough
                row, i = np.nonzero(new)
                hit = filters.hits((left ^ right)[row, i], length - 1)
                for r, k in zip(row[hit].tolist(), i[hit].tolist()):
                    w = words[part[r]]
                    yield part[r], w[:k] + w[k + 1:]
            if same:
                whole = np.bitwise_xor.reduce(here, axis=1)
                for k in range(length):
                    row, c = np.nonzero(alphabet[None, :] > own[:, k, None])
                    other = letter_hash(np.full(len(alphabet), k), alphabet)
                    hit = filters.hits((whole ^ here[:, k])[row] ^ other[c], length)
                    for r, letter in zip(row[hit].tolist(), alphabet[c[hit]].tolist()):
                        w = words[part[r]]
                        yield part[r], w[:k] + chr(letter) + w[k + 1:]


def count_words(docs: DataFrame, spoil: Callable[[object, str], str] | None = None) -> DataFrame:
    """(word, n): lower-cased (A-Z) runs of letters of all texts that are long and frequent enough. `spoil` may rewrite a
    document's word, given its id."""
    data = docs.select("doc_id", docs["text"].alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in in_chunks(batches, "_text"):
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("_text").to_pylist()):
                if not text:
                    continue
                found = Counter(RUNS.findall(text.encode("utf-8", "replace").translate(LOWER).decode()))
                if spoil:
                    for w, n in found.items():
                        w = spoil(i, w)
                        if len(w) >= LEAST_CHARS:
                            held[w] += n
                else:
                    held.update(found)
                if len(held) >= COUNTED:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return data.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): every pair of near words once, from stored distinct words (word, n)."""
    spark = words.sparkSession
    key = F.least(F.char_length("word"), F.lit(LONGEST))
    counts = {r["k"]: r["n"] for r in words.groupBy(key.alias("k")).agg(F.count("*").alias("n")).collect()}  # at most LONGEST rows
    shards = Shards.of(counts)
    letters = words.select(F.explode(F.split("word", "")).alias("c")).distinct().collect()  # the alphabet
    alphabet = np.array(sorted(ord(r["c"]) for r in letters if r["c"]), dtype=np.uint32)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("word").to_pylist()
            for length, rows in by_length(own).items():
                h = np.bitwise_xor.reduce(letter_hash(np.arange(length), codes([own[k] for k in rows])), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(shards.shard(h, length).astype(np.int32)), pa.array(h.view(np.int64))], ["shard", "h"])

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        k = key[0].as_py()
        h = rows.column("h").to_numpy().view(np.uint64)
        return pa.table({"shard": pa.array([k], pa.int32()), "filter": pa.array([built(h, int(shards.blocks[k]))], pa.binary())})

    made = materialize(words.select("word").mapInArrow(dealt, "shard int, h long").groupBy("shard").applyInArrow(build, "shard int, filter binary"), "spelling-filters")

    def probed(own: list[int]) -> DataFrame:
        data = {r["shard"]: bytes(r["filter"]) for r in made.where(F.col("shard").between(own[0], own[-1])).collect()}  # at most PASS_BYTES
        filters = spark.sparkContext.broadcast(data)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at_hand = Filters(shards, filters.value)
            for batch in batches:
                for part in (batch.slice(a, 8_192) for a in range(0, len(batch), 8_192)):
                    found = list(neighbours(part.column("word").to_pylist(), at_hand, alphabet))
                    rows = part.take(pa.array([k for k, _ in found], pa.int64()))
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([w for _, w in found], pa.string())], ["word", "n", "other"])

        return words.select("word", "n").mapInArrow(run, "word string, n long, other string")

    none = spark.createDataFrame([], "word string, n long, other string")
    for own in shards.passes():
        none = none.unionByName(probed(own))
    return none.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other").select("word", "n", "other", "other_n")


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of every word with a form (word, form), by doubling; the written table of a round is the next one's input."""
    at = materialize(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        now = at.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        now = materialize(now, "spelling-roots")
        at = now.drop("_moved")
        if not now.where("_moved").limit(1).count():
            return at


def group(docs: DataFrame, spoil: Callable[[object, str], str] | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of docs(doc_id, text)."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = materialize(count_words(docs, spoil).repartition(parts, "word"), "spelling-words")
    pairs = materialize(near_pairs(words), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(
        F.first("n").alias("_n"), F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("_best"))
    best = best.withColumn("_kept", -F.col("_best.n") >= FACTOR * F.col("_n")).select(
        "word", "n_near", F.when(F.col("_kept"), F.col("_best.word")).alias("form"), F.when(F.col("_kept"), -F.col("_best.n")).alias("form_n"))
    best = materialize(best, "spelling-forms")
    found = words.join(best, "word", "left").join(roots(best.where("form IS NOT NULL")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def spoiled(doc_id: int | None, word: str) -> str:
    """The word without one letter, where the crc32 of document and word says so."""
    if doc_id is None:
        return word
    h = crc32(f"{doc_id}:{word}".encode())
    if h % 97:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(table(spark, sf_dir, "documents"), spoiled)


LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all({LOWER_SQL.format("text")}, '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
own AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
hashed AS (SELECT run, n, {crc_sql("doc_id || ':' || run")} AS h FROM own, crc_tab WHERE length(run) >= 5),
spoiled AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n
  FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spoiled WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word)))::INT AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, n, count(*) AS n_near, list({{'form': other, 'form_n': other_n}} ORDER BY other_n DESC, encode(other))[1] AS top FROM near GROUP BY word, n),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top.form_n >= 2 * w.n THEN top.form END AS form,
         CASE WHEN top.form_n >= 2 * w.n THEN top.form_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
walk AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON walk.at = forms.word WHERE forms.form IS NOT NULL),
ends AS (SELECT walk.word, walk.at AS root FROM walk JOIN forms ON walk.at = forms.word WHERE forms.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN ends e ON f.word = e.word
"""
