"""Language identification by cross-parsing entropy.

Per language a suffix automaton is built over a bounded sample of labelled text. A text is parsed greedily against each:
the longest match that the automaton follows is one phrase, then the next begins. The language with the fewest phrases
per byte wins. Texts are parsed as UTF-8 in lower case with everything of ASCII but letters as one space, in windows of
WINDOW bytes, each of which begins a new phrase; so all windows of a batch step through one transition table at a time.

Bound of the sample: PIECES pieces of WINDOW characters of each language, from the documents with the smallest hashes, each
at a hashed offset. Everything is learned from documents outside fold 0 only.

Defined cases: a null text, or one without a letter, is `und` with score 0, as is every text if nothing is labelled;
equal counts go to the smaller language name; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, in_chunks, release, resident, shape, table

WINDOW = 512
PIECES = 64
SPACED = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
#: Windows that step together.
TOGETHER = 1 << 14


def plain(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "replace").translate(SPACED).split())


def automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of data; state 0 is the start."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in data:
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return go


class Parser:
    """Phrase counts of texts against the sample of each language."""

    def __init__(self, sample: tuple[tuple[str, tuple[str, ...]], ...]):
        self.langs = [lang for lang, _ in sample]
        data = {lang: b" ".join(filter(None, map(plain, pieces))) for lang, pieces in sample}
        seen = sorted(set(b"".join(data.values())))
        # Class 0 pads, class 1 is a byte that no sample has.
        self.classes = np.ones(256, dtype=np.uint8 if len(seen) < 254 else np.uint16)
        self.classes[0] = 0
        for i, c in enumerate(seen):
            self.classes[c] = i + 2
        self.width = len(seen) + 2
        self.tables = [self._table(automaton(data[lang])) for lang in self.langs]

    def _table(self, go: list[dict[int, int]]) -> np.ndarray:
        """For a state and a class: (next state * width) * 4 + phrases that end there."""
        width, column = self.width, self.classes
        start = np.full(width, 2, dtype=np.int32)  # a byte without a match is a phrase of its own
        start[0] = 0
        for c, to in go[0].items():
            start[column[c]] = to * width * 4 + 1
        out = np.empty((len(go), width), dtype=np.int32)
        out[:] = start
        out[0] = np.where(start & 3 == 2, 1, start & ~3)
        out[:, 0] = np.arange(len(go), dtype=np.int32) * width * 4  # padding changes nothing
        for state, nexts in enumerate(go):
            for c, to in nexts.items():
                out[state, column[c]] = to * width * 4
        return out.ravel()

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each non-empty text (rows) by language (columns)."""
        windows = [-(-len(t) // WINDOW) for t in texts]
        firsts = np.concatenate([[0], np.cumsum(windows)[:-1]]).astype(np.int64)
        data = np.frombuffer(b"".join(t.ljust(n * WINDOW, b"\0") for t, n in zip(texts, windows)), dtype=np.uint8)
        data = self.classes[data].reshape(-1, WINDOW)
        found = np.zeros((len(data), len(self.langs)), dtype=np.int32)
        for a in range(0, len(data), TOGETHER):
            steps = np.ascontiguousarray(data[a:a + TOGETHER].T)
            for k, step_to in enumerate(self.tables):
                at, ends = np.zeros(steps.shape[1], dtype=np.int32), np.zeros(steps.shape[1], dtype=np.int32)
                place, value, part = np.empty_like(at), np.empty_like(at), np.empty_like(at)
                for row in steps:
                    np.add(at, row, out=place)
                    np.take(step_to, place, out=value, mode="clip")
                    np.bitwise_and(value, 3, out=part)
                    np.add(ends, part, out=ends)
                    np.right_shift(value, 2, out=at)
                found[a:a + TOGETHER, k] = ends + (at != 0)
        return np.add.reduceat(found, firsts, axis=0)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, its share of the inverse counts, and its phrases per byte."""
        langs, scores, rates = ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        known = [(i, p) for i, t in enumerate(texts) if t and any(map(str.isalpha, t)) and (p := plain(t))] if self.langs else []
        if known:
            counts = self.counts([p for _, p in known])
            best = counts.argmin(axis=1)
            top = counts[np.arange(len(best)), best]
            share = (1.0 / top) / (1.0 / counts).sum(axis=1)
            for (i, p), k, s, n in zip(known, best.tolist(), share.tolist(), top.tolist()):
                langs[i], scores[i], rates[i] = self.langs[k], s, n / len(p)
        return langs, scores, rates


def learn(docs: DataFrame, pieces: int = PIECES) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """The labelled sample: `pieces` short pieces of each language, whatever the input."""
    size = F.char_length("text")
    at = F.pmod(F.xxhash64("doc_id", F.lit("offset")), F.greatest(size - WINDOW + 1, F.lit(1))).cast("int") + 1
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (size > 0)).select(
        "lang", F.xxhash64("doc_id").alias("_h"), F.substring(F.col("text"), at, F.lit(WINDOW)).alias("_piece"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("_h", "_piece"))
    got: dict[str, list[tuple[int, str]]] = {}
    for lang, h, piece in rows.withColumn("_n", first).where(F.col("_n") <= pieces).select("lang", "_h", "_piece").collect():
        got.setdefault(lang, []).append((h, piece))
    return tuple((lang, tuple(p for _, p in sorted(got[lang]))) for lang in sorted(got))


def identify(docs: DataFrame, sample: tuple, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns of every row of docs with held_out, lang_pred, score and phrase_rate (phrases per byte)."""
    data = docs.select(*keep, F.col("text").alias("_text"), held_out(F.col("doc_id")).alias("_held"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = resident(("languages", sample), lambda: Parser(sample))
        try:
            for batch in in_chunks(batches, "_text"):
                langs, scores, rates = own.predict(batch.column("_text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), batch.column("_held"), pa.array(langs, pa.string()),
                     pa.array(scores, pa.float64()), pa.array(rates, pa.float64())],
                    [*keep, "held_out", "lang_pred", "score", "phrase_rate"])
        finally:
            release()

    return data.mapInArrow(run, shape(data.schema.fields[:-2], "held_out boolean, lang_pred string, score double, phrase_rate double"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs))
