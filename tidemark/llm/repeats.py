"""Periodic runs of words by an online sparse diagonal DP.

A run of period q is a stretch of words in which words q apart are equal: a diagonal of matches at lag q in the text's
comparison with itself. For each word the DP looks at the word's earlier occurrences; each of them belongs to one lag's
diagonal, whose match length grows while words lag apart stay equal. A diagonal that ends with sufficient length is a run.

The DP is sparse in three ways, none of which loses a run:
* A run of lag p has at least max(12 - p, p) matches in a row. So the occurrences that count are those of the word with the
  words after it: g words, g being 6 for lags 1 to 7, and 8, 16, 32, ... for the lags from g to 2g - 1.
* A diagonal is opened at its first match only, where the words before differ, and is then followed word by word.
* Where g words have a period of at most g / 4, all their places within that stretch but the first are inner ones. Of a
  diagonal's first two places one is never inner: were both, the words before them would be equal too. So pairs of inner places
  are left out, and so are those of a stretch with itself at longer lags, which give the same stretch again. Then a place has a
  bounded number of partners for each g; one word repeated n times takes about n steps.
A stretch found at several lags is a run of the smallest.

Defined cases: a null text has no words, no runs and collapses to an empty text, like an empty one; repeated rows are separate
documents; an empty table gives an empty result; a text is held whole by one task, with about 100 bytes a word; further columns
are ignored unless `keep` names them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import in_chunks, table
from tidemark.llm.ngrams import mixed

#: Least length of a run in words, and in periods.
LEAST_WORDS, LEAST_PERIODS = 12, 2
#: Bytes of text that are searched together.
STEP_BYTES = 4 << 20
FACTOR = np.uint64(0xD1342543DE82EF95)
NO_PLACES = np.zeros(0, dtype=np.int64)


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All k with low[r] <= k < high[r], as (r, k)."""
    size = np.maximum(high - low, 0)
    row = np.repeat(np.arange(len(low)), size)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + low[row]


def _again(key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, place) of the places whose key comes again, in order of group and place."""
    order = np.argsort(key, kind="stable")
    key, place = key[order], place[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    group = np.cumsum(new) - 1
    several = np.bincount(group)[group] > 1 if len(group) else new
    return group[several], place[several]


def _first_matches(ids: np.ndarray, group: np.ndarray, place: np.ndarray, g: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a diagonal of a lag from least to most opens with g equal words, and the lags; not those which the last
    word of a sufficient length already ends."""
    span = len(ids) + 2 * most
    at = group * span + place
    inner = np.zeros(len(at), dtype=bool)
    inner[1:] = np.diff(at) <= g // 4
    outer = np.flatnonzero(~inner)
    row, k = _ranges(np.searchsorted(at, at[outer] - most), np.searchsorted(at, at[outer] - least, side="right"))
    later, earlier = [place[outer[row]]], [place[k]]
    row, k = _ranges(np.searchsorted(at, at[outer] + least), np.searchsorted(at, at[outer] + most, side="right"))
    stretch = np.cumsum(~inner)
    new = inner[k] & ((stretch[k] > stretch[outer[row]]) | (at[k] - at[outer[row]] <= g // 4))
    row, k = row[new], k[new]
    later.append(place[k])
    earlier.append(place[outer[row]])
    i, j = np.concatenate(later), np.concatenate(earlier)
    lag = i - j
    last = np.minimum(i + np.maximum(LEAST_WORDS - lag, lag) - 1, len(ids) - 1)
    first = (ids[i - 1] != ids[j - 1]) & (ids[last] == ids[last - lag])
    return i[first], lag[first]


def _followed(ids: np.ndarray, at: np.ndarray, lag: np.ndarray) -> np.ndarray:
    """The first place from `at` on whose word differs from the one `lag` before it."""
    at, going, step, last = at.copy(), np.arange(len(at)), 16, len(ids) - 1
    while len(going):
        places = np.minimum(at[going, None] + np.arange(step), last)
        differ = ids[places] != ids[places - lag[going, None]]
        ended = differ.any(axis=1)
        at[going] += np.where(ended, differ.argmax(axis=1), step)
        going = going[~ended]
        step = max(16, min(2 * step, (1 << 20) // max(1, len(going))))
    return at


def find_runs(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of every run of texts given as arrays of word numbers from 0, in that order."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    # A number of its own stands before each text and behind the last, so that no match leaves a text.
    starts = np.cumsum(sizes + 1) - sizes
    ids = -np.arange(1, sizes.sum() + len(texts) + 2, dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    places = np.arange(len(owner)) + owner + 1
    ids[places] = np.concatenate([*texts, NO_PLACES])

    one = mixed(ids.astype(np.uint64) + np.repeat(mixed(np.arange(len(texts) + 1, dtype=np.uint64)), np.append(sizes + 1, 1)))

    def longer(a: np.ndarray, b: np.ndarray, by: int) -> np.ndarray:
        """Hashes of the words of a and of those of b that begin `by` places later; what would pass the end matches nothing."""
        out = one.copy()
        if by < len(a):
            out[:-by] = mixed(a[:-by] * FACTOR + b[by:])
        return out

    two = longer(one, one, 1)
    four = longer(two, two, 2)
    found = []
    g, least, most, hashes = 6, 1, 7, longer(four, two, 4)
    longest = int(sizes.max(initial=0))
    place = places
    while 2 * least <= longest and len(place):
        group, again = _again(hashes[place], place)
        i, lag = _first_matches(ids, group, again, g, least, most)
        for a in range(0, len(i), 1 << 16):
            own, p = i[a:a + (1 << 16)], lag[a:a + (1 << 16)]
            end = _followed(ids, own + g, p)
            enough = end - own + p >= np.maximum(LEAST_WORDS, LEAST_PERIODS * p)
            found.append((own[enough] - p[enough], (end - own + p)[enough], p[enough]))
        place = np.sort(again)
        if g == 6:
            hashes = longer(four, four, 4)
        else:
            wider = hashes.copy()
            inside = place[place + g < len(hashes)]
            wider[inside] = mixed(hashes[inside] * FACTOR + hashes[inside + g])
            hashes = wider
        g, least = (8, 8) if g == 6 else (2 * g, 2 * g)
        most = 2 * least - 1
    start, length, period = (np.concatenate([NO_PLACES, *x]) for x in (zip(*found) if found else ((), (), ())))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    text = np.searchsorted(starts, start, side="right") - 1
    return text, start - starts[text], length, period


def collapsed(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words that no run holds after its first period."""
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.subtract.at(change, start + length, 1)
    return b" ".join(words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist())


RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), arrange: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """The kept columns of every row of docs(text) with runs, by start and period, and collapsed, the text without repeats.

    `arrange` may rewrite the words of a text (UTF-8), given the first kept column, before they are searched.
    """
    data = docs.select(*keep, docs["text"].alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "_text", STEP_BYTES):
            number = defaultdict(count().__next__)
            words = [t.encode("utf-8", "replace").split() if t else [] for t in batch.column("_text").to_pylist()]
            if arrange:
                words = [arrange(i, w) for i, w in zip(batch.column(keep[0]).to_pylist(), words)]
            texts = [np.fromiter(map(number.__getitem__, w), dtype=np.int64, count=len(w)) for w in words]
            text, start, length, period = find_runs(texts)
            bounds = np.searchsorted(text, np.arange(len(words) + 1))
            out = []
            for w, a, b in zip(words, bounds[:-1].tolist(), bounds[1:].tolist()):
                out.append(collapsed(w, start[a:b], length[a:b], period[a:b]) if b > a else b" ".join(w))
            runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs),
                 pa.array(out, pa.binary()).cast(pa.string())], [*keep, "runs", "collapsed"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in data.schema.fields[:-1]]
    return data.mapInArrow(run, ", ".join([*fields, f"runs {RUN}, collapsed string"]))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a repeated passage in every tenth document by the crc32 of its id."""
    h, n = crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats(table(spark, sf_dir, "documents"), arrange=planted)
    # Greatest length; of equal ones the smallest start, then period.
    found = found.withColumn("_top", F.array_max(F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period))))
    top = [F.col("_top").getField(c) for c in ("length", "col2", "col3")]
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-top[1]).alias("start"), top[0].alias("length"), (-top[2]).alias("period"),
        F.expr("(1000 * _top.length) div -_top.col3").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


#: Unsigned crc32 of a text's UTF-8 bytes in SQL: `{tab}` are the 256 remainders, made from the polynomial bit by bit.
CRC_TABLE = """
crc_one AS (
  SELECT b, CAST(list_reduce(list_concat([CAST(b AS BIGINT)], range(8)),
                 lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS BIGINT) AS v
  FROM range(256) t(b)),
crc_tab AS (SELECT list(v ORDER BY b) AS tab FROM crc_one)"""


def crc_sql(text: str) -> str:
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(octet_length(encode({text}))),
      lambda i: CAST(('0x' || hex(encode({text}))[2 * i + 1:2 * i + 2]) AS BIGINT))),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255::BIGINT) + 1])), 4294967295::BIGINT)"""


SQL = rf"""
WITH {CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS own, {crc_sql("CAST(doc_id AS VARCHAR)")} AS h
  FROM documents, crc_tab),
a AS (SELECT *, len(own) AS n, CASE WHEN len(own) > 0 THEN (h // 10) % len(own) END AS a FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM a),
w AS (
  SELECT r, doc_id, unnest(range(n)) AS i, unnest(list_transform(range(n), lambda i: own[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END])) AS w
  FROM p),
m AS (SELECT y.r, y.i, y.i - x.i AS lag FROM w x JOIN w y ON x.r = y.r AND x.w = y.w AND x.i < y.i),
k AS (SELECT *, i - row_number() OVER (PARTITION BY r, lag ORDER BY i) AS island FROM m),
s AS (SELECT r, lag, min(i) - lag AS start, count(*) + lag AS length FROM k GROUP BY r, lag, island HAVING count(*) + lag >= greatest(12, 2 * lag)),
runs AS (SELECT r, start, length, min(lag) AS period FROM s GROUP BY r, start, length),
per AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs,
         list({{'start': start, 'length': length, 'period': period}} ORDER BY length DESC, start, period)[1] AS top
  FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT w.r, string_agg(w, ' ' ORDER BY w.i) AS text FROM w LEFT JOIN gone ON w.r = gone.r AND w.i = gone.i WHERE gone.i IS NULL GROUP BY w.r)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, top.start AS start, top.length AS length, top.period AS period, 1000 * top.length // top.period AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN per ON d.r = per.r LEFT JOIN kept ON d.r = kept.r
"""
