"""Isolation forest per ticker, for series of any length.

Every tree is grown from the 256 rows of the whole series that have the
smallest hashes of (seed, tree, row); means and deviations are of all rows. So
the forest of a series does not depend on how its rows are dealt out. Rows that
may be among the 256 of some tree are the pool of their series, of bounded
size. A forest is grown once per series: with the rows of a short series, or
from the pool of a long one, whose pieces then get the finished trees. A task
never holds more than one pool or piece and one forest.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.series import FEATURES, full_windows
from tidemark.session import materialize

# Rows per tree, share of anomalies, seed, Euler's constant of the path-length norm.
SAMPLE = 256
CONTAMINATION = 0.05
SEED = 42
EULER = 0.5772156649
# Fixed values end.

PIECE = 200_000
# Rows of a series that a tree's hashes are expected to let into the pool; that fewer than SAMPLE come has odds below 1e-11.
DRAWN = 400
GOLDEN = 0x9E3779B97F4A7C15
BLOCK = 5_000
# Hashes of rows and trees in one work array.
HASHED = 500_000
# Rows that a task grows forests from and scores.
SCORED_ROWS = 100_000
DIGITS = 6


def _path_norm(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a tree of n rows."""
    n = np.asarray(n, dtype=float)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    out[big] = 2 * (np.log(n[big] - 1) + EULER) - 2 * (n[big] - 1) / n[big]
    return out


def _tree_hash(row_hash: np.ndarray, seed: int, tree: int | np.ndarray) -> np.ndarray:
    """Hash of (seed, tree, row) from the hash of the row; of several trees, (tree, row)."""
    start = np.array([(seed * 1_000_003 + int(k) + 1) * GOLDEN % (1 << 64) for k in np.ravel(tree)], dtype=np.uint64).reshape(np.shape(tree))
    x = start[..., None] + row_hash.astype(np.int64).view(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _in_pool(row_hash: np.ndarray, n: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """Whether some tree of a series of n rows may draw the row."""
    share = np.minimum(DRAWN / n, 1.0)
    limit = np.where(share < 1.0, share * 2.0 ** 64, 0.0).astype(np.uint64)
    found = share == 1.0
    for tree in range(trees):
        found |= _tree_hash(row_hash, seed, tree) < limit
    return found


def _samples(pool: np.ndarray, row_hash: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """The rows each tree is grown from, (tree, row, column)."""
    size, out, step = min(SAMPLE, len(pool)), [], max(1, HASHED // max(1, len(pool)))
    for start in range(0, trees, step):  # several trees at once, as many as work arrays allow
        own = _tree_hash(row_hash, seed, np.arange(start, min(trees, start + step)))
        out.append(np.argpartition(own, size - 1, axis=1)[:, :size])
    return pool[np.concatenate(out)]


@dataclass
class Forest:
    """Random trees as flat arrays (tree, node); the children of node i are 2i + 1 and 2i + 2. `length` is a leaf's path length."""

    column: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    length: np.ndarray
    sample: int

    @classmethod
    def grown(cls, sample: np.ndarray, rng: np.random.Generator) -> Forest:
        """From samples (tree, row, column). All trees grow one level at a time; a node is split at a random value between the
        extremes of a random column over its rows."""
        trees, size, columns = sample.shape
        depth = int(np.ceil(np.log2(max(size, 2))))
        every = 2 ** (depth + 1) - 1
        out = cls(np.zeros((trees, every), dtype=np.int64), np.zeros((trees, every)), np.ones((trees, every), dtype=bool), np.zeros((trees, every)), size)
        values = np.ascontiguousarray(sample.transpose(0, 2, 1)).ravel()  # (tree, column, row)
        norms = _path_norm(np.arange(size + 1))
        place = (np.arange(trees)[:, None] * columns * size + np.arange(size)).ravel()  # of column 0
        flat = np.repeat(np.arange(trees), size)  # the node of each row, in its level
        for level in range(depth + 1):
            nodes, first = 2 ** level, 2 ** level - 1
            at = slice(first, first + nodes)
            count = np.bincount(flat, minlength=trees * nodes)
            out.length[:, at] = (level + norms.take(count)).reshape(trees, nodes)
            if level == depth:
                break
            column = rng.integers(0, columns, trees * nodes)
            value = values.take((column * size).take(flat) + place)
            low, high = np.full(trees * nodes, np.inf), np.full(trees * nodes, -np.inf)
            np.minimum.at(low, flat, value)
            np.maximum.at(high, flat, value)
            inner = (count > 1) & (high > low)
            share = rng.random(trees * nodes)
            some = np.flatnonzero(inner)
            cut = np.zeros(trees * nodes)
            cut[some] = low[some] + share[some] * (high[some] - low[some])
            for array, own in ((out.column, column), (out.cut, cut), (out.leaf, ~inner)):
                array[:, at] = own.reshape(trees, nodes)
            right = value > cut.take(flat)
            kept = np.flatnonzero(inner.take(flat))
            place, flat = place.take(kept), (2 * flat + right).take(kept)
        return out

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1) of each row, near 1 where it is easy to isolate."""
        trees, every = self.column.shape
        depth, path = (every + 1).bit_length() - 2, np.empty(len(rows))
        # Leaves are their own next node, so all rows take as many steps; with a cut that no value is above.
        node = np.arange(trees)[:, None] * every + np.arange(every)
        following = np.where(self.leaf, node, node + np.arange(every) + 1).ravel()
        cut, column, length = np.where(self.leaf, np.inf, self.cut).ravel(), self.column.ravel(), self.length.ravel()
        for start in range(0, len(rows), BLOCK):  # blocks bound the tree x row work arrays
            block = rows[start:start + BLOCK]
            values, n = np.ascontiguousarray(block.T).ravel(), len(block)
            first = column * n
            row, at = np.tile(np.arange(n), trees), np.repeat(np.arange(trees) * every, n)
            for _ in range(depth):
                value = values.take(first.take(at) + row)
                at = following.take(at) + (value > cut.take(at))
            path[start:start + BLOCK] = length.take(at).reshape(trees, n).sum(axis=0) / trees
        norm = max(float(_path_norm(np.array([self.sample]))[0]), 1e-9)
        return np.round(2.0 ** (-path / norm), DIGITS)

    def packed(self) -> bytes:
        return pickle.dumps((self.column.astype(np.int8), self.cut, np.packbits(self.leaf), self.length.astype(np.float32), self.sample))

    @classmethod
    def unpacked(cls, data: bytes) -> Forest:
        column, cut, leaf, length, size = pickle.loads(data)
        return cls(column.astype(np.int64), cut, np.unpackbits(leaf, count=cut.size).astype(bool).reshape(cut.shape), length.astype(float), size)


CARRIED = ["ticker", "trade_date", "close_price", "volume", *FEATURES]


def _keyed(featured: DataFrame, seed: int) -> DataFrame:
    return featured.select(*CARRIED).withColumns({
        "_hash": F.xxhash64("ticker", "trade_date", *FEATURES, F.lit(seed)),
        "_seed": F.abs(F.xxhash64("ticker") % 1_000_003),
    })


def _spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    # An explicit number keeps AQE from merging these small but compute-heavy groups into few tasks; it follows the rows.
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // SCORED_ROWS)), *keys)


def _output(featured: DataFrame, extra: str) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in featured.schema.fields}
    return ", ".join(f"{c} {kinds[c]}" for c in CARRIED) + f", {extra}"


def _typed(df: DataFrame) -> DataFrame:
    return df.select(
        "ticker", "trade_date", "close_price", "volume", "daily_return", "volume_ratio", "anomaly_score",
        S.anomaly_type(F.col("daily_return"), F.col("volume_ratio")).alias("anomaly_type"),
    )


def detect_isoforest(prices: DataFrame, trees: int = 100, contamination: float = CONTAMINATION, seed: int = SEED,
                     history: int = 30, **kw) -> DataFrame:
    """The most isolated share of the bars of every ticker; `kw` goes to the windows."""
    return detect_isoforest_long(full_windows(prices, history, **kw), trees, contamination, seed, history=history)


def forest_scores(featured: DataFrame, trees: int = 100, seed: int = SEED, pool_rows: int | None = None,
                  piece: int = PIECE, rows: int = 0, history: int = 0) -> DataFrame:
    """Rows with their `raw_score` of the tickers that have at least `history` featured ones, for series of any length. With the number of all in
    `rows`, the tasks follow it.

    `pool_rows` is accepted for older callers and changes nothing: every tree
    draws from the whole series.
    """
    keyed = _keyed(featured, seed)
    stats = keyed.groupBy("ticker").agg(F.count("*").alias("_n"), *[
        agg(c).alias(f"_{tag}_{c}") for c in FEATURES for tag, agg in (("m", F.avg), ("s", F.stddev_pop))]).filter(F.col("_n") >= history)

    @F.pandas_udf("boolean")
    def in_pool(row_hash: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series(_in_pool(row_hash.to_numpy(), n.to_numpy(), trees, seed))

    sized = keyed.join(stats, "ticker").withColumn("_pieces", F.ceil(F.col("_n") / piece).cast("int"))

    def scaled(pdf: pd.DataFrame) -> np.ndarray:
        x = np.empty((len(pdf), len(FEATURES)))
        for k, c in enumerate(FEATURES):
            std = pdf[f"_s_{c}"].iloc[0]
            x[:, k] = (pdf[c].to_numpy(float) - pdf[f"_m_{c}"].iloc[0]) / (std if std else 1.0)
        return x

    def grown(pdf: pd.DataFrame) -> Forest:
        rng = np.random.default_rng([seed, int(pdf["_seed"].iloc[0])])
        made = Forest.grown(_samples(scaled(pdf), pdf["_hash"].to_numpy(), trees, seed), rng)
        made.length = made.length.astype(np.float32).astype(float)  # as a forest that was sent to pieces
        return made

    def alone(table: pa.Table) -> pa.Table:
        # One of very many small groups: as Arrow, only what the forest needs becomes a frame.
        pdf = table.drop_columns(CARRIED[:4]).to_pandas()
        return table.select(CARRIED).append_column("raw_score", pa.array(grown(pdf).scores(scaled(pdf))))

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"ticker": pdf["ticker"].iloc[:1], "_pieces": pdf["_pieces"].iloc[:1], "_forest": [grown(pdf).packed()]})

    def apart(pdf: pd.DataFrame, forest: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pdf.reindex(columns=CARRIED).assign(raw_score=pd.Series(dtype=float))
        return pdf[CARRIED].assign(raw_score=Forest.unpacked(bytes(forest["_forest"].iloc[0])).scores(scaled(pdf)))

    shape = _output(featured, "raw_score double")
    small = _spread(sized.filter(F.col("_pieces") == 1), rows, "ticker").groupBy("ticker").applyInArrow(alone, shape)
    # Of a longer series the forest is grown once, from its pool, and goes to every piece.
    large = sized.filter(F.col("_pieces") > 1)
    forests = large.filter(in_pool("_hash", "_n")).groupBy("ticker").applyInPandas(send, "ticker string, _pieces int, _forest binary")
    forests = forests.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))).groupBy("ticker", "_piece")
    pieces = large.withColumn("_piece", F.pmod(F.xxhash64("trade_date", "_hash"), F.col("_pieces")).cast("int")).groupBy("ticker", "_piece")
    return small.unionByName(pieces.cogroup(forests).applyInPandas(apart, shape))


def detect_isoforest_long(featured: DataFrame, trees: int = 100, contamination: float = CONTAMINATION,
                          seed: int = SEED, **kw) -> DataFrame:
    """The most isolated share of featured rows, for series of any length.

    Features and scores are computed once and kept in the shared folder, as
    they are read twice. The threshold is the exact percentile per ticker: scores have six
    decimals, so it keeps at most a million distinct values however long the
    series is, and combines map-side.
    """
    featured = materialize(featured, "features")
    scores = materialize(forest_scores(featured, trees, seed, rows=featured.count(), **kw), "forest")
    limits = scores.groupBy("ticker").agg(F.percentile("raw_score", F.lit(1.0 - contamination)).alias("_limit"))
    flagged = scores.join(limits, "ticker").filter(F.col("raw_score") > F.col("_limit"))
    return _typed(flagged.withColumn("anomaly_score", F.col("raw_score") - F.col("_limit")))
