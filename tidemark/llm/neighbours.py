"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are built on a bounded sample: each split is the median of the sample's projections on the difference of two of
its vectors. A further coordinate that makes all lengths equal turns the largest inner product into the nearest direction.
Every vector is put into its leaf of each tree. A query walks all trees with one priority queue, in the order of how far it
lies from the splits it has crossed, until it has taken as many leaves as the sample showed to be needed for the wanted
recall. Leaves are searched exactly, in double precision on the original vectors, and the best of all leaves are ranked.

Equal vectors are indexed once and keep their k + 1 smallest ids, which is all that a result of k can need. Leaves and their
queries are cut into pieces of bounded size.

Defined cases: vectors that are null, empty, zero, of another length than most, or that hold null or non-finite components
take no part; a null id is left out; equal scores go to the smaller id; fewer than k candidates give all; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.session import materialize

K = 20
QUERY_EVERY = 20
#: Bounds of the index: vectors it is built on, trees, splits above a leaf, queries by which the recall is measured.
SAMPLE, TREES, DEPTH, TRIALS = 8_192, 6, 5, 128
RECALL = 0.96
#: Most vectors and queries of one piece of a leaf.
LEAF_ROWS, LEAF_QUERIES = 16_384, 16_384


@dataclass
class Forest:
    """Splits of all trees as rows: node n of a tree has the children 2n + 1 and 2n + 2."""

    planes: np.ndarray  # (trees * splits, dimensions + 1)
    cuts: np.ndarray
    trees: int
    depth: int
    longest: float  # squared length that the further coordinate fills up to
    leaves: int = 1  # that a query takes

    @property
    def splits(self) -> int:
        return (1 << self.depth) - 1

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.longest - (x * x).sum(axis=1)))
        return np.column_stack([x, rest])

    def sides(self, x: np.ndarray) -> np.ndarray:
        """Signed distance of each row to each split."""
        return (x @ self.planes.T - self.cuts).reshape(len(x), self.trees, self.splits)

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row in each tree."""
        side = self.sides(self.lifted(x))
        at = np.zeros((len(x), self.trees), dtype=np.int64)
        for _ in range(self.depth):
            at = 2 * at + 1 + (np.take_along_axis(side, at[:, :, None], 2)[:, :, 0] > 0)
        return at - self.splits

    def search(self, queries: np.ndarray, leaves: int) -> list[list[tuple[int, int]]]:
        """The first leaves (tree, leaf) of each query, by one queue over all trees."""
        out = []
        for side in self.sides(np.column_stack([queries, np.zeros(len(queries))])).tolist():
            queue = [(0.0, t, 0) for t in range(self.trees)]
            taken: list[tuple[int, int]] = []
            while queue and len(taken) < leaves:
                far, t, n = heapq.heappop(queue)
                while n < self.splits:
                    s = side[t][n]
                    near = 2 * n + 1 + (s > 0)
                    heapq.heappush(queue, (max(far, abs(s)), t, 4 * n + 3 - near))
                    n = near
                taken.append((t, n - self.splits))
            out.append(taken)
        return out


def build(sample: np.ndarray, longest: float, k: int = K, seed: int = 5) -> Forest:
    """A forest on the sample, with the number of leaves at which the sample's own queries reach RECALL."""
    rng = np.random.default_rng(seed)
    splits = (1 << DEPTH) - 1
    forest = Forest(np.zeros((TREES * splits, sample.shape[1] + 1)), np.zeros(TREES * splits), TREES, DEPTH, longest)
    x = forest.lifted(sample)
    for t in range(TREES):
        rows = {0: np.arange(len(x))}
        for n in range(splits):
            own = rows.pop(n)
            plane = rng.normal(size=x.shape[1])
            if len(own) > 1:
                a, b = x[rng.choice(own, 2, replace=False)]
                plane = a - b if np.any(a != b) else plane
            plane = plane / np.linalg.norm(plane)
            value = x[own] @ plane
            cut = float(np.median(value)) if len(own) else 0.0
            forest.planes[t * splits + n], forest.cuts[t * splits + n] = plane, cut
            rows[2 * n + 1], rows[2 * n + 2] = own[value <= cut], own[value > cut]
    tried = rng.choice(len(x), min(TRIALS, len(x)), replace=False)
    scores = sample[tried] @ sample.T
    scores[np.arange(len(tried)), tried] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :min(k, len(x) - 1)]
    leaf = forest.leaf(sample)
    order = forest.search(sample[tried], TREES << DEPTH)
    # Step of the search at which each of the true neighbours is first met.
    met = np.zeros(best.shape)
    for i, taken in enumerate(order):
        step = np.zeros((TREES, 1 << DEPTH))
        for j, (t, n) in enumerate(taken):
            step[t, n] = j + 1
        met[i] = step[np.arange(TREES), leaf[best[i]]].min(axis=1)
    forest.leaves = int(np.quantile(met, RECALL, method="higher")) if met.size else 1
    return forest


def search(vectors: DataFrame, k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows of vectors(vec_id, embedding) whose id `every` divides."""
    spark = vectors.sparkSession
    good = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("x")).where(
        F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)
        & F.coalesce(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
        & F.exists("x", lambda v: v != 0))
    lengths = good.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if lengths is None:
        return empty
    size = int(lengths["n"])
    # Equal vectors once, with their smallest ids; copies are cut off before the shuffle.
    few = good.where(F.size("x") == size).withColumn("_n", F.row_number().over(Window.partitionBy("x").orderBy("id"))).where(F.col("_n") <= k + 1)
    distinct = materialize(few.groupBy("x").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.col("ids")[0].alias("v"), "ids", "x"), "vectors")
    asked = materialize(good.where((F.size("x") == size) & (F.col("id") % every == 0)).select("id", "x").join(
        distinct.select("x", "v"), "x").select(F.col("id").alias("query_id"), F.col("v").alias("q")), "vector-queries")
    count, longest = distinct.agg(F.count("*"), F.max(F.aggregate("x", F.lit(0.0), lambda a, b: a + b * b))).first()
    sample = distinct.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("x").toPandas()["x"]
    forest = build(np.array(sample.tolist(), dtype=np.float64), float(longest), k)
    queries = asked.select("q").distinct()
    n_queries = queries.count()
    row_parts = max(1, -(-count // (LEAF_ROWS << DEPTH)))
    query_parts = max(1, -(-n_queries // LEAF_QUERIES))

    def as_bytes(x: np.ndarray) -> list[bytes]:
        return [r.tobytes() for r in x]

    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                x = np.array(f["x"].tolist(), dtype=np.float64)
                leaf, data, part = forest.leaf(x), as_bytes(x), f["v"].to_numpy() // 7 % row_parts
                for t in range(forest.trees):
                    for p in range(query_parts):
                        yield pd.DataFrame({"tree": t, "leaf": leaf[:, t], "rp": part, "qp": p, "v": f["v"], "x": data})

    def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                x = np.array(f["x"].tolist(), dtype=np.float64)
                data, taken = as_bytes(x), forest.search(x, forest.leaves)
                at = np.repeat(np.arange(len(f)), [len(t) for t in taken])
                tree, leaf = np.array([p for t in taken for p in t]).T
                q = f["v"].to_numpy()[at]
                for p in range(row_parts):
                    yield pd.DataFrame({"tree": tree, "leaf": leaf, "rp": p, "qp": q // 7 % query_parts, "q": q, "y": [data[i] for i in at]})

    keys = ["tree", "leaf", "rp", "qp"]
    rows = distinct.select("v", "x").mapInPandas(index, "tree int, leaf int, rp int, qp int, v long, x binary")
    probes = distinct.join(queries.withColumnRenamed("q", "v"), "v", "left_semi").select("v", "x").mapInPandas(
        probe, "tree int, leaf int, rp int, qp int, q long, y binary")

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"q": [], "v": [], "score": []}).astype({"q": "int64", "v": "int64", "score": "float64"})
        left = left.sort_values("v")
        x, v = np.frombuffer(b"".join(left["x"]), dtype=np.float64).reshape(len(left), -1), left["v"].to_numpy()
        y, q = np.frombuffer(b"".join(right["y"]), dtype=np.float64).reshape(len(right), -1), right["q"].to_numpy()
        out, most = [], min(k + 1, len(v))
        for a in range(0, len(y), 256):
            score = y[a:a + 256] @ x.T
            edge = -np.partition(-score, most - 1, axis=1)[:, most - 1:most]
            i, j = np.nonzero(score >= edge)  # rows of v are in order, so equal scores keep the smaller ids first
            order = np.lexsort((j, -score[i, j], i))
            i, j = i[order], j[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            i, j = i[rank < most], j[rank < most]
            out.append(pd.DataFrame({"q": q[a:a + 256][i], "v": v[j], "score": score[i, j]}))
        return pd.concat(out)

    found = probes.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(lambda r, l: best(l, r), "q long, v long, score double")
    found = found.groupBy("q", "v").agg(F.max("score").alias("score"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "v")
    found = found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1).drop("_n")
    ids = found.join(distinct.select("v", "ids"), "v").select("q", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ids = materialize(ids.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1).select(
        "q", "vec_id", "score", F.col("_n").alias("_n")), "vector-found")
    # One row per query vector, so that the queries that share it are joined once.
    lists = ids.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("_n", "vec_id", "score"))).alias("l"))
    return asked.join(lists, "q").select("query_id", F.filter("l", lambda r: r["vec_id"] != F.col("query_id")).alias("l")).select(
        "query_id", F.posexplode(F.slice("l", 1, k)).alias("p", "r")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("r.vec_id").alias("vec_id"), F.col("r.score").alias("score"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
