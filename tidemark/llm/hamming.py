"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code is the signs of its components, cut into segments with one index each; a segment has about as many bits as
the number of codes needs to be told apart (the base-2 logarithm, within LEAST and MOST). A search looks up, for
one radius after another, all segment values that differ in exactly so many bits from the query's, and verifies the Hamming
distance of what it finds. After radius r in all m segments every code within m * (r + 1) - 1 has been met, so a query ends
when its kth verified distance lies within that; the others go on. The first pass takes the radii 0 and 1.

Queries are not sent to every value they look up: an index is grouped by the upper bits of its values, and a query goes
once to every group within its radius. The values are looked up there.

Equal codes are indexed once, with their k + 1 smallest ids. Defined cases: vectors that are null, empty, of another length
than most or hold a null take no part; equal distances go to the smaller id; fewer than k candidates give all; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.session import materialize

K = 20
QUERY_EVERY = 20
#: Bits of a segment: at most 2 ** MOST values are looked up for a query in one index, whatever its radius.
LEAST, MOST = 8, 16
#: Most rows and queries of one piece of a group of an index; candidates verified in one step.
GROUP_ROWS, GROUP_QUERIES, STEP = 16_384, 16_384, 1 << 18


def masks_of(bits: int, radii: range) -> list[int]:
    """All masks of `bits` bits of which a number in `radii` is set."""
    return [sum(1 << i for i in own) for r in radii if r <= bits for own in combinations(range(bits), r)]


def _lookup(rows: pd.DataFrame, queries: pd.DataFrame, bits: int, low: int, radii: range, keep: int) -> pd.DataFrame:
    """The `keep` nearest rows (q, v, m, d) of each query in one group of one index: rows whose segment differs from the
    query's in so many bits as `radii` says. A group's rows share the bits of the segment above the `low` ones."""
    none = pd.DataFrame({"q": [], "v": [], "m": [], "d": []}).astype({"q": "int64", "v": "int64", "m": "int32", "d": "int32"})
    if not len(rows) or not len(queries):
        return none
    rows = rows.sort_values(["part", "v"])
    matrix = lambda f: np.frombuffer(b"".join(f["data"]), dtype=">u2").reshape(len(f), -1).astype(np.uint16)
    x, v, m = matrix(rows), rows["v"].to_numpy(), rows["m"].to_numpy()
    count = np.bincount(rows["part"].to_numpy() & ((1 << low) - 1), minlength=1 << low)
    start = np.cumsum(count) - count
    masks = np.array(masks_of(bits, radii), dtype=np.int64)
    queries = queries.assign(up=(queries["own"].to_numpy() >> low) ^ queries["g"].to_numpy())
    out = [none]
    for up, few in queries.groupby("up"):
        own_masks = masks[masks >> low == up]
        step = max(1, STEP // max(1, len(own_masks)))
        for a in range(0, len(few), step):
            part = few.iloc[a:a + step]
            y, q, own = matrix(part), part["q"].to_numpy(), part["own"].to_numpy().astype(np.int64)
            at = ((own[:, None] ^ own_masks[None, :]) & ((1 << low) - 1)).ravel()
            who = np.arange(len(part)).repeat(len(own_masks))[count[at] > 0]
            at = at[count[at] > 0]
            best = [none]
            for c in np.split(np.arange(len(at)), np.flatnonzero(np.diff(np.cumsum(count[at]) // STEP)) + 1):
                n = count[at[c]]
                i = who[c].repeat(n)
                j = start[at[c]].repeat(n) + np.arange(n.sum()) - (np.cumsum(n) - n).repeat(n)
                d = np.bitwise_count(y[i] ^ x[j]).sum(axis=1, dtype=np.int32)
                best.append(pd.DataFrame({"q": q[i], "v": v[j], "m": m[j], "d": d}).sort_values(["q", "d", "v"]).groupby("q").head(keep))
            out.append(pd.concat(best).sort_values(["q", "d", "v"]).groupby("q").head(keep))
    return pd.concat(out).astype(none.dtypes.to_dict())


def search(vectors: DataFrame, k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """(query_id, rank, vec_id, distance) of the rows of vectors(vec_id, embedding) whose id `every` divides."""
    spark = vectors.sparkSession
    good = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("x")).where(
        F.col("id").isNotNull() & F.coalesce((F.size("x") > 0) & F.forall("x", lambda v: v.isNotNull()), F.lit(False)))
    lengths = good.groupBy(F.size("x").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, distance int")
    size, rows = int(lengths["n"]), int(lengths["rows"])
    segment = min(MOST, max(LEAST, (rows - 1).bit_length()))
    segments = -(-size // segment)
    bits = [F.when(F.col("x")[i] > 0, 1 << i % segment).otherwise(0) for i in range(size)]
    code = F.array(*(sum(bits[s + 1:min(size, s + segment)], bits[s]) for s in range(0, size, segment)))
    coded = good.where(F.size("x") == size).select("id", code.alias("code"))
    few = coded.withColumn("_n", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(F.col("_n") <= k + 1)
    data = F.unhex(F.array_join(F.transform("code", lambda c: F.lpad(F.hex(c), 4, "0")), ""))  # 16 bits for each segment
    codes = materialize(few.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.col("ids")[0].alias("v"), "ids", "code", data.alias("data")), "codes")
    asked = materialize(coded.where(F.col("id") % every == 0).join(codes.select("code", "v").hint("merge"), "code").select(
        F.col("id").alias("query_id"), F.col("v").alias("q")), "code-queries")

    # Values of a segment are grouped by their upper bits; groups and their queries are cut into pieces of bounded size.
    upper = min(segment, (rows // GROUP_ROWS).bit_length())
    low = segment - upper
    group = ["s", "g"]
    index = codes.select("v", F.size("ids").alias("m"), "data", F.posexplode("code").alias("s", "part")).withColumn("g", F.shiftright("part", low))
    row_pieces = index.groupBy(*group).agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("rps"))
    active = materialize(codes.join(asked.select(F.col("q").alias("v")).distinct().hint("merge"), "v", "left_semi").select(
        F.col("v").alias("q"), "code", "data"), "codes-active")
    found = best = None
    near = Window.partitionBy("q").orderBy("d", "v")
    radii = range(0, 2)

    def meet(radii: range):
        return lambda l, r: _lookup(l, r, segment, low, radii, k + 1)

    while True:
        reach = F.split(F.lit(",".join(map(str, masks_of(upper, range(radii[-1] + 1))))), ",").cast("array<int>")
        probes = active.select("q", "data", F.posexplode("code").alias("s", "own")).select("*", F.explode(reach).alias("_m")).select(
            "q", "data", "s", "own", F.shiftright("own", low).bitwiseXOR(F.col("_m")).alias("g"))
        # At most 2 ** MOST rows for each segment.
        pieces = materialize(row_pieces.join(probes.groupBy(*group).agg(
            F.ceil(F.count("*") / GROUP_QUERIES).cast("int").alias("qps")), group), "code-groups")
        left = index.join(pieces, group).select(
            *group, "part", "v", "m", "data", F.pmod(F.xxhash64("v"), "rps").cast("int").alias("rp"), F.explode(F.sequence(F.lit(0), F.col("qps") - 1)).alias("qp"))
        right = probes.join(pieces, group).select(
            *group, "q", "data", "own", F.pmod(F.xxhash64("q"), "qps").cast("int").alias("qp"),
            F.explode(F.sequence(F.lit(0), F.col("rps") - 1)).alias("rp"))
        keys = [*group, "rp", "qp"]

        met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet(radii), "q long, v long, m int, d int")
        met = met if best is None else met.unionByName(best)
        kept = met.groupBy("q", "v").agg(F.first("m").alias("m"), F.first("d").alias("d")).withColumn(
            "_n", F.row_number().over(near)).where(F.col("_n") <= k + 1)
        # A query ends when k ids beside its own lie within the distance that is covered by now.
        whole = radii[-1] >= segment
        held = F.sum(F.when(F.col("d") <= segments * (radii[-1] + 1) - 1, F.col("m")).otherwise(0)).over(Window.partitionBy("q"))
        kept = materialize(kept.select("q", "v", "m", "d", (F.lit(whole) | (held >= k + 1)).alias("ended")), "codes-met")
        ended = kept.where("ended").drop("ended")
        found = ended if found is None else found.unionByName(ended)
        if whole:
            break
        active = materialize(active.join(ended.select("q").distinct().hint("merge"), "q", "left_anti"), "codes-active")
        if active.isEmpty():
            break
        best = kept.where("NOT ended").drop("ended")
        radii = range(radii[-1] + 1, radii[-1] + 2)
    ids = found.join(codes.select("v", "ids").hint("merge"), "v").select("q", "d", F.explode("ids").alias("vec_id"))
    by = Window.partitionBy("q").orderBy("d", "vec_id")
    lists = ids.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= k + 1).groupBy("q").agg(
        F.sort_array(F.collect_list(F.struct("_n", "vec_id", "d"))).alias("l"))
    return asked.join(lists, "q").select("query_id", F.filter("l", lambda r: r["vec_id"] != F.col("query_id")).alias("l")).select(
        "query_id", F.posexplode(F.slice("l", 1, k)).alias("p", "r")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("r.vec_id").alias("vec_id"), F.col("r.d").cast("int").alias("distance"))


def op6_exact_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


SQL = """
WITH p AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.embedding) + 1), lambda i: CAST((q.embedding[i] > 0) <> (v.embedding[i] > 0) AS INTEGER))) AS INTEGER) AS distance
  FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 20
"""
