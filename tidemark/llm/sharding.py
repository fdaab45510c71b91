"""Sharding by the minimax contiguous partition of atomic groups, in DataFrame functions only.

Rows with equal texts form one atomic group; groups are ordered by their smallest doc_id. The smallest capacity for which
a greedy sweep needs no more than `shards` shards is found by binary search, and the sweep's cuts are taken. The sweep
does not walk over groups: it sees sums over cells, ranges of ids of a power of two. On cells it gives one track that is
surely reached and one that cannot be passed; only the cells in which a cut may lie are split sixteenfold by another
aggregate, until those are single groups. The driver holds a few tens of thousands of sums, whatever the input.

Law `bytes`: sizes as equal as contiguous groups allow. Defined cases: a null text has no bytes (size 8, crc32 0) and all
null texts form one group; a null doc_id counts as 0 in the order; repeated rows stay together; groups whose smallest
doc_id is the same are cut as one; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.session import materialize

SHARDS = 24
ROW_BYTES = 8
#: Cells at the first look, and bits by which a cell is split.
CELLS = 1 << 14
SPLIT_BITS = 4
#: Rows of a shard that are numbered in one window group.
SLOT_ROWS = 50_000


class Cells:
    """Sums over ranges of ids in order; a cell of shift 0 is one group."""

    def __init__(self, ids: list[int], sums: list[int], shifts: list[int]):
        order = sorted(range(len(ids)), key=lambda i: ids[i] << shifts[i])
        self.ids, self.shifts = [ids[i] for i in order], [shifts[i] for i in order]
        self.sums = np.array([sums[i] for i in order], dtype=np.int64)
        self.ends = np.concatenate([[0], np.cumsum(self.sums)])
        self.total = int(self.ends[-1])
        self.single = np.array([s == 0 for s in self.shifts] + [True])

    def sweep(self, capacity: int, shards: int, sure: bool) -> list[int]:
        """Where each shard ends, in summed size: at least (sure) or at most."""
        at, out = 0, []
        for _ in range(shards):
            goal = at + capacity
            i = int(np.searchsorted(self.ends, goal, side="right")) - 1
            at = int(self.ends[i]) if sure or goal >= self.total or self.single[i] else goal
            out.append(at)
        return out

    def least(self, shards: int, sure: bool) -> int:
        low, high = -(-self.total // shards) - 1, self.total
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (low, mid) if self.sweep(mid, shards, sure)[-1] >= self.total else (mid, high)
        return high

    def open(self, shards: int) -> tuple[int, list[int]]:
        """The least capacity that may do, and the cells to split before it and its cuts are certain."""
        may, does = self.least(shards, False), self.least(shards, True)
        cells: set[int] = set()
        for low, high in zip(self.sweep(may, shards, True), self.sweep(does, shards, False)):
            a = int(np.searchsorted(self.ends, low, side="right")) - 1
            b = int(np.searchsorted(self.ends, high, side="right")) - 1
            cells.update(i for i in range(a, min(b, len(self.ids) - 1) + 1) if not self.single[i])
        return may, sorted(cells)


def cut_ids(groups: DataFrame, shards: int = SHARDS) -> list[int]:
    """The first id of every shard but the first, from groups(_key, _sum)."""
    low, high = groups.agg(F.min("_key"), F.max("_key")).first()
    if low is None:
        return []
    shift = 0
    while (high >> shift) - (low >> shift) >= CELLS:
        shift += 1

    def look(df: DataFrame, shift: int) -> tuple[list[int], list[int]]:
        rows = df.groupBy(F.shiftright("_key", shift).alias("_c")).agg(F.sum("_sum").alias("_n")).collect()
        return [r[0] for r in rows], [int(r[1]) for r in rows]

    ids, sums = look(groups, shift)
    cells = Cells(ids, sums, [shift] * len(ids))
    while True:
        capacity, wide = cells.open(shards)
        if not wide:
            break
        by_shift: dict[int, list[int]] = {}
        for i in wide:
            by_shift.setdefault(cells.shifts[i], []).append(cells.ids[i])
        gone = set(wide)
        keep = [i for i in range(len(cells.ids)) if i not in gone]
        ids, sums, shifts = [cells.ids[i] for i in keep], [int(cells.sums[i]) for i in keep], [cells.shifts[i] for i in keep]
        for old, own in by_shift.items():
            new = max(0, old - SPLIT_BITS)
            more = look(groups.where(F.shiftright("_key", old).isin(own)), new)
            ids, sums, shifts = ids + more[0], sums + more[1], shifts + [new] * len(more[0])
        cells = Cells(ids, sums, shifts)
    firsts = []
    for end in cells.sweep(capacity, shards, True)[:-1]:
        i = int(np.searchsorted(cells.ends, end, side="left"))
        firsts.append(cells.ids[i] << cells.shifts[i] if i < len(cells.ids) else None)
    return [x for x in firsts if x is not None]


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of docs(doc_id, text)."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = materialize(docs.select(
        "doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"),
        F.xxhash64("text", F.col("text").isNull()).alias("_text")), "shard-rows")
    groups = materialize(
        rows.groupBy("_text", "size", "text_crc32").agg(
            F.sum("size").alias("_sum"), F.coalesce(F.min("doc_id"), F.lit(0)).cast("long").alias("_key")), "shard-groups")
    firsts = cut_ids(groups, shards)
    own = F.lit(0)
    for first in firsts:
        own = own + (F.col("_key") >= F.lit(first)).cast("int")
    placed = rows.join(groups.select("_text", "size", "text_crc32", own.alias("shard")), ["_text", "size", "text_crc32"])
    parts = max(1, rows.count() // (shards * SLOT_ROWS))
    placed = materialize(placed.select(
        "doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts)).cast("int").alias("_h")), "shard-placed")
    counts = placed.groupBy("shard", "_h").agg(F.count("*").alias("_n"))
    before = counts.select("shard", "_h", F.coalesce(F.sum("_n").over(
        Window.partitionBy("shard").orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy("shard", "_h").orderBy("doc_id", "text_crc32", "size"))
    return placed.withColumn("_n", number).join(before, ["shard", "_h"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("_before") + F.col("_n") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op7_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
