"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

A source's target is its weight times one common level, but never more than `max_epochs` times its own size. The level
rises until the targets add up to the wanted share: sources above their cap are clamped there and what they leave goes
to the others by weight, until none is above. A document is then taken whole, floor(target / size) times, and once more
if its seeded place in its source lies below the fractional rest; the place is an interval on the source's words in the
order of a hash, so a source's taken words miss its target by at most half of one document.

Defined cases: a null text has size 0 and is taken 0 words; a null source is a source of its own, ranked last; rows that
repeat count as separate documents; an empty table gives an empty result; further columns are ignored. Where the wanted
share exceeds what the caps allow, every source ends at its cap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, table
from tidemark.operators.align import small
from tidemark.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2.0
SEED = "mix-1"
#: Hex digits of the hash that name a bucket of a source.
BUCKET_DIGITS = 4


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Ranks come from a range-partitioned sort and one count per partition, not from one task. Each round of the filling
    is one aggregate over the sources that brings three numbers to the driver.
    """
    ordered = materialize(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .orderBy(F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id()), "mix-sources")
    parts = ordered.groupBy("_part").agg(F.count("*").alias("_n"))
    before = parts.select("_part", F.coalesce(F.sum("_n").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.row_number().over(
        Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())) - 1
    sources = ordered.join(before, "_part").select(
        "source", "source_size",
        F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("double").alias("_w"),
        (F.col("source_size") * F.lit(float(max_epochs))).alias("_cap"))
    sources = materialize(sources, "mix-weights")

    total, weight = sources.agg(F.sum("source_size"), F.sum("_w")).first()
    budget, level, clamped = share * float(total or 0), 0.0, -1
    if weight:
        level = budget / weight
        while True:
            over = F.col("_w") * level >= F.col("_cap")
            n, held, free = sources.agg(
                F.count(F.when(over, 1)), F.sum(F.when(over, F.col("_cap"))), F.sum(F.when(~over, F.col("_w")))).first()
            if n == clamped or not free:
                break
            clamped, level = n, (budget - (held or 0.0)) / free
    return sources.select("source", "source_size", F.least(F.col("_cap"), F.col("_w") * level).alias("target"))


def place(doc_id: Column, seed: str = SEED) -> Column:
    """The document's seeded place in the order of its source, as hex digits."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def bucket(place: Column) -> Column:
    return F.conv(F.substring(place, 1, BUCKET_DIGITS), 16, 10).cast("int")


def planned(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS,
            seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """Sizes and places of docs(doc_id, text, source), and for each source `_s` what is taken of it, by bucket; both stored."""
    sized = materialize(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), place(F.col("doc_id"), seed).alias("_u")), "mix-sizes")
    sized = sized.withColumn("_bucket", bucket(F.col("_u")))
    plan = targets(sized, weights, share, max_epochs).withColumn(
        "_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    ).withColumn("_need", F.col("target") - F.col("_whole") * F.col("source_size"))

    # The bucket in which a source's fractional rest ends; all before it are taken, none after it.
    so_far = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        sized.groupBy("source", "_bucket").agg(F.sum("size").alias("_in"))
        .withColumn("_before", F.coalesce(F.sum("_in").over(so_far), F.lit(0)))
        .join(plan.select(F.col("source").alias("_s"), "_need"), F.col("source").eqNullSafe(F.col("_s"))))
    whole = F.col("_before") + F.col("_in") <= F.col("_need")
    parted = ~whole & (F.col("_before") < F.col("_need"))
    ends = buckets.groupBy("_s").agg(
        F.max(F.when(whole, F.col("_bucket"))).alias("_last"), F.max(F.when(parted, F.col("_bucket"))).alias("_edge"),
        F.max(F.when(parted, F.col("_before"))).alias("_before"))
    return sized, materialize(plan.join(ends, F.col("source").eqNullSafe(F.col("_s"))).drop("source"), "mix-plan")


def usual() -> Column:
    """How many times a row is taken by the bucket it is in, were there no bucket that is taken in part."""
    at_edge = F.coalesce(F.col("_bucket") == F.col("_edge"), F.lit(False))
    extra = ~at_edge & F.coalesce(F.col("_bucket") <= F.col("_last"), F.lit(False))
    return F.col("_whole") + F.when(extra & (F.col("_need") > 0), 1).otherwise(0)


def timed(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of `sized` with their source's plan, `_usual` and `_times`."""
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("_s"))).withColumn("_usual", usual())
    at_edge = F.coalesce(F.col("_bucket") == F.col("_edge"), F.lit(False))
    in_edge = Window.partitionBy("source", "_bucket").orderBy("_u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    extra = rows.where(at_edge).withColumn(
        "_extra", F.col("_before") + F.coalesce(F.sum("size").over(in_edge), F.lit(0)) + F.col("size") / 2 <= F.col("_need"))
    # Where no fraction is left, not even empty documents are taken once more.
    edge = extra.withColumn("_times", F.col("_whole") + F.when(F.col("_extra") & (F.col("_need") > 0), 1).otherwise(0)).drop("_extra")
    return rows.where(~at_edge).withColumn("_times", F.col("_usual")).unionByName(edge)


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken, times) of every row of docs(doc_id, text, source)."""
    return timed(*planned(docs, weights, share, max_epochs, seed)).select(
        "doc_id", "size", "source_size", "target",
        (F.col("_times") * F.col("size")).cast("long").alias("taken"), F.col("_times").cast("int").alias("times"))


def repeated(docs: DataFrame, keep: str) -> DataFrame:
    """Column `keep` of docs(doc_id, text, source), as many times as the mix takes the document; of a doc_id with several rows all
    are taken as often as that of them which is taken most.

    Texts stay where they are. What a row's source and bucket say is sent to them; and so is what differs from it, which is the
    documents of a bucket that is taken in part and those with rows in several sources, or it meets them by shuffle where it is much.
    """
    sized, plan = planned(docs.select("doc_id", "text", "source"))
    least, most = F.min("_usual").alias("_least"), F.max("_usual").alias("_most")
    per_doc = timed(sized, plan).groupBy(F.col("doc_id").alias("_id")).agg(F.max("_times").alias("_times"), least, most)
    other = materialize(per_doc.where("_times != _least OR _times != _most").select("_id", "_times"), "mix-others")
    rows = docs.select(keep, "doc_id", "source", bucket(place(F.col("doc_id"))).alias("_bucket"))
    rows = rows.join(small(plan), F.col("source").eqNullSafe(F.col("_s"))).withColumn("_usual", usual())
    rows = rows.join(small(other), F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    times = F.coalesce("_times", "_usual").cast("int")
    return rows.where(times > 0).select(keep, F.explode(F.sequence(F.lit(1), times))).select(keep)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS u
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([5, 2, 1][(row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w
  FROM d GROUP BY source),
c AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / w, source) AS k FROM s),
l AS (
  SELECT c.*, (1.5::DOUBLE * (SELECT sum(source_size) FROM s)
               - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM c),
lv AS (SELECT coalesce((SELECT level FROM l WHERE w * level < cap ORDER BY k LIMIT 1), 1e300) AS level),
p AS (
  SELECT source, source_size, least(cap, w * (SELECT level FROM lv)) AS target FROM c),
q AS (
  SELECT d.*, source_size, target, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS whole,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY u, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + CASE WHEN target - whole * source_size > 0 AND before + size / 2 <= target - whole * source_size THEN size ELSE 0 END AS BIGINT) AS taken,
       CAST(whole + CASE WHEN target - whole * source_size > 0 AND before + size / 2 <= target - whole * source_size THEN 1 ELSE 0 END AS INTEGER) AS times
FROM q
"""
