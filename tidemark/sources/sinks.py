"""Writers and dataset audits."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", files: int | None = None,
                  partition_by: Iterable[str] = (), header: bool = True) -> None:
    """Overwrite a dataset, optionally as a fixed number of files or partitioned.

    With partition columns the rows are rebalanced on them first: AQE splits a
    big partition value over several files instead of giving it to one task.
    """
    keys = list(partition_by)
    if files:
        df = df.repartition(files)
    elif keys:
        df = df.hint("rebalance", *keys)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        # White space and line ends inside a text are part of it.
        writer = writer.options(header=header, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if keys:
        writer = writer.partitionBy(*keys)
    writer.save(path)


def write_clustered(df: DataFrame, path: str, key: str, order: Iterable[str] = (), row_group_bytes: int = 8 << 20, keys: int = 1_000_000) -> None:
    """Parquet for point loads: rows ranged and sorted by key, then `order`, in small row groups with a Bloom filter on the key.

    A load of one key reads the row groups whose range holds it; statistics and filter rule out the others. The ranges are over
    key and order, so a key with very many rows is spread over several files.
    """
    by = [key, *order]
    options = {"parquet.block.size": str(row_group_bytes), "parquet.page.size.row.check.min": "10", "parquet.block.size.row.check.min": "100",
               f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.expected.ndv#{key}": str(keys)}
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").options(**options).parquet(path)


def _swap(spark: SparkSession, path: str, staged: str | None = None) -> None:
    """Puts a staged folder in the place of `path` by renaming. What an interrupted swap left is set right first."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, old = hadoop.Path(path), hadoop.Path(path.rstrip("/") + "._old")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(old):
        if files.exists(target):  # it was interrupted after the second step
            files.delete(old, True)
        else:  # between the steps: the old data are all there is
            files.rename(old, target)
    if staged is None:
        return
    if files.exists(target) and not files.rename(target, old) or not files.rename(hadoop.Path(staged), target):
        raise OSError(f"cannot put {staged} in the place of {path}")
    files.delete(old, True)


def write_if_nonempty(df: DataFrame, path: str, **options) -> bool:
    """Overwrite only when there are rows.

    The result is written once, beside the target, and takes its place by renaming; so a plan that reads `path` itself is safe, and
    after an interruption `path` holds the old data or the new ones.
    """
    spark = df.sparkSession
    _swap(spark, path)
    staged = f"{path.rstrip('/')}._new-{uuid.uuid4().hex}"
    write_dataset(df, staged, **options)
    written = spark.read.format(options.get("fmt", "parquet")).schema(df.schema).load(staged)
    if written.isEmpty():
        at = spark._jvm.org.apache.hadoop.fs.Path(staged)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        return False
    _swap(spark, path, staged)
    return True


def store_etl(frames: dict[str, DataFrame], root: str) -> None:
    """The cleaned and derived datasets under one root."""
    for name, frame in frames.items():
        write_dataset(frame, f"{root}/{name}")


def append_batch(df: DataFrame, path: str, columns: list[str], ingest_date: str) -> None:
    """Append a fetch in the enforced column order, below its ingest date."""
    present = [c for c in columns if c in df.columns]
    df.select(*present, F.lit(ingest_date).cast("date").alias("ingest_date")).write.mode("append").partitionBy(
        "ingest_date").parquet(path)


def dataset_status(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Files and rows per dataset.

    Rows are counted per file first, so the number of distinct files costs
    one small row per file and task.
    """
    out = None
    for name, path in paths.items():
        df = spark.read.format(fmt).option("header", True).load(path)
        per_file = df.select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count("*").alias("n"))
        part = per_file.agg(F.count("*").alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).select(
            F.lit(name).alias("dataset"), "files", "rows", (F.col("rows") > 0).alias("ready"))
        out = part if out is None else out.unionByName(part)
    return out
