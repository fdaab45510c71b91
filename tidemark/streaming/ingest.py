"""Incremental versions of ingest and daily sentiment over landing directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LATE = "1 day"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_landing(spark: SparkSession, path: str, layout, fmt: str = "csv", glob: str | None = None,
                 max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(layout).option("header", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def run_available(df: DataFrame, out: str, checkpoint: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Process what has landed since the last run, then stop."""
    query = (
        df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
        .option("path", out).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def unique_posts(stream: DataFrame, key: str = "post_id") -> DataFrame:
    """Drop repeats of an id, however much later they come. There is no watermark:
    a post may be fetched first long after it was written. State is one key per
    id ever seen, dealt over the shuffle partitions."""
    return stream.dropDuplicates([key])


def stream_ingest(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Land unique posts; a restart continues after the last committed batch.

    The ids seen are kept in RocksDB, so executors hold them on disk and not in
    memory. Checkpoints of the former form with a watermark cannot be continued.
    """
    conf, provider = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(provider, None)
    conf.set(provider, ROCKSDB)
    try:
        run_available(unique_posts(stream), out, checkpoint)
    finally:
        conf.set(provider, before) if before else conf.unset(provider)
    return stream.sparkSession.read.parquet(out)


def daily_sentiment(stream: DataFrame, late: str = LATE) -> DataFrame:
    """Mean score per ticker and day; a day is final once the watermark has passed it."""
    day = F.window("event_ts", "1 day")
    return (
        stream.withWatermark("event_ts", late).groupBy(day, "ticker")
        .agg(F.avg("sentiment_score").alias("daily_sentiment"), F.count("*").alias("article_count"))
        .select("ticker", F.to_date("window.start").alias("event_day"), "daily_sentiment", "article_count")
    )


def stream_daily_sentiment(stream: DataFrame, out: str, checkpoint: str, late: str = LATE) -> DataFrame:
    run_available(daily_sentiment(stream, late), out, checkpoint)
    return stream.sparkSession.read.parquet(out)
