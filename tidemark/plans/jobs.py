"""The batch jobs: read landed files, compute, write processed datasets.

Every job writes its result once; summaries start from the written data.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import clean as C
from tidemark.operators import aggregates, align, anomaly, clean, forest, momentum, sentiment, tagging, views
from tidemark.session import materialize
from tidemark.sources import readers, sinks


@dataclass(frozen=True)
class Paths:
    """Folders of the landed and the processed data."""

    root: str

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def processed(self, name: str) -> str:
        return f"{self.root}/processed/{name}"


def _prices(spark: SparkSession, paths: Paths, folder: str = "prices") -> DataFrame:
    raw = readers.read_prices(spark, paths.raw(folder))
    return raw.withColumns({"ticker": C.clean_symbol(F.col("ticker")), "exchange": C.norm_key(F.col("exchange"))})


def clean_prices(prices: DataFrame) -> DataFrame:
    """One bar per ticker and day: the one with the highest volume."""
    return clean.dedupe_prices(prices.filter(F.col("trade_date").isNotNull()))


# Rows of one series that a task sorts at most; longer ones are cut into pieces.
HOT_ROWS = 1_000_000
# What orders bars that landed with the same time, as from two fetches.
TIE = ("close_price", "volume", "high_price", "low_price")


def _bars(spark: SparkSession, paths: Paths, folder: str) -> DataFrame:
    """Bars as landed with their time as `trade_date`, several a day where they are
    intraday; only the ETL keeps one per day. They are parsed once and kept in the shared folder, as series are counted before their windows."""
    bars = _prices(spark, paths, folder).filter(F.col("trade_date").isNotNull())
    return materialize(bars.withColumn("trade_date", F.col("ts")).drop("ts"), "landed-bars")


def clean_news(news: DataFrame) -> DataFrame:
    tagged = clean.drop_header_rows(news, "first").withColumn("matched_tickers", C.norm_key(F.col("matched_tickers")))
    return clean.dedupe_news(tagged)


def run_etl(spark: SparkSession, paths: Paths) -> dict[str, DataFrame]:
    """Clean, deduplicate, align news with prices, count articles. The clean
    tables are written first and read back for the join and the counts."""
    sinks.store_etl({
        "prices_clean": clean_prices(_prices(spark, paths)),
        "news_clean": clean_news(readers.read_news(spark, paths.raw("news"))),
    }, paths.processed("").rstrip("/"))
    prices = spark.read.parquet(paths.processed("prices_clean"))
    flat = tagging.explode_tickers(spark.read.parquet(paths.processed("news_clean")))
    sinks.store_etl({
        "news_price_aligned": align.news_price_aligned(flat, prices),
        "daily_news_volume": aggregates.daily_news_volume(flat),
    }, paths.processed("").rstrip("/"))
    names = ("prices_clean", "news_clean", "news_price_aligned", "daily_news_volume")
    return {n: spark.read.parquet(paths.processed(n)) for n in names}


def run_sentiment(spark: SparkSession, paths: Paths, processed_at: str, lexicon: DataFrame | None = None,
                  files: int | None = None) -> dict[str, DataFrame]:
    news = readers.read_news(spark, paths.raw("news"))
    posts = None
    if readers.exists(spark, paths.raw("reddit"), "text"):
        posts = clean.dedupe_posts(readers.read_reddit(spark, paths.raw("reddit")))
        posts = posts.withColumn("created_utc", C.to_date_key(F.col("created_utc")))
    lexicon = sentiment.default_lexicon(spark) if lexicon is None else lexicon
    sinks.write_dataset(sentiment.sentiment_by_ticker(news, posts, lexicon, processed_at),
                        paths.processed("sentiment"), files=files)
    scores = spark.read.parquet(paths.processed("sentiment"))
    return {
        "sentiment": scores, "labels": aggregates.value_counts(scores, "sentiment_label"),
        "top_tickers": aggregates.top_tickers(scores),
    }


def _stored_sentiment(spark: SparkSession, paths: Paths) -> DataFrame | None:
    scores = readers.read_or_empty(spark, paths.processed("sentiment"), schema.SENTIMENT)
    return None if scores.isEmpty() else scores


def run_anomalies(spark: SparkSession, paths: Paths, strict: bool = False, trees: int = 100,
                  folder: str = "prices", hot_rows: int = HOT_ROWS) -> dict[str, DataFrame]:
    """Weighted score, or with `strict` the isolation forest with divergence types.

    Every bar counts; `anomaly_date` is its day, `anomaly_ts` its time.
    """
    prices, scores = _bars(spark, paths, folder), _stored_sentiment(spark, paths)
    if strict:
        found = forest.detect_isoforest(prices, trees, hot_rows=hot_rows, tie=TIE)
        out = anomaly.divergences(found, scores) if scores is not None else anomaly.correlate_sentiment(found, None)
    else:
        out = anomaly.correlate_sentiment(anomaly.detect_anomalies(prices, hot_rows=hot_rows, tie=TIE), scores)
    timed = out.select(*anomaly.OUTPUT, F.col("anomaly_date").alias("anomaly_ts"))
    by_year = timed.withColumn("anomaly_date", F.to_date("anomaly_date")).withColumn("year", F.year("anomaly_date"))
    sinks.write_dataset(by_year, paths.processed("anomalies"), partition_by=["year"])
    stored = spark.read.parquet(paths.processed("anomalies"))
    return {
        "anomalies": stored, "types": aggregates.value_counts(stored, "anomaly_type"),
        "top": views.top_anomalies(stored),
    }


def run_momentum(spark: SparkSession, paths: Paths, dim: DataFrame, computed_at: str,
                 strict: bool = False, folder: str = "prices", hot_rows: int = HOT_ROWS) -> dict[str, DataFrame]:
    prices = _bars(spark, paths, folder).dropna(subset=["trade_date", "close_price", "ticker"])
    scores = _stored_sentiment(spark, paths)
    daily = aggregates.daily_sentiment(scores) if scores is not None else None
    bars = align.blend_sentiment(prices, daily, hot_rows=hot_rows, tie=TIE[:1])
    blended = align.with_sector(bars.withColumn("trade_date", F.to_date("trade_date")), dim)
    out = momentum.all_momentum(aggregates.daily_sector(blended, strict), strict=strict)
    sinks.write_if_nonempty(clean.with_run_columns(out, computed_at, "computed_at"), paths.processed("momentum"),
                            partition_by=["window_days"])
    stored = readers.read_or_empty(spark, paths.processed("momentum"), schema.MOMENTUM)
    return {"momentum": stored, "latest": momentum.latest_momentum(stored)}


def run_strict(spark: SparkSession, paths: Paths, dim: DataFrame, now: str,
               lexicon: DataFrame | None = None) -> dict[str, DataFrame]:
    """All three stages under the full-window rules."""
    out = run_sentiment(spark, paths, now, lexicon)
    return {**out, **run_anomalies(spark, paths, strict=True), **run_momentum(spark, paths, dim, now, strict=True)}


STAGES = ("etl", "nlp", "anomaly", "momentum")


def run(spark: SparkSession, paths: Paths, dim: DataFrame, now: str, stages: Iterable[str] = STAGES) -> dict[str, DataFrame]:
    """Selected stages in their fixed order, then the state of the datasets."""
    chosen = set(stages)
    unknown = chosen - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    out: dict[str, DataFrame] = {}
    if "etl" in chosen:
        out |= run_etl(spark, paths)
    if "nlp" in chosen:
        out |= run_sentiment(spark, paths, now)
    if "anomaly" in chosen:
        out |= run_anomalies(spark, paths)
    if "momentum" in chosen:
        out |= run_momentum(spark, paths, dim, now)
    present = {n: paths.processed(n) for n in ("sentiment", "anomalies", "momentum")
               if readers.exists(spark, paths.processed(n))}
    if present:
        out["status"] = sinks.dataset_status(spark, present)
    return out
