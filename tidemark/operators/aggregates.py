"""Grouped summaries. All combine map-side, so hot keys arrive pre-aggregated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S


def daily_sentiment(df: DataFrame, by_source: bool = False) -> DataFrame:
    """Mean score and number of texts per ticker and day."""
    keys = ["ticker", F.to_date("event_date").alias("event_day")] + (["source_type"] if by_source else [])
    return df.groupBy(*keys).agg(
        F.avg("sentiment_score").alias("daily_sentiment"), F.count("*").alias("article_count")
    )


def daily_ticker_sentiment(df: DataFrame) -> DataFrame:
    return df.groupBy("ticker", F.to_date("event_date").alias("trade_date")).agg(
        F.avg("sentiment_score").alias("avg_sentiment"),
        F.count("*").alias("article_count"),
        F.count_if(F.col("sentiment_label") == "positive").alias("positive_count"),
        F.count_if(F.col("sentiment_label") == "negative").alias("negative_count"),
    )


def daily_sector(df: DataFrame, strict: bool = False) -> DataFrame:
    """Mean blended sentiment per sector and day. Strict counts only rows with a value."""
    counted = F.count("blended_sentiment") if strict else F.count("*")
    return df.groupBy("sector", F.col("trade_date").alias("date")).agg(
        F.avg("blended_sentiment").alias("sector_avg_sentiment"),
        counted.alias("sector_article_count"),
        F.countDistinct("ticker").alias("ticker_count"),
    )


def daily_news_volume(df: DataFrame) -> DataFrame:
    return df.groupBy("ticker", F.col("published_date").alias("event_date")).agg(F.count("*").alias("article_count"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count"))


def sentiment_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("ticker").agg(
        F.count("*").alias("articles"),
        F.avg("sentiment_score").alias("avg_score"),
        F.count_if(F.col("sentiment_label") == "positive").alias("positive"),
        F.count_if(F.col("sentiment_label") == "negative").alias("negative"),
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted non-blank values for a picker."""
    value = F.col(column).cast("string")
    return df.filter(F.length(F.trim(value)) > 0).select(value.alias(column)).distinct().orderBy(column)


def symbol_universe(*frames: DataFrame) -> DataFrame:
    """Distinct cleaned tickers over several frames, without the catch-all key."""
    from tidemark.functions.clean import GENERAL, clean_symbol

    out = None
    for frame in frames:
        part = frame.select(clean_symbol(F.col("ticker")).alias("ticker")).distinct()
        out = part if out is None else out.union(part)
    return out.filter((F.col("ticker") != "") & (F.col("ticker") != GENERAL)).distinct()


def top_tickers(df: DataFrame, k: int = 10) -> DataFrame:
    """Most covered tickers with their mean sentiment."""
    counts = df.groupBy("ticker").agg(
        F.count("*").alias("article_count"), F.avg("sentiment_score").alias("avg_sentiment")
    )
    return counts.orderBy(F.desc("article_count"), "ticker").limit(k)


def divergence_count(anomalies: DataFrame, sentiments: DataFrame | None = None, guess: bool = False) -> Column:
    """Number of divergences as an aggregate over `anomalies`.

    Counted by type or description; if there is none, by |sentiment| of at
    least the mood band. `guess` allows the last resort of one per ten scores.
    """
    def told(name: str) -> Column:
        return S.mentions(F.col(name), "divergence") if name in anomalies.columns else F.lit(False)

    named = F.count_if(told("anomaly_type") | told("description"))
    moody = F.lit(0).cast("bigint")
    if "sentiment_avg" in anomalies.columns:
        moody = F.count_if(F.abs(F.coalesce("sentiment_avg", F.lit(0.0))) >= S.KPI_BAND)
    count = F.when(named > 0, named).otherwise(moody)
    if guess and sentiments is not None:
        scores = sentiments.agg(F.count("*")).scalar()
        invented = F.greatest(F.lit(1), F.least(F.count("*"), F.floor(scores / 10)))
        count = F.when((count == 0) & (scores > 0) & (F.count("*") > 0), invented).otherwise(count)
    return count


def overview_kpis(prices: DataFrame, sentiments: DataFrame, anomalies: DataFrame, universe: DataFrame) -> DataFrame:
    """One row: tickers tracked, mean sentiment and mood, anomalies, divergences.

    Each input is aggregated on its own; the single values meet as scalar subqueries.
    """
    known = universe.agg(F.count("*").alias("n")).scalar()
    seen = prices.agg(F.countDistinct("ticker").alias("n")).scalar()
    mean = sentiments.agg(F.avg("sentiment_score").alias("m")).scalar()
    return anomalies.agg(
        F.count("*").alias("anomalies"), divergence_count(anomalies).alias("divergences")
    ).select(
        F.greatest(known, seen).alias("stocks_tracked"),
        mean.alias("avg_sentiment"),
        S.market_mood(mean).alias("mood"),
        "anomalies", "divergences",
    )
