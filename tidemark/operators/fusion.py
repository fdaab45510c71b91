"""Relating anomalies to the news and posts around them in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import asof

# Polarity from which a text explains an anomaly, and below which it says nothing.
STRONG, NEUTRAL = 0.45, 0.10
BREAKOUTS = ("volume_surge", "price_volume_spike")
# Fixed values end.


def _day(ts: Column) -> Column:
    return F.to_date(ts)


def _near(anomalies: DataFrame, events: DataFrame, before: int, after: int) -> DataFrame:
    """Pairs with event_ts in [t - before h, t + after h]: equality on ticker and
    day for the days the span touches, then the exact bounds."""
    t = F.col("anomaly_date").cast("timestamp")
    low, high = t - F.make_dt_interval(hours=F.lit(before)), t + F.make_dt_interval(hours=F.lit(after))
    spans = anomalies.withColumns({"_low": low, "_high": high}).withColumn(
        "_day", F.explode(F.sequence(_day(F.col("_low")), _day(F.col("_high"))))
    )
    e = events.withColumn("_day", _day(F.col("event_ts")))
    return spans.join(e, ["ticker", "_day"]).filter(F.col("event_ts").between(F.col("_low"), F.col("_high"))).drop(
        "_day", "_low", "_high")


def align_events(anomalies: DataFrame, events: DataFrame, hours: int = 24) -> DataFrame:
    """Every text event within ± hours of an anomaly of its ticker."""
    return _near(anomalies, events, hours, hours)


def classify_context(anomalies: DataFrame, events: DataFrame, hours: int = 24) -> DataFrame:
    """news, retail, structural or unexplained, for every anomaly.

    Only the strongest polarity per source matters, so events are reduced to
    one row per ticker, second and source before they meet the anomalies; a
    ticker with very many texts then holds at most one row per second and source.
    """
    strongest = events.groupBy("ticker", F.date_trunc("second", "event_ts").alias("event_ts"), "source_type").agg(
        F.max(F.abs("sentiment_score")).alias("_p"))
    keys = ["ticker", "anomaly_date"]
    near = _near(anomalies.select(*keys), strongest, hours, hours).groupBy(*keys).agg(
        F.max(F.when(F.col("source_type") == "news", F.col("_p"))).alias("news_polarity"),
        F.max(F.when(F.col("source_type") == "reddit", F.col("_p"))).alias("retail_polarity"),
        F.max("_p").alias("max_polarity"),
    )
    label = (
        F.when(F.col("news_polarity") >= STRONG, "news")
        .when(F.col("retail_polarity") >= STRONG, "retail")
        .when(F.coalesce("max_polarity", F.lit(0.0)) < NEUTRAL, "structural")
        .otherwise("unexplained")
    )
    return anomalies.join(near, keys, "left").withColumn("context", label)


def association_rate(classified: DataFrame) -> DataFrame:
    """Share of anomalies that news or posts explain."""
    linked = F.col("context").isin("news", "retail")
    return classified.agg(
        F.count("*").alias("anomalies"), F.count_if(linked).alias("associated"),
        F.avg(linked.cast("double")).alias("association_rate"),
    )


def directional_accuracy(joined: DataFrame) -> DataFrame:
    """Share of bars with a sentiment whose sign is that of the return."""
    both = joined.filter(F.col("sentiment_avg").isNotNull() & F.col("daily_return").isNotNull())
    same = F.signum("sentiment_avg") == F.signum("daily_return")
    return both.agg(
        F.count("*").alias("observations"), F.count_if(same).alias("matching"),
        F.avg(same.cast("double")).alias("accuracy"),
    )


def sentiment_lead(events: DataFrame, anomalies: DataFrame, max_hours: int | None = 48, hot_rows: int | None = asof.HOT_ROWS) -> DataFrame:
    """Hours from the last social post to the volume breakout it precedes, if it came at most `max_hours` before (None: ever)."""
    posts = events.filter(F.col("source_type") == "reddit").select("ticker", "event_ts")
    broke = anomalies.filter(F.col("anomaly_type").isin(*BREAKOUTS)).select("ticker", "anomaly_date")
    found = asof.last_before(broke, posts, "ticker", "anomaly_date", "event_ts", hot_rows=hot_rows).withColumnRenamed("last_event_ts", "last_event")
    gap = F.unix_timestamp(F.col("anomaly_date").cast("timestamp")) - F.unix_timestamp("last_event")
    lead = found.filter(F.col("last_event").isNotNull()).withColumn("lead_hours", gap / 3600.0)
    if max_hours is None:
        return lead
    first = F.col("anomaly_date").cast("timestamp") - F.make_dt_interval(hours=F.lit(max_hours))
    return lead.filter(F.col("last_event") >= first)
