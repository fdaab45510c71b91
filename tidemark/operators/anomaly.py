"""Price and volume anomalies: weighted score and rolling z-score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import align, series
from tidemark.operators.aggregates import daily_sentiment

OUTPUT = ["ticker", "anomaly_date", "close_price", "volume", "anomaly_score", "anomaly_type",
          "sentiment_avg", "description"]


def score_anomalies(featured: DataFrame) -> DataFrame:
    """Score and type every featured bar, without dropping any.

    Fixed values: weights 0.6 and 0.4, volatility floor 0.0001 with stand-in 0.01,
    ratio 1 when unknown, three decimals.
    """
    spread = F.when(F.col("volatility_7d") > 0.0001, F.col("volatility_7d")).otherwise(F.lit(0.01))
    score = F.abs("daily_return") / spread * 0.6 + F.coalesce("volume_ratio", F.lit(1.0)) * 0.4
    return featured.withColumns({
        "anomaly_score": F.round(score, 3),
        "anomaly_type": S.anomaly_type(F.col("daily_return"), F.col("volume_ratio")),
    })


def detect_anomalies(prices: DataFrame, **kw) -> DataFrame:
    """Bars with a high score, a big move or a volume surge."""
    unusual = (
        (F.col("anomaly_score") > S.KEEP_SCORE)
        | (F.abs("daily_return") > S.KEEP_MOVE)
        | (F.col("volume_ratio") > S.SURGE_RATIO)
    )
    return score_anomalies(series.features(prices, **kw)).filter(unusual)


def correlate_sentiment(anomalies: DataFrame, sentiments: DataFrame | None) -> DataFrame:
    """Attach the day's mean sentiment and a description to each anomaly."""
    if sentiments is None:
        out = anomalies.withColumns({
            "sentiment_avg": F.lit(None).cast("double"),
            "description": F.lit("No sentiment data available"),
        })
    else:
        out = align.correlate_daily(anomalies, daily_sentiment(sentiments)).withColumn(
            "description",
            S.describe(F.col("daily_return"), F.col("volume_ratio"), F.col("sentiment_avg"), F.col("anomaly_type")),
        )
    return out.withColumnRenamed("trade_date", "anomaly_date")


def divergences(anomalies: DataFrame, sentiments: DataFrame) -> DataFrame:
    """As correlate_sentiment, with divergences as a type of their own."""
    ret, ratio, mood, kind = (F.col(c) for c in ("daily_return", "volume_ratio", "sentiment_avg", "anomaly_type"))
    out = align.correlate_daily(anomalies, daily_sentiment(sentiments))
    return out.withColumns({
        "description": S.describe(ret, ratio, mood, kind, advice=""),
        "anomaly_type": S.divergence_type(ret, mood, kind),
    }).withColumnRenamed("trade_date", "anomaly_date")


def detect_zscore(prices: DataFrame, **kw) -> DataFrame:
    """On-the-fly detector: |z| or volume ratio above 2 (strict)."""
    bars = prices.dropna(subset=["trade_date", "close_price"])
    z, ratio = F.col("z_score"), F.col("volume_ratio")
    surge, spike = ratio > S.SPIKE_RATIO, F.abs(z) > 2.0
    kind = F.when(surge & spike, "price_volume_spike").when(surge, "volume_surge").otherwise("price_spike")
    ret = F.coalesce("daily_return", F.lit(0.0))
    return (
        series.zscore_features(series.min_history(bars, 5), **kw)
        .filter(surge | spike)
        .withColumn("anomaly_type", kind)
        .select(
            "ticker", F.col("trade_date").alias("anomaly_date"), "close_price", "volume",
            S.round_even(F.greatest(ratio, F.abs(z)), 2).alias("anomaly_score"), "anomaly_type",
            F.lit(0.0).alias("sentiment_avg"),
            F.concat(
                S.title_code(F.col("anomaly_type")), F.lit(": return="), S.signed_pct(ret),
                F.lit(", vol_ratio="), S.fixed(ratio, 1), F.lit("x"),
            ).alias("description"),
        )
    )


def stored_or_dynamic(anomalies: DataFrame, prices: DataFrame, ticker: str | None = None) -> DataFrame:
    """Stored anomalies; for tickers that have none, those of the z-score detector."""
    if ticker:
        anomalies = anomalies.filter(F.col("ticker") == ticker)
        prices = prices.filter(F.col("ticker") == ticker)
    unknown = prices.join(anomalies.select("ticker").distinct(), "ticker", "left_anti")
    return anomalies.unionByName(detect_zscore(unknown), allowMissingColumns=True)


def lookup_anomalies(anomalies: DataFrame, ticker: str, n: int = 200) -> DataFrame:
    return anomalies.filter(F.col("ticker") == ticker).orderBy("anomaly_date").limit(n)
