"""Joins of prices, news, sentiment and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import series

BROADCAST_ROWS = 100_000


def small(dim: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a dimension of at most `rows` rows; a bigger one is left
    to a shuffled join, where AQE splits hot keys.

    The check reads at most rows + 1 rows of the dimension.
    """
    return F.broadcast(dim) if dim.limit(rows + 1).count() <= rows else dim


def _of_day(bars: DataFrame, daily: DataFrame) -> DataFrame:
    """Bars of any time of day with what daily(ticker, _day, ...) holds of their day."""
    return bars.withColumn("_day", F.to_date("trade_date")).join(daily, ["ticker", "_day"], "left").drop("_day")


def news_price_aligned(news: DataFrame, prices: DataFrame, how: str = "inner") -> DataFrame:
    """News rows (one per ticker) next to the bar of the same day. `how="full"`
    keeps days without news and news on days without trading."""
    n = news.select("ticker", F.col("published_date").alias("event_date"),
                    F.col("source").alias("news_source"), F.col("title").alias("headline"), "summary")
    p = prices.select("ticker", F.col("trade_date").alias("event_date"),
                      "close_price", "volume", "high_price", "low_price")
    return n.join(p, ["ticker", "event_date"], how)


def price_sentiment_joined(prices: DataFrame, daily: DataFrame) -> DataFrame:
    """All bars with the day's sentiment and the change from the bar before in percent."""
    moved = series.daily_return(prices.select("ticker", "trade_date", "close_price", "volume"))
    of_day = daily.withColumn("_day", F.to_date("trade_date")).drop("trade_date")
    return (
        _of_day(moved.withColumn("price_change_pct", F.col("daily_return") * 100), of_day)
        .select("ticker", "trade_date", "close_price", "volume", "avg_sentiment", "article_count", "price_change_pct")
    )


def blend_sentiment(prices: DataFrame, daily: DataFrame | None, **kw) -> DataFrame:
    """Real sentiment of the day where there is some, else the price proxy."""
    bars = series.daily_return(prices.select("ticker", "trade_date", "close_price"), **kw).withColumn(
        "price_sentiment", S.price_proxy(F.col("daily_return"))
    )
    if daily is None:
        return bars.withColumn("real_sentiment", F.lit(None).cast("double")).withColumn(
            "blended_sentiment", F.col("price_sentiment"))
    real = daily.select("ticker", F.to_date("event_day").alias("_day"), F.col("daily_sentiment").alias("real_sentiment"))
    return _of_day(bars, real).withColumn(
        "blended_sentiment", F.coalesce("real_sentiment", "price_sentiment")
    )


def with_sector(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Sector of the ticker, `Other` when the dimension does not know it."""
    return df.join(small(dim.select("ticker", "sector")), "ticker", "left").withColumn(
        "sector", F.coalesce("sector", F.lit("Other"))
    )


def correlate_daily(anomalies: DataFrame, daily: DataFrame) -> DataFrame:
    """Anomalies with the mean sentiment of their day."""
    same_day = daily.select("ticker", F.to_date("event_day").alias("_day"), F.col("daily_sentiment").alias("sentiment_avg"))
    return _of_day(anomalies, same_day)


def sector_of(dim: DataFrame, ticker: str):
    """The sector of one ticker as a scalar subquery."""
    return dim.filter(F.col("ticker") == ticker).agg(F.max("sector")).scalar()


def peers(dim: DataFrame, ticker: str) -> DataFrame:
    """All tickers in the sector of one ticker, itself included."""
    return dim.filter(F.col("sector") == sector_of(dim, ticker)).select("ticker", "sector")


def shock_window(prices: DataFrame, shocks: DataFrame, days: int = 25) -> DataFrame:
    """Bars from `days` calendar days before to `days` after each shock.

    Each shock meets the two day blocks its window can touch by equality, the
    exact bounds are a residual filter; no ticker-wide pairing takes place.
    """
    width = 2 * days + 1
    def block(day):
        return F.floor(F.unix_date(day) / width)
    spans = shocks.select("ticker", F.col("trade_date").alias("shock_date")).distinct().withColumn(
        "_block",
        F.explode(F.array_distinct(F.array(
            block(F.date_sub("shock_date", days)), block(F.date_add("shock_date", days))
        ))),
    )
    bars = prices.withColumn("_block", block(F.to_date("trade_date")))
    inside = F.col("trade_date").between(F.date_sub("shock_date", days), F.date_add("shock_date", days))
    return bars.join(spans, ["ticker", "_block"]).filter(inside).drop("_block")
