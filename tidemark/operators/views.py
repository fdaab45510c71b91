"""The interactive queries: summaries, rankings, peers and replays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import align, series
from tidemark.operators.clean import filter_basket, filter_view


def price_summary(prices: DataFrame) -> DataFrame:
    """Latest close, its change, high, low and mean volume of every ticker.

    The extremes combine map-side and the last two rows per ticker are kept
    before the shuffle, so series of any length do.
    """
    spans = prices.groupBy("ticker").agg(
        F.max("high_price").alias("high"), F.min("low_price").alias("low"), F.avg("volume").alias("avg_volume"))
    last = series.nth_from_end(prices, 2)
    change = S.simple_return(F.col("latest"), F.col("nth_value")) * 100
    return spans.join(last, "ticker").select(
        "ticker", F.col("latest").alias("latest_close"), F.coalesce(change, F.lit(0.0)).alias("change_pct"),
        "high", "low", "avg_volume")


def peer_table(prices: DataFrame, anomalies: DataFrame, dim: DataFrame, ticker: str | None = None,
               rows: int = 30) -> DataFrame:
    """Price, return over the last rows and anomaly count of the tickers of one
    sector, or of every known ticker when none is selected."""
    known = align.peers(dim, ticker) if ticker else dim.select("ticker", "sector")
    bars = prices.join(align.small(known), "ticker")
    tail = series.nth_from_end(bars, rows).filter(F.col("rows_seen") >= 2)
    counts = anomalies.groupBy("ticker").agg(F.count("*").alias("n"))
    moved = F.coalesce(S.simple_return(F.col("latest"), F.col("nth_value")) * 100, F.lit(0.0))
    status = F.when(F.col("ticker") == F.lit(ticker), "Selected").otherwise("Peer")
    return (
        tail.join(align.small(known), "ticker").join(counts, "ticker", "left")
        .select(
            "ticker", "sector", S.round_even(F.col("latest"), 2).alias("current_price"), S.round_even(moved, 2).alias("return_pct"),
            F.coalesce("n", F.lit(0)).alias("total_anomalies"), status.alias("status"),
        )
        .orderBy(F.desc("return_pct"), "ticker")
    )


def top_anomalies(anomalies: DataFrame, k: int = 10) -> DataFrame:
    return anomalies.orderBy(F.desc("anomaly_score"), "ticker", "anomaly_date").limit(k)


def recent_anomalies(anomalies: DataFrame, k: int = 10) -> DataFrame:
    return anomalies.orderBy(F.desc("anomaly_date"), F.desc("anomaly_score"), "ticker").limit(k)


def top_shocks(anomalies: DataFrame, ticker: str | None = None, k: int = 8) -> DataFrame:
    """The strongest anomalies of one ticker, or of each."""
    order = [F.desc("anomaly_score"), F.col("anomaly_date")]
    if ticker:
        return anomalies.filter(F.col("ticker") == ticker).orderBy(*order).limit(k)
    return series.top_per_key(anomalies, ["ticker"], order, k)


def ordered(df: DataFrame, keys: list) -> DataFrame:
    return df.orderBy(*keys)


# --- pages -------------------------------------------------------------------------------

def overview(prices, sentiments, anomalies, momentum, universe, start=None, end=None, kind="All") -> dict[str, DataFrame]:
    from tidemark.operators.aggregates import overview_kpis

    p = filter_view(prices, "trade_date", start=start, end=end)
    s = filter_view(sentiments, "event_date", start=start, end=end)
    a = filter_view(anomalies, "anomaly_date", start=start, end=end, kind=kind)
    return {
        "kpis": overview_kpis(p, s, a, universe),
        "recent": recent_anomalies(a),
        "sectors": ordered(momentum.filter(F.col("window_days") == 30), ["momentum_score", "sector", "end_date"]),
    }


def ticker_detail(ticker, prices, sentiments, anomalies, start=None, end=None, candles: int = 500) -> dict[str, DataFrame]:
    from tidemark.operators.aggregates import daily_sentiment, sentiment_summary
    from tidemark.operators.anomaly import stored_or_dynamic

    p = filter_view(prices, "trade_date", ticker, start, end)
    s = filter_view(sentiments, "event_date", ticker, start, end)
    a = filter_view(stored_or_dynamic(anomalies, p, ticker), "anomaly_date", start=start, end=end)
    return {
        "summary": price_summary(p),
        "candles": ordered(series.tail_per_ticker(p, candles), ["trade_date"]),
        "anomalies": ordered(a, ["anomaly_date"]),
        "daily_sentiment": daily_sentiment(s),
        "sentiment_summary": sentiment_summary(s),
    }


def heatmap(momentum, prices, anomalies, dim, window: int = 30, ticker: str | None = None) -> dict[str, DataFrame]:
    from tidemark.operators.momentum import latest_per_sector, momentum_matrix

    out = {"matrix": momentum_matrix(momentum, window), "latest": latest_per_sector(momentum, window)}
    if ticker:
        out["peers"] = peer_table(prices, anomalies, dim, ticker)
    return out


def replay(prices, anomalies, tickers: list[str], start: str, end: str) -> dict[str, DataFrame]:
    """Normalised prices and anomalies of a basket during a market event."""
    return {
        "relative": series.base100(filter_basket(prices, tickers, "trade_date", start, end)),
        "anomalies": ordered(filter_basket(anomalies, tickers, "anomaly_date", start, end),
                             [F.desc("anomaly_date"), "ticker"]),
    }


def shock_replay(prices, anomalies, ticker: str | None = None, days: int = 25, k: int = 8) -> DataFrame:
    shocks = top_shocks(anomalies, ticker, k).withColumnRenamed("anomaly_date", "trade_date")
    return align.shock_window(prices, shocks, days)
