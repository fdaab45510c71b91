"""Sector momentum from blended sentiment and from prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import align, series
from tidemark.session import materialize

WINDOWS = (30, 60, 90)


def all_momentum(daily: DataFrame, windows: tuple[int, ...] = WINDOWS, strict: bool = False) -> DataFrame:
    """Rolling z-score of daily sector sentiment for several window lengths.

    All windows share one partitioning and one sort; the result goes to long
    form with one explode. `daily` has one row per sector and day, so a
    window partition is bounded by the calendar.

    Strict: the deviation needs 5 values, the sector 5 days, and the ticker
    count is the day's own instead of the rolling mean.
    """
    spec = Window.partitionBy("sector").orderBy("date")
    days = F.count("*").over(Window.partitionBy("sector")).alias("_days")
    value, need = "sector_avg_sentiment", 5 if strict else 1
    frames = []
    for n in windows:
        frame = series.last_rows(spec, n)
        tickers = F.col("ticker_count") if strict else F.avg("ticker_count").over(frame)
        frames.append(F.struct(
            F.lit(n).alias("window_days"),
            F.avg(value).over(frame).alias("mean"),
            series.when_enough(F.stddev_samp(value), value, spec, n, need).alias("std"),
            tickers.cast("int").alias("ticker_count"),
        ).alias(f"_w{n}"))
    wide = daily.select("sector", "date", value, days, *frames)
    if strict:
        wide = wide.filter(F.col("_days") >= 5)
    long = wide.select("sector", "date", value, F.explode(F.array(*[f"_w{n}" for n in windows])).alias("w"))
    z = F.when(F.col("w.std") > 0, (F.col(value) - F.col("w.mean")) / F.col("w.std")).otherwise(F.lit(0.0))
    return long.select(
        "sector", F.col("w.window_days").alias("window_days"), z.alias("momentum_score"),
        F.col("w.mean").alias("avg_sentiment"), F.col("w.ticker_count").alias("ticker_count"),
        S.start_date(F.col("date"), F.col("w.window_days")).alias("start_date"), F.col("date").alias("end_date"),
    )


def sector_momentum(daily: DataFrame, n: int, strict: bool = False) -> DataFrame:
    return all_momentum(daily, (n,), strict)


def price_momentum(prices: DataFrame, dim: DataFrame, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """Mean n-row price return over the tickers of a sector, per day."""
    spec = series.series()
    moved = align.with_sector(
        prices.select("ticker", "trade_date", *[
            S.simple_return(F.col("close_price"), F.lag("close_price", n).over(spec)).alias(f"m{n}") for n in windows
        ]), dim)
    return moved.groupBy("sector", "trade_date").agg(*[F.avg(f"m{n}").alias(f"momentum_{n}") for n in windows])


def latest_momentum(momentum: DataFrame) -> DataFrame:
    """Rows of the latest end date, ordered by sector and window."""
    last = momentum.agg(F.max("end_date")).scalar()
    return momentum.filter(F.col("end_date") == last).orderBy("sector", "window_days")


def momentum_matrix(momentum: DataFrame, window: int, dates: list[str] | None = None) -> DataFrame:
    """Mean score per sector and end date; wide for an explicit list of dates."""
    rows = momentum.filter(F.col("window_days") == window)
    if dates is None:
        return rows.groupBy("sector", "end_date").agg(F.avg("momentum_score").alias("momentum_score"))
    day = F.date_format("end_date", "yyyy-MM-dd")
    return (
        rows.withColumn("_day", day).filter(F.col("_day").isin(dates))
        .groupBy("sector").pivot("_day", dates).agg(F.avg("momentum_score"))
    )


#: End dates that a wide table may have as columns.
MOST_COLUMNS = 2_000


def momentum_pivot(momentum: DataFrame, window: int, most: int = MOST_COLUMNS) -> DataFrame:
    """One row per sector and one column per end date, named by the day, with the mean score.

    First the dates, by a job that brings at most `most` + 1 of them; more raise. Then one aggregate into rows of that width.
    """
    momentum = materialize(momentum.filter(F.col("window_days") == window), "momentum")  # read for the dates and for the table
    day = F.date_format("end_date", "yyyy-MM-dd").alias("day")
    days = momentum.filter(F.col("end_date").isNotNull()).select(day).distinct().orderBy("day").limit(most + 1).collect()
    if len(days) > most:
        raise ValueError(f"more than {most} end dates; narrow the span or use momentum_matrix, which is long")
    return momentum_matrix(momentum, window, [r["day"] for r in days])


def latest_per_sector(momentum: DataFrame, window: int) -> DataFrame:
    """The newest row of every sector, by rising score."""
    row = F.max_by(F.struct("end_date", "momentum_score", "avg_sentiment", "ticker_count"), "end_date").alias("r")
    return (
        momentum.filter(F.col("window_days") == window).groupBy("sector").agg(row)
        .select("sector", "r.*").orderBy("momentum_score", "sector")
    )
