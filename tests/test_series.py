"""Windows: edge frames, brute force in pandas, and split hot series."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import anomaly, forest, momentum, series
from tidemark.plans import fixtures as fx

DAY = dt.date(2024, 1, 1)


def bars(spark, closes, volumes=None, ticker="A", spread=0.0):
    rows = [(ticker, DAY + dt.timedelta(days=i), c, c + spread, c - spread, c, v)
            for i, (c, v) in enumerate(zip(closes, volumes or [100.0] * len(closes)))]
    return spark.createDataFrame(
        rows, "ticker string, trade_date date, open_price double, high_price double, low_price double, "
              "close_price double, volume double")


def listed(df, column):
    return [r[0] for r in df.orderBy("trade_date").select(column).collect()]


def test_first_row_and_zero_previous_close(spark):
    out = series.daily_return(bars(spark, [10.0, 0.0, 5.0, 6.0]))
    assert listed(out, "daily_return") == [None, -1.0, None, pytest.approx(0.2)]


def test_zero_volume_window_gives_no_ratio(spark):
    assert listed(series.volume_features(bars(spark, [1.0, 2.0], [0.0, 0.0])), "volume_ratio") == [None, None]


def test_constant_price_has_zero_deviation_and_score_uses_stand_in(spark):
    out = anomaly.score_anomalies(series.features(bars(spark, [10.0] * 6)))
    assert set(listed(out, "volatility_7d")) == {0.0}
    assert set(listed(out, "anomaly_score")) == {0.4}
    z = series.zscore_features(bars(spark, [10.0] * 8))
    assert set(listed(z, "z_score")) == {0.0}


def test_features_match_pandas(spark, sf):
    got = series.features(fx.bars(spark, sf), (7, 20)).toPandas().sort_values(["ticker", "trade_date"])
    pdf = fx.bars(spark, sf).toPandas().sort_values(["ticker", "trade_date"])
    by = pdf.groupby("ticker")
    pdf["daily_return"] = by["close_price"].pct_change()
    def roll(column, n, how):
        return by[column].transform(lambda s: getattr(s.rolling(n, min_periods=1), how)())
    pdf["sma_7"], pdf["sma_20"] = roll("close_price", 7, "mean"), roll("close_price", 20, "mean")
    pdf["volume_ratio"] = pdf["volume"] / roll("volume", 20, "mean")
    pdf["volatility_7d"], pdf["volatility_20d"] = roll("daily_return", 7, "std"), roll("daily_return", 20, "std")
    pdf = pdf.dropna(subset=["daily_return", "volatility_7d"])
    assert len(got) == len(pdf)
    for column in ("daily_return", "sma_7", "sma_20", "volume_ratio", "volatility_7d", "volatility_20d"):
        np.testing.assert_allclose(got[column].to_numpy(), pdf[column].to_numpy(), atol=1e-9)


@pytest.mark.parametrize("hot_rows", [25, 60, 200])
@pytest.mark.parametrize("grain", ["hour", "day"])
def test_split_hot_series_equals_plain_window(spark, sf, hot_rows, grain):
    """One ticker holds a third of all rows; pieces must not change any value."""
    df = fx.intraday(spark, sf)
    hot = df.filter(F.pmod(F.hash("trade_date"), F.lit(3)) == 0).withColumn("ticker", F.lit("HOT"))
    df = df.unionByName(hot)
    plain = series.features(df)
    split = series.features(df, hot_rows=hot_rows, grain=grain)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.select(*plain.columns).collect()))
    pieces = series.split_hot(df, "ticker", "trade_date", 21, hot_rows, grain).filter("ticker = 'HOT'")
    assert pieces.select("_piece").distinct().count() > 1


def test_a_map_of_many_cells_is_not_sent_to_every_task(spark):
    rows = series.BROADCAST_CELLS + 20_000
    hours = F.timestamp_seconds(F.floor(F.col("id") / 40) * 3_600)
    ticks = spark.range(rows).select((F.col("id") % 40).cast("string").alias("ticker"), hours.alias("trade_date"), F.col("id").cast("double").alias("close_price"))
    cut = series.daily_return(ticks, hot_rows=30)
    assert "Broadcast" not in cut._jdf.queryExecution().simpleString()
    assert cut.exceptAll(series.daily_return(ticks)).isEmpty() and cut.count() == rows


def test_tasks_of_a_window_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(series, "TASK_ROWS", 1_000)
    ticks = spark.range(20_000).select((F.col("id") % 400).cast("string").alias("ticker"), F.timestamp_seconds("id").alias("trade_date"), F.col("id").cast("double").alias("close_price"))
    cut = series.daily_return(ticks, hot_rows=30)
    assert cut.rdd.getNumPartitions() == 20 and cut.exceptAll(series.daily_return(ticks)).isEmpty()


def test_strict_features_are_computed_once(spark, sf):
    plan = series.strict_features(fx.bars(spark, sf))._jdf.queryExecution().simpleString()
    assert "Window" not in plan and "lineitem" not in plan


def test_tasks_of_the_forest_follow_the_rows(spark, sf, monkeypatch):
    featured = series.full_windows(fx.bars(spark, sf)).localCheckpoint()
    want = {tuple(r) for r in forest.forest_scores(featured, 5).collect()}
    monkeypatch.setattr(forest, "SCORED_ROWS", 100)
    dealt = forest.forest_scores(featured, 5, rows=5_000)
    assert dealt.where("raw_score > 0").rdd.getNumPartitions() >= 50 and {tuple(r) for r in dealt.collect()} == want


def test_split_needs_room_for_the_look_back(spark, sf):
    with pytest.raises(ValueError):
        series.features(fx.intraday(spark, sf), hot_rows=5)


@pytest.mark.parametrize("rows,kept", [(4, 0), (5, 5), (29, 0), (30, 30)])
def test_min_history(spark, rows, kept):
    need = 5 if rows < 10 else 30
    assert series.min_history(bars(spark, [1.0] * rows), need).count() == kept


def test_rolling_waits_for_min_periods(spark):
    out = series.rolling(bars(spark, [1.0, 2.0, 3.0, 4.0]), "close_price", 3)
    assert listed(out, "rolling_mean") == [None, None, 2.0, 3.0]
    out = series.rolling(bars(spark, [1.0, 2.0, 3.0]), "close_price", 3, 2)
    assert listed(out, "rolling_mean") == [None, 1.5, 2.0]


def test_strict_features_need_thirty_rows_twice(spark):
    short = [10.0 + (i % 7) * 0.1 for i in range(45)]
    assert series.strict_features(bars(spark, short)).count() == 0  # 26 rows left after full windows
    enough = [10.0 + (i % 7) * 0.1 for i in range(60)]
    assert series.strict_features(bars(spark, enough)).count() == 41


def test_thresholds_are_strict(spark):
    from tidemark.functions import scalars as S

    df = spark.createDataFrame([(0.03, 2.0), (0.031, 2.0), (0.031, 2.1), (0.0, 2.5), (0.0, 2.51)], "r double, v double")
    kinds = [r[0] for r in df.select(S.anomaly_type(F.col("r"), F.col("v"))).collect()]
    assert kinds == ["statistical_outlier", "price_spike", "price_volume_spike", "statistical_outlier", "volume_surge"]
    proxies = df.sparkSession.createDataFrame([(0.01,), (0.011,), (-0.01,), (-0.011,), (None,)], "r double")
    assert [r[0] for r in proxies.select(S.price_proxy(F.col("r"))).collect()] == [0.0, 1.0, 0.0, -1.0, 0.0]
    labels = df.sparkSession.createDataFrame([(0.1,), (0.11,), (-0.1,), (-0.11,), (None,)], "r double")
    assert [r[0] for r in labels.select(S.sentiment_label(F.col("r"))).collect()] == [
        "neutral", "positive", "neutral", "negative", "neutral"]


def test_base100_skips_non_positive_start(spark):
    df = bars(spark, [2.0, 3.0]).unionByName(bars(spark, [0.0, 3.0], ticker="B"))
    assert sorted((r.ticker, r.normalized_return) for r in series.base100(df).collect()) == [("A", 100.0), ("A", 150.0)]


def test_nth_from_end_falls_back_to_the_first(spark):
    row = series.nth_from_end(bars(spark, [1.0, 2.0, 3.0]), 30).first()
    assert (row.latest, row.nth_value, row.rows_seen) == (3.0, 1.0, 3)


def test_standardize_constant_column(spark):
    out = series.standardize(bars(spark, [5.0, 5.0]), ["close_price"])
    assert listed(out, "close_price_z") == [0.0, 0.0]


def test_latest_versions_ttl(spark):
    rows = [("A", dt.datetime(2024, 1, d), d) for d in range(1, 11)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v int")
    as_of = F.lit("2024-01-10").cast("timestamp")
    out = series.latest_versions(df, ["k"], "ts", 5, 3 * 86_400, as_of)
    assert sorted(r.v for r in out.collect()) == [7, 8, 9, 10]


def test_momentum_strict_needs_five_days_and_values(spark):
    rows = [("X", DAY + dt.timedelta(days=i), float(i % 3), 4, 2 + i % 2) for i in range(8)]
    rows += [("Y", DAY + dt.timedelta(days=i), 1.0, 4, 2) for i in range(4)]
    daily = spark.createDataFrame(
        rows, "sector string, date date, sector_avg_sentiment double, sector_article_count int, ticker_count int")
    strict = momentum.sector_momentum(daily, 30, strict=True).toPandas().sort_values("end_date")
    assert set(strict["sector"]) == {"X"}
    x = pd.Series([float(i % 3) for i in range(8)])
    want = ((x - x.rolling(30, min_periods=1).mean()) / x.rolling(30, min_periods=5).std()).fillna(0.0)
    np.testing.assert_allclose(strict["momentum_score"], want)
    loose = momentum.all_momentum(daily, (30, 60))
    assert loose.filter("sector = 'Y'").agg(F.max(F.abs("momentum_score"))).first()[0] == 0.0
    assert loose.count() == 24
    wide = momentum.momentum_matrix(loose, 30, ["2024-01-01", "2024-01-02"])
    assert wide.columns == ["sector", "2024-01-01", "2024-01-02"]


def test_results_do_not_depend_on_partitions(spark, sf):
    base = fx.bars(spark, sf)
    want = None
    for n in (1, 2, 8):
        got = sorted(map(tuple, anomaly.detect_anomalies(base.repartition(n)).collect()))
        want = want or got
        assert got == want


@pytest.mark.parametrize("tie", [("volume", "close_price"), ()])
def test_one_second_of_a_hot_series_is_cut(spark, tie):
    """More rows at one time than a piece may hold: ranges of the tie column, or of the rows' hash, are the pieces."""
    from pyspark.sql import functions as F

    rows = spark.range(5_000).select(
        F.lit("HOT").alias("ticker"), F.timestamp_seconds(F.lit(1_700_000_000) + F.when(F.col("id") < 4_000, 0).otherwise(F.col("id") % 3)).alias("trade_date"),
        (100 + F.col("id") * 7919 % 1000 / 10).alias("close_price"), F.when(F.col("id") % 50 > 0, (F.col("id") * 104729 % 5000).cast("double")).alias("volume"),
        F.lit(1.0).alias("high_price"), F.lit(0.5).alias("low_price"))
    cut = series.split_hot(rows, "ticker", "trade_date", 20, 500, "hour", tie)
    sizes = {r["_piece"]: r["n"] for r in cut.filter("NOT _copy").groupBy("_piece").agg(F.count("*").alias("n")).collect()}
    assert len(sizes) >= 8 and sum(sizes.values()) == 5_000 and max(sizes.values()) <= 1_000
    if tie:
        plain = series.features(rows, tie=tie)
        split = series.features(rows, hot_rows=500, tie=tie)
        key = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.fillna(-1.0).collect())
        assert split.columns == plain.columns and key(split) == key(plain)


@pytest.mark.parametrize("hot_rows", [None, 40])
@pytest.mark.parametrize("same_time", [False, True])
def test_last_before_equals_brute_force(spark, hot_rows, same_time):
    """A hot key, ties within a side and between the sides, nulls, repeated rows."""
    import random
    from datetime import datetime, timedelta

    from tidemark.operators import asof

    draw, start = random.Random(3), datetime(2024, 1, 1)
    times = lambda n: [start + timedelta(seconds=draw.choice([0, 1, 1, 5, 3_600]) * draw.randrange(40)) for _ in range(n)]
    left = [(draw.choice("AAAB"), t, k) for k, t in enumerate(times(300))] + [("A", None, 900), (None, start, 901), ("C", start, 902)]
    left += left[:3]
    right = [(draw.choice("AAAB"), t, draw.randrange(9)) for t in times(200)] + [("A", None, 1), (None, start, 1)]
    got = asof.last_before(spark.createDataFrame(left, "ticker string, t timestamp, n int"),
                           spark.createDataFrame(right, "ticker string, s timestamp, v int"), "ticker", "t", "s", ("v",), same_time=same_time, hot_rows=hot_rows)
    want = []
    for k, t, n in left:
        seen = [(s, v) for j, s, v in right if j == k and k and s and t and (s < t or same_time and s == t)]
        want.append((k, t, n, *(max(seen) if seen else (None, None))))
    key = lambda r: tuple(str(x) for x in r)
    assert got.columns == ["ticker", "t", "n", "last_s", "last_v"] and sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Inner" not in plan or hot_rows
