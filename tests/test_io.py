"""Readers, writers, jobs, streaming, generators and the forest."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import anomaly, forest, series
from tidemark.plans import fixtures as fx
from tidemark.plans import jobs
from tidemark.sources import readers, sinks
from tidemark.streaming import ingest


def put(path, text, newline="\n"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as out:
        out.write(text.replace("\n", newline))


@pytest.fixture
def prices(tmp_path):
    root = f"{tmp_path}/raw/prices"
    put(f"{root}/a.csv", "Date,Close,High,Low,Open,Volume,Ticker,Exchange\n2024-01-01,10,12,9,11,100,AAA,NSE\nDate,Close,High,Low,Open,Volume,Ticker,Exchange\n2024-01-02,11,12,9,10,n/a,AAA,NSE\n")
    put(f"{root}/b.csv", "Date,Open,High,Low,Close,Adj Close,Volume,Ticker,Exchange\n2024-01-01 09:15:00,1,4,1,3,3.5,200,bbb,NSE\n", "\r\n")
    put(f"{root}/c.csv", "Date,Open,High,Low,Close,Volume,Ticker\n2024-01-03,5,8,5,7,300,CCC\n")
    return f"{tmp_path}"


def test_prices_bind_by_header_name(spark, prices):
    got = {(r.ticker, str(r.trade_date)): r for r in readers.read_prices(spark, f"{prices}/raw/prices").collect()}
    assert set(got) == {("AAA", "2024-01-01"), ("AAA", "2024-01-02"), ("bbb", "2024-01-01"), ("CCC", "2024-01-03")}
    a = got["AAA", "2024-01-01"]
    assert (a.open_price, a.high_price, a.low_price, a.close_price, a.volume, a.exchange) == (11, 12, 9, 10, 100, "NSE")
    assert got["AAA", "2024-01-02"].volume is None
    b = got["bbb", "2024-01-01"]
    assert (b.open_price, b.close_price, b.adj_close, b.volume, b.ts.hour, b.exchange) == (1, 3, 3.5, 200, 9, "NSE")
    assert (got["CCC", "2024-01-03"].close_price, got["CCC", "2024-01-03"].exchange) == (7, None)


def test_news_with_quotes_commas_and_both_headers(spark, tmp_path):
    put(f"{tmp_path}/n/a.csv", 'source,title,summary,published_date,link,matched_tickers,fetched_at\nX,"Up, ""really""","two\nlines","Tue, 05 Mar 2024 10:20:30 +0000",l1,"A,B",f\n')
    put(f"{tmp_path}/n/b.csv", "title,summary,link,published,source,matched_tickers,fetched_at\nT,S,l2,2024-03-06,Y,A,f\n")
    got = {r.link: r for r in readers.read_news(spark, f"{tmp_path}/n").collect()}
    assert (got["l1"].title, got["l1"].summary, got["l1"].matched_tickers) == ('Up, "really"', "two\nlines", "A,B")
    assert [str(got[k].published_date) for k in ("l1", "l2")] == ["2024-03-05", "2024-03-06"]


def test_reddit_types(spark, tmp_path):
    put(f"{tmp_path}/r/a.csv", "subreddit,post_id,title,selftext,score,upvote_ratio,num_comments,created_utc,author,url,matched_tickers,flair,fetched_at\n"
                               "s,p1,t,b,12,0.9,x,2024-01-01T00:00:00,a,u,GENERAL,,f\n")
    row = readers.read_reddit(spark, f"{tmp_path}/r").first()
    assert (row.score, row.upvote_ratio, row.num_comments, row.flair) == (12, 0.9, None, None)


def test_bad_lines(spark, tmp_path):
    put(f"{tmp_path}/d/a.csv", "a,b\n1,2\nx,3\n4,5,6,7\n")
    layout = "a int, b int"
    assert readers.read_dir(spark, f"{tmp_path}/d", layout, bad_lines="skip").collect()[0].a == 1
    assert readers.read_dir(spark, f"{tmp_path}/d", layout, bad_lines="skip").dropna().collect().__len__() == 1
    kept = readers.read_dir(spark, f"{tmp_path}/d", layout, bad_lines="keep").cache()
    assert kept.filter("_corrupt_record IS NOT NULL").count() == 2
    with pytest.raises(Exception):
        readers.read_dir(spark, f"{tmp_path}/d", layout, bad_lines="fail").collect()


def test_fallbacks(spark, tmp_path, prices):
    assert readers.read_or_empty(spark, f"{tmp_path}/none", schema.SENTIMENT).isEmpty()
    got = readers.read_first_available(spark, [f"{tmp_path}/none", f"{prices}/raw/prices/c.csv"], 10)
    assert got.count() == 1
    assert readers.read_first_available(spark, [f"{tmp_path}/none"]) is None
    put(f"{tmp_path}/dim.csv", "ticker,sector\nAAA.NS,IT\nBBB.NS, Banks\n")
    assert sorted(map(tuple, readers.ticker_dim(spark, f"{tmp_path}/dim.csv").collect())) == [("AAA", "IT"), ("BBB", "Banks")]


def test_sinks(spark, tmp_path, sf):
    bars = fx.bars(spark, sf)
    sinks.write_dataset(bars, f"{tmp_path}/three", files=3)
    assert len([f for f in os.listdir(f"{tmp_path}/three") if f.endswith(".parquet")]) == 3
    sinks.write_dataset(bars.withColumn("year", F.year("trade_date")), f"{tmp_path}/years", partition_by=["year"])
    assert "year=1996" in os.listdir(f"{tmp_path}/years")
    plan = spark.read.parquet(f"{tmp_path}/years").filter("year = 1996")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    one = readers.read_ticker(spark, f"{tmp_path}/three", "s1.NS")
    assert one.select("ticker").distinct().collect()[0].ticker == "S1"
    assert "EqualTo(ticker,S1)" in one._jdf.queryExecution().executedPlan().toString()
    sinks.write_dataset(bars.limit(5), f"{tmp_path}/csv", fmt="csv")
    status = {r.dataset: (r.files, r.rows) for r in sinks.dataset_status(spark, {"three": f"{tmp_path}/three"}).collect()}
    assert status == {"three": (3, bars.count())}
    assert sinks.write_if_nonempty(bars.limit(2), f"{tmp_path}/keep")
    assert not sinks.write_if_nonempty(bars.limit(0), f"{tmp_path}/keep")
    assert spark.read.parquet(f"{tmp_path}/keep").count() == 2
    assert sinks.write_if_nonempty(spark.read.parquet(f"{tmp_path}/keep").limit(1), f"{tmp_path}/keep")
    for day in ("2024-01-01", "2024-01-02"):
        sinks.append_batch(bars.limit(3), f"{tmp_path}/landing", ["ticker", "missing", "volume"], day)
    landed = spark.read.parquet(f"{tmp_path}/landing")
    assert landed.count() == 6 and landed.columns == ["ticker", "volume", "ingest_date"]


def land_minutes(root, n=400, ticker="AAA"):
    """Five-minute bars of one ticker, 25 a day, dealt over two files against their order; returns (time, close, volume)."""
    start, rows = dt.datetime(2024, 1, 1, 9), []
    for i in range(n):
        when = start + dt.timedelta(days=i // 25, minutes=5 * (i % 25))
        rows.append((when, 100 + 7 * ((i * 37) % 11) + (40 if i % 50 == 13 else 0), 1000 + 13 * (i * 29 % 17)))
    for k in (0, 1):
        lines = [f"{t:%Y-%m-%d %H:%M:%S},{c},{c + 2},{c - 2},{c},{v},{ticker}\n" for t, c, v in reversed(rows[k::2])]
        put(f"{root}/raw/prices/{k}.csv", "Date,Open,High,Low,Close,Volume,Ticker\n" + "".join(lines))
    return rows


@pytest.mark.parametrize("hot_rows", [1_000_000, 60])
def test_jobs_use_every_intraday_bar_in_time_order(spark, tmp_path, hot_rows):
    rows = land_minutes(str(tmp_path))
    paths = jobs.Paths(str(tmp_path))
    direct = spark.createDataFrame([("AAA", t, float(c), c + 2.0, c - 2.0, float(c), float(v)) for t, c, v in rows],
                                   "ticker string, trade_date timestamp, open_price double, high_price double, low_price double, "
                                   "close_price double, volume double")
    want = {(r.trade_date, r.anomaly_score, r.anomaly_type) for r in anomaly.detect_anomalies(direct).collect()}
    got = jobs.run_anomalies(spark, paths, hot_rows=hot_rows)["anomalies"].collect()
    assert len(got) == len(want) and {(r.anomaly_ts, r.anomaly_score, r.anomaly_type) for r in got} == want
    assert all(r.anomaly_date == r.anomaly_ts.date() for r in got)
    moves = {}
    for (_, a, _), (t, b, _) in zip([(None, None, None), *rows], rows):
        r = None if a is None else (b - a) / a
        moves.setdefault(t.date(), []).append(0.0 if r is None else 1.0 if r > 0.01 else -1.0 if r < -0.01 else 0.0)
    first = min(moves)
    dim = spark.createDataFrame([("AAA", "Energy")], "ticker string, sector string")
    out = jobs.run_momentum(spark, paths, dim, "now", hot_rows=hot_rows)["momentum"].filter("window_days = 30").collect()
    assert len(out) == len(moves) == 16
    assert [r.avg_sentiment for r in out if r.end_date == first] == [pytest.approx(sum(moves[first]) / len(moves[first]))]


def test_register_tables(spark, tmp_path):
    names = readers.register_tables(spark, f"{tmp_path}/warehouse")
    assert spark.table("price_sentiment_joined").columns[:2] == ["ticker", "trade_date"] and len(names) == 8


def test_all_stages_over_landed_files(spark, tmp_path, sf):
    """Bars, news and posts land as CSV and go through every job."""
    paths = jobs.Paths(str(tmp_path))
    landed = fx.bars(spark, sf).select(
        F.col("trade_date").alias("Date"), F.col("open_price").alias("Open"), F.col("high_price").alias("High"),
        F.col("low_price").alias("Low"), F.col("close_price").alias("Close"), F.col("volume").alias("Volume"), F.col("ticker").alias("Ticker"))
    sinks.write_dataset(landed, paths.raw("prices"), fmt="csv")
    news = fx.news_refetched(spark, sf).select("source", "title", "summary", "published_date", "link", "matched_tickers", "fetched_at")
    sinks.write_dataset(news, paths.raw("news"), fmt="csv")
    posts = fx.posts(spark, sf).select("subreddit", "post_id", "title", "selftext", "created_utc", "matched_tickers", "fetched_at")
    sinks.write_dataset(posts, paths.raw("reddit"), fmt="csv")
    out = jobs.run(spark, paths, fx.dim(spark, sf), "2024-01-01T00:00:00")
    assert out["prices_clean"].count() == fx.bars(spark, sf).count()
    assert out["news_clean"].count() == fx.news(spark, sf).count()
    assert out["anomalies"].count() == 2721
    assert {r.window_days for r in out["latest"].collect()} <= {30, 60, 90}
    assert {r.dataset for r in out["status"].collect()} == {"sentiment", "anomalies", "momentum"}
    strict = jobs.run_strict(spark, paths, fx.dim(spark, sf), "2024-01-01T00:00:00")
    assert 0 < strict["anomalies"].count() < out["prices_clean"].count() * 0.06
    with pytest.raises(ValueError):
        jobs.run(spark, paths, fx.dim(spark, sf), "now", ["nope"])


# --- streaming -------------------------------------------------------------------------------

LAYOUT = "post_id string, event_ts timestamp, text string"


def test_restart_adds_no_duplicates(spark, tmp_path):
    root, out, ckpt = f"{tmp_path}/land", f"{tmp_path}/out", f"{tmp_path}/ckpt"
    head = "post_id,event_ts,text\n"
    put(f"{root}/1.csv", head + "p1,2024-01-01T00:00:00,a\np1,2024-01-01T00:00:00,a\np2,2024-01-01T01:00:00,b\n")
    stream = ingest.read_landing(spark, root, LAYOUT)
    assert ingest.stream_ingest(stream, out, ckpt).count() == 2
    put(f"{root}/2.csv", head + "p2,2024-01-01T02:00:00,again\np3,2024-01-01T03:00:00,c\n")
    again = ingest.stream_ingest(ingest.read_landing(spark, root, LAYOUT), out, ckpt)
    assert sorted(r.post_id for r in again.collect()) == ["p1", "p2", "p3"]
    assert ingest.stream_ingest(ingest.read_landing(spark, root, LAYOUT), out, ckpt).count() == 3


def test_posts_that_come_late_are_landed_once(spark, tmp_path):
    """Batches of Feb 1, Feb 2, then Jan 20 and repeats of both: no post is lost, none lands twice."""
    root, out, ckpt = f"{tmp_path}/land", f"{tmp_path}/out", f"{tmp_path}/ckpt"
    head = "post_id,event_ts,text\n"
    for k, rows in enumerate(["p1,2024-02-01T00:00:00,a\n", "p2,2024-02-02T00:00:00,b\n", "p4,2024-02-09T00:00:00,d\n",
                              "p3,2024-01-20T00:00:00,c\np1,2024-02-01T00:00:00,a\np2,2024-02-02T00:00:00,b\n"]):
        put(f"{root}/{k}.csv", head + rows)
        got = ingest.stream_ingest(ingest.read_landing(spark, root, LAYOUT), out, ckpt)
    assert sorted(r.post_id for r in got.collect()) == ["p1", "p2", "p3", "p4"]


def test_late_rows_do_not_change_a_final_day(spark, tmp_path):
    root, out, ckpt = f"{tmp_path}/land", f"{tmp_path}/out", f"{tmp_path}/ckpt"
    head = "ticker,event_ts,sentiment_score\n"
    layout = "ticker string, event_ts timestamp, sentiment_score double"
    put(f"{root}/1.csv", head + "A,2024-01-01T10:00:00,0.5\nA,2024-01-01T11:00:00,0.1\nA,2024-01-05T00:00:00,0.9\n")
    run = lambda: ingest.stream_daily_sentiment(ingest.read_landing(spark, root, layout), out, ckpt)
    assert [(str(r.event_day), round(r.daily_sentiment, 3), r.article_count) for r in run().collect()] == [("2024-01-01", 0.3, 2)]
    put(f"{root}/2.csv", head + "A,2024-01-01T12:00:00,-1.0\nA,2024-01-09T00:00:00,0.0\n")
    got = {str(r.event_day): r.article_count for r in run().collect()}
    assert got == {"2024-01-01": 2, "2024-01-05": 1}


def normal(seed: int, tag: str, key: str):
    """Standard normal values from hashes of the row."""
    u = [(F.pmod(F.xxhash64(F.lit(seed), F.lit(tag + part), key), F.lit(1 << 52)) + 0.5) / float(1 << 52) for part in "ra"]
    return F.sqrt(-2 * F.log(u[0])) * F.cos(6.283185307179586 * u[1])


# --- forest ---------------------------------------------------------------------------------------

def test_forest_share_and_determinism(spark, sf):
    bars = fx.bars(spark, sf)
    total = {r.ticker: r["count"] for r in series.strict_features(bars).groupBy("ticker").count().collect()}
    first = forest.detect_isoforest(bars, trees=30).collect()
    per = {}
    for r in first:
        per[r.ticker] = per.get(r.ticker, 0) + 1
    assert all(abs(per[t] - 0.05 * n) <= 0.01 * n + 1 for t, n in total.items())
    again = forest.detect_isoforest(bars.repartition(3), trees=30).collect()
    key = lambda r: (r.ticker, r.trade_date)
    assert sorted(map(tuple, first), key=str) == sorted(map(tuple, again), key=str) and len(set(map(key, first))) == len(first)


def test_forest_finds_planted_outliers_in_pieces(spark):
    """A long series is scored in pieces from one pool; planted rows must be on top."""
    df = spark.range(6000).select(
        F.lit("HOT").alias("ticker"), F.timestamp_seconds(F.col("id") * 60).alias("trade_date"),
        F.lit(1.0).alias("close_price"), F.lit(1.0).alias("volume"),
        *[(normal(1, c, "id") + F.when(F.col("id") % 600 == 7, 9.0).otherwise(0.0)).alias(c) for c in series.FEATURES])
    scores = forest.forest_scores(df, trees=20, pool_rows=1500, piece=1000)
    assert scores.count() == 6000
    top = {r.trade_date.minute + 60 * r.trade_date.hour for r in scores.orderBy(F.desc("raw_score")).limit(10).select("trade_date").collect()}
    planted = {(i % 1440) for i in range(7, 6000, 600)}
    assert top == planted
    flagged = forest.detect_isoforest_long(df, trees=20, pool_rows=1500, piece=1000).count()
    assert abs(flagged - 300) <= 61


def test_forest_does_not_depend_on_pieces_or_pool(spark):
    """Trees draw from the whole series: however it is cut, scores stay; each tree has the smallest hashes of all rows."""
    df = spark.range(3000).select(
        F.lit("HOT").alias("ticker"), F.timestamp_seconds(F.col("id") * 60).alias("trade_date"),
        F.lit(1.0).alias("close_price"), F.lit(1.0).alias("volume"), *[normal(2, c, "id").alias(c) for c in series.FEATURES])
    def scores(**kw):
        return {r.trade_date: r.raw_score for r in forest.forest_scores(df.repartition(3), trees=5, **kw).collect()}
    whole = scores()
    assert len(whole) == 3000 and whole == scores(piece=700) == scores(pool_rows=600, piece=1000)
    hashes = np.random.default_rng(1).integers(-2**63, 2**63, 3000)
    pool = forest._in_pool(hashes, np.full(3000, 3000), 5, 42)
    all_rows = hashes.astype(float)[:, None]
    drawn, every = forest._samples(all_rows[pool], hashes[pool], 5, 42), forest._samples(all_rows, hashes, 5, 42)
    assert pool.sum() < 3000 and drawn.shape == (5, 256, 1) and (np.sort(drawn, 1) == np.sort(every, 1)).all()


def test_strict_job_over_pieces_equals_the_whole_series(spark, tmp_path, monkeypatch):
    land_minutes(str(tmp_path))
    paths = jobs.Paths(str(tmp_path))
    def found(**kw):
        return sorted((r.anomaly_ts, r.anomaly_score) for r in jobs.run_anomalies(spark, paths, strict=True, trees=10, **kw)["anomalies"].collect())
    whole = found()
    seen = []
    split = series.split_hot
    monkeypatch.setattr(series, "split_hot", lambda *a: seen.append(a[4]) or split(*a))
    assert 0 < len(whole) <= 22 and found(hot_rows=60) == whole and seen == [60]


def test_intraday_anomalies_meet_the_sentiment_of_their_day(spark):
    from tidemark.operators import align

    found = spark.sql("SELECT 'A' AS ticker, timestamp'2024-01-02 10:05:00' AS trade_date UNION ALL SELECT 'A', timestamp'2024-01-02 15:00:00'")
    daily = spark.sql("SELECT 'A' AS ticker, date'2024-01-02' AS event_day, 0.5D AS daily_sentiment")
    assert [r.sentiment_avg for r in align.correlate_daily(found, daily).collect()] == [0.5, 0.5]


def test_point_loads_skip_row_groups(spark, tmp_path, sf):
    """Of the row groups of a clustered store nine in ten can't hold a ticker, by their statistics; a Bloom filter is there as well."""
    import glob

    import pyarrow.parquet as pq

    path = f"{tmp_path}/clustered"
    bars = fx.bars(spark, sf).repartition(4)
    many = bars.crossJoin(spark.range(20).withColumnRenamed("id", "k")).withColumn("ticker", F.concat("ticker", F.lit("-"), "k")).drop("k")
    sinks.write_clustered(many, path, "ticker", ["trade_date"], row_group_bytes=16 << 10, keys=1_000)
    wanted, held, groups, filters = "S1-7", 0, 0, 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index("ticker")
        for k in range(meta.num_row_groups):
            stats = meta.row_group(k).column(at).statistics
            groups, held = groups + 1, held + (stats.min <= wanted <= stats.max)
    assert groups >= 20 and 1 <= held <= groups / 10
    got = readers.read_ticker(spark, path, " s1-7.NS")
    assert got.count() == bars.where("ticker = 'S1'").count() and "PushedFilters: [IsNotNull(ticker), EqualTo(ticker,S1-7)]" in got._jdf.queryExecution().executedPlan().toString()


def test_an_interrupted_swap_keeps_the_data(spark, tmp_path):
    path, rows = f"{tmp_path}/t", spark.range(5)
    assert sinks.write_if_nonempty(rows, path) and spark.read.parquet(path).count() == 5
    os.rename(path, path + "._old")  # as after the first of both steps
    assert not sinks.write_if_nonempty(rows.limit(0), path) and spark.read.parquet(path).count() == 5
    os.makedirs(path + "._old")  # as after the second
    assert sinks.write_if_nonempty(spark.read.parquet(path).where("id < 2"), path) and spark.read.parquet(path).count() == 2
    assert sorted(os.listdir(tmp_path)) == ["t"]
