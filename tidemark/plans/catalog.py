"""Registered queries: every operator over the given tables.

Each entry takes (spark, sf_dir) and returns a lazy frame. `publish` only
fixes the presentation: six decimals, dates and times as text, long counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import clean as C
from tidemark.functions import scalars as S
from tidemark.operators import (aggregates, align, anomaly, clean, forest, fusion, momentum, sentiment, series,
                                tagging, views)
from tidemark.plans import fixtures as fx
from tidemark.plans import jobs
from tidemark.session import materialize, shared_folder
from tidemark.sources import readers, sinks
from tidemark.streaming import ingest as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def publish(df: DataFrame, *columns: str) -> DataFrame:
    out = []
    fields = {f.name: f.dataType for f in df.schema.fields}
    for name in columns or df.columns:
        kind, col = fields[name], F.col(name)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            # The offset sends exact ties up, whatever the last bit of a sum is.
            col = F.round(col + 1e-10, 6) + F.lit(0.0)
        elif isinstance(kind, T.DateType):
            col = col.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, (T.IntegerType, T.ShortType)):
            col = col.cast("bigint")
        out.append(col.alias(name))
    return df.select(*out)


# --- shared inputs -----------------------------------------------------------------------

def _anomalies(spark, d):
    return anomaly.detect_anomalies(fx.bars(spark, d))


def _stored(spark, d, bars=None):
    found = _anomalies(spark, d) if bars is None else anomaly.detect_anomalies(bars)
    return anomaly.correlate_sentiment(found, fx.sentiment(spark, d)).select(*anomaly.OUTPUT)


def _blended(spark, d):
    daily = aggregates.daily_sentiment(fx.sentiment(spark, d))
    return align.with_sector(align.blend_sentiment(fx.bars(spark, d), daily), fx.dim(spark, d))


def _daily_sector(spark, d):
    return aggregates.daily_sector(_blended(spark, d))


def _momentum(spark, d):
    return momentum.all_momentum(_daily_sector(spark, d))


def _flat_news(spark, d, trim=True):
    return tagging.explode_tickers(clean.dedupe_news(fx.news_refetched(spark, d)), trim=trim)


MOMENTUM_COLUMNS = ("sector", "window_days", "momentum_score", "avg_sentiment", "ticker_count", "start_date", "end_date")
ANOMALY_COLUMNS = ("ticker", "anomaly_date", "close_price", "volume", "anomaly_score", "anomaly_type")


# --- windows over bars ---------------------------------------------------------------------

@query
def detect_anomalies(spark, d):
    return publish(_anomalies(spark, d), "ticker", "trade_date", "close_price", "volume", "daily_return",
                   "volatility_7d", "volume_ratio", "ma_crossover", "price_range", "anomaly_score", "anomaly_type")


@query
def daily_return(spark, d):
    return publish(series.daily_return(fx.bars(spark, d)), "ticker", "trade_date", "close_price", "prev_close", "daily_return")


@query
def volatility_7(spark, d):
    return publish(series.volatility(fx.bars(spark, d), 7), "ticker", "trade_date", "volatility_7d")


@query
def volatility_20(spark, d):
    return publish(series.volatility(fx.bars(spark, d), 20), "ticker", "trade_date", "volatility_20d")


@query
def volume_features(spark, d):
    return publish(series.volume_features(fx.bars(spark, d)),
                   "ticker", "trade_date", "avg_volume_7d", "avg_volume_20d", "volume_ratio")


@query
def moving_averages(spark, d):
    return publish(series.moving_averages(fx.bars(spark, d)), "ticker", "trade_date", "sma_7", "sma_20", "ma_crossover")


@query
def intraday_features(spark, d):
    """Features of an intraday series, cut into pieces where a key is hot."""
    out = series.features(fx.intraday(spark, d), hot_rows=30)
    return publish(out, "ticker", "trade_date", "daily_return", "volatility_7d", "volume_ratio", "ma_crossover", "price_range")


@query
def rolling_min_periods(spark, d):
    out = series.rolling(fx.bars(spark, d), "close_price", 20, 10)
    return publish(out, "ticker", "trade_date", "rolling_mean", "rolling_std")


@query
def zscore_anomalies(spark, d):
    return publish(anomaly.detect_zscore(fx.bars(spark, d)), *ANOMALY_COLUMNS, "sentiment_avg", "description")


@query
def base100(spark, d):
    return publish(series.base100(fx.bars(spark, d)), "ticker", "trade_date", "close_price", "normalized_return")


@query
def nth_from_end(spark, d):
    return publish(series.nth_from_end(fx.bars(spark, d), 30), "ticker", "latest", "nth_value", "rows_seen")


@query
def tail_per_ticker(spark, d):
    return publish(series.tail_per_ticker(fx.bars(spark, d), 500), "ticker", "trade_date", "close_price")


@query
def latest_versions(spark, d):
    ev = fx.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    now = ev.agg(F.max("ts")).scalar()
    out = series.latest_versions(ev, ["user_id"], "ts", 3, 7 * 86_400, now, [F.col("event_id")])
    return publish(out, "user_id", "event_id", "event_type", "value")


@query
def price_momentum(spark, d):
    return publish(momentum.price_momentum(fx.bars(spark, d), fx.dim(spark, d)),
                   "sector", "trade_date", "momentum_30", "momentum_60", "momentum_90")


@query
def min_history(spark, d):
    return publish(series.min_history(fx.sentiment(spark, d), 30), "ticker", "source_type", "source_id", "sentiment_score")


@query
def strict_features(spark, d):
    return publish(series.strict_features(fx.bars(spark, d)), "ticker", "trade_date", *series.FEATURES)


@query
def standardize(spark, d):
    out = series.standardize(series.features(fx.bars(spark, d)), series.FEATURES)
    return publish(out, "ticker", "trade_date", *[f"{c}_z" for c in series.FEATURES])


# --- anomalies and sentiment ---------------------------------------------------------------

@query
def correlate_sentiment(spark, d):
    return publish(_stored(spark, d))


@query
def correlate_without_sentiment(spark, d):
    out = anomaly.correlate_sentiment(_anomalies(spark, d), None)
    return publish(out, *ANOMALY_COLUMNS, "sentiment_avg", "description")


@query
def divergences(spark, d):
    bars = anomaly.score_anomalies(series.features(fx.bars(spark, d)))
    return publish(anomaly.divergences(bars, fx.sentiment(spark, d)),
                   "ticker", "anomaly_date", "daily_return", "sentiment_avg", "anomaly_type", "description")


@query
def iso_forest(spark, d):
    return publish(forest.detect_isoforest(fx.bars(spark, d)))


@query
def iso_forest_intraday(spark, d):
    """Forest over intraday series of any length, in bounded pieces."""
    featured = series.features(fx.intraday(spark, d), hot_rows=30)
    return publish(forest.detect_isoforest_long(series.min_history(featured, 30), trees=50))


@query
def stored_or_dynamic(spark, d):
    # Bars serve both detectors, and the outliers their own rows and the search for tickers without any.
    bars = materialize(fx.bars(spark, d), "bars")
    bars = series.dealt(bars, bars.count(), "ticker")
    outliers = materialize(_stored(spark, d, bars).filter(F.col("anomaly_type") == "statistical_outlier"), "outliers")
    return publish(anomaly.stored_or_dynamic(outliers, bars), *ANOMALY_COLUMNS)


@query
def lookup_anomalies(spark, d):
    return publish(anomaly.lookup_anomalies(_stored(spark, d), "S1"), *ANOMALY_COLUMNS)


@query
def align_events(spark, d):
    events = fx.sentiment(spark, d)
    stored = _anomalies(spark, d).withColumnRenamed("trade_date", "anomaly_date")
    return publish(fusion.align_events(stored, events),
                   "ticker", "anomaly_date", "anomaly_score", "source_type", "source_id", "event_ts", "sentiment_score")


def _classified(spark, d):
    stored = _anomalies(spark, d).withColumnRenamed("trade_date", "anomaly_date")
    return fusion.classify_context(stored.select("ticker", "anomaly_date", "anomaly_type"), fx.sentiment(spark, d))


@query
def classify_context(spark, d):
    return publish(_classified(spark, d),
                   "ticker", "anomaly_date", "news_polarity", "retail_polarity", "max_polarity", "context")


@query
def association_rate(spark, d):
    return publish(fusion.association_rate(_classified(spark, d)))


@query
def directional_accuracy(spark, d):
    moved = series.daily_return(fx.bars(spark, d))
    joined = align.correlate_daily(moved, aggregates.daily_sentiment(fx.sentiment(spark, d)))
    return publish(fusion.directional_accuracy(joined))


@query
def sentiment_lead(spark, d):
    stored = _anomalies(spark, d).withColumnRenamed("trade_date", "anomaly_date")
    return publish(fusion.sentiment_lead(fx.sentiment(spark, d), stored, 24 * 90, hot_rows=60),
                   "ticker", "anomaly_date", "last_event", "lead_hours")


# --- deduplication and lists -----------------------------------------------------------------

@query
def dedupe_prices(spark, d):
    return publish(clean.dedupe_prices(fx.ticks(spark, d)), "ticker", "trade_date", "close_price", "volume")


@query
def dedupe_news(spark, d):
    return publish(clean.dedupe_news(fx.news_refetched(spark, d)), "doc_id", "title", "published_date", "fetched_at")


@query
def dedupe_posts(spark, d):
    first = fx.posts(spark, d)
    again = first.filter(F.col("conv_id") % 5 == 0).withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 1 DAY"))
    return publish(clean.dedupe_posts(again.unionByName(first)), "post_id", "subreddit", "fetched_at")


@query
def explode_tickers(spark, d):
    return publish(tagging.explode_tickers(fx.news(spark, d)), "doc_id", "ticker")


@query
def explode_tickers_raw(spark, d):
    return publish(tagging.explode_tickers(fx.news(spark, d), trim=False), "doc_id", "ticker")


@query
def tag_tickers(spark, d):
    return publish(tagging.tag_tickers(fx.table(spark, d, "documents"), fx.keywords(spark)))


@query
def keywords_from_names(spark, d):
    names = fx.table(spark, d, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("symbol"),
        F.concat("p_name", F.lit(" "), F.when(F.col("p_partkey") % 3 == 0, "Company").when(
            F.col("p_partkey") % 3 == 1, "Limited").otherwise("Ltd.")).alias("company_name"))
    return publish(tagging.keywords_from_names(names))


@query
def ticker_keywords(spark, d):
    alias = fx.table(spark, d, "customer").select(
        F.concat(F.lit("S"), "c_custkey").alias("ticker"), F.lower("c_mktsegment").alias("keyword"))
    return publish(tagging.ticker_keywords(fx.dim(spark, d), alias))


# --- joins ---------------------------------------------------------------------------------------

@query
def news_price_aligned(spark, d):
    prices = clean.dedupe_prices(fx.ticks(spark, d))
    return publish(align.news_price_aligned(_flat_news(spark, d), prices))


@query
def news_price_outer(spark, d):
    prices = clean.dedupe_prices(fx.ticks(spark, d))
    out = align.news_price_aligned(_flat_news(spark, d), prices, "full")
    return publish(out, "ticker", "event_date", "news_source", "headline", "close_price", "volume")


@query
def price_sentiment_joined(spark, d):
    daily = aggregates.daily_ticker_sentiment(fx.sentiment(spark, d))
    return publish(align.price_sentiment_joined(fx.bars(spark, d), daily))


@query
def blend_sentiment(spark, d):
    daily = aggregates.daily_sentiment(fx.sentiment(spark, d))
    return publish(align.blend_sentiment(fx.bars(spark, d), daily),
                   "ticker", "trade_date", "price_sentiment", "real_sentiment", "blended_sentiment")


@query
def with_sector(spark, d):
    return publish(align.with_sector(fx.bars(spark, d), fx.dim(spark, d)), "ticker", "trade_date", "sector")


@query
def peers(spark, d):
    return publish(align.peers(fx.dim(spark, d), "S1"))


@query
def shock_window(spark, d):
    shocks = views.top_shocks(_anomalies(spark, d).withColumnRenamed("trade_date", "anomaly_date"))
    out = align.shock_window(fx.bars(spark, d), shocks.select("ticker", F.col("anomaly_date").alias("trade_date")))
    return publish(out, "ticker", "shock_date", "trade_date", "close_price", "volume")


# --- grouped summaries ---------------------------------------------------------------------------

@query
def daily_sentiment(spark, d):
    return publish(aggregates.daily_sentiment(fx.sentiment(spark, d)))


@query
def daily_sentiment_by_source(spark, d):
    return publish(aggregates.daily_sentiment(fx.sentiment(spark, d), by_source=True))


@query
def daily_ticker_sentiment(spark, d):
    return publish(aggregates.daily_ticker_sentiment(fx.sentiment(spark, d)))


@query
def daily_sector(spark, d):
    return publish(_daily_sector(spark, d))


@query
def daily_news_volume(spark, d):
    return publish(aggregates.daily_news_volume(_flat_news(spark, d)))


@query
def value_counts(spark, d):
    return publish(aggregates.value_counts(_anomalies(spark, d), "anomaly_type"))


@query
def value_counts_label(spark, d):
    return publish(aggregates.value_counts(fx.sentiment(spark, d), "sentiment_label"))


@query
def sentiment_summary(spark, d):
    return publish(aggregates.sentiment_summary(fx.sentiment(spark, d)))


@query
def price_summary(spark, d):
    return publish(views.price_summary(fx.bars(spark, d)))


@query
def overview_kpis(spark, d):
    return publish(aggregates.overview_kpis(fx.bars(spark, d), fx.sentiment(spark, d), _stored(spark, d), fx.dim(spark, d)))


@query
def divergence_count(spark, d):
    stored = _stored(spark, d)
    plain = stored.drop("description")
    return publish(stored.agg(aggregates.divergence_count(stored).alias("named")).select(
        "named", plain.agg(aggregates.divergence_count(plain)).scalar().alias("by_sentiment")))


@query
def peer_table(spark, d):
    return publish(views.peer_table(fx.bars(spark, d), _anomalies(spark, d), fx.dim(spark, d)))


@query
def peer_table_selected(spark, d):
    return publish(views.peer_table(fx.bars(spark, d), _anomalies(spark, d), fx.dim(spark, d), "S1"))


@query
def row_count(spark, d):
    return publish(aggregates.row_count(_anomalies(spark, d)))


@query
def distinct_values(spark, d):
    return publish(aggregates.distinct_values(fx.sentiment(spark, d, general=True), "ticker"))


@query
def symbol_universe(spark, d):
    return publish(aggregates.symbol_universe(fx.dim(spark, d), fx.bars(spark, d), fx.sentiment(spark, d, general=True)))


@query
def dataset_status(spark, d):
    names = ["benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation", "orders", "pages", "part",
             "region", "supplier"]
    return publish(sinks.dataset_status(spark, {n: f"{d}/{n}.parquet" for n in names}))


# --- momentum ------------------------------------------------------------------------------------

@query
def sector_momentum_30(spark, d):
    return publish(momentum.sector_momentum(_daily_sector(spark, d), 30), *MOMENTUM_COLUMNS)


@query
def sector_momentum_60(spark, d):
    return publish(momentum.sector_momentum(_daily_sector(spark, d), 60), *MOMENTUM_COLUMNS)


@query
def sector_momentum_90(spark, d):
    return publish(momentum.sector_momentum(_daily_sector(spark, d), 90), *MOMENTUM_COLUMNS)


@query
def all_momentum(spark, d):
    return publish(_momentum(spark, d), *MOMENTUM_COLUMNS)


@query
def strict_momentum(spark, d):
    daily = aggregates.daily_sector(_blended(spark, d), strict=True)
    return publish(momentum.all_momentum(daily, strict=True), *MOMENTUM_COLUMNS)


@query
def momentum_pivot(spark, d):
    """Sector by end date, wide: a column for each day of the last year."""
    last = _momentum(spark, d).filter(F.col("end_date") >= F.lit("1998-01-01").cast("date"))
    return publish(momentum.momentum_pivot(last, 30))


@query
def momentum_matrix(spark, d):
    return publish(momentum.momentum_matrix(_momentum(spark, d), 30))


@query
def latest_momentum(spark, d):
    return publish(momentum.latest_momentum(_momentum(spark, d)), *MOMENTUM_COLUMNS)


@query
def latest_per_sector(spark, d):
    return publish(momentum.latest_per_sector(_momentum(spark, d), 30))


# --- rankings --------------------------------------------------------------------------------------

@query
def top_anomalies(spark, d):
    return publish(views.top_anomalies(_stored(spark, d)), *ANOMALY_COLUMNS)


@query
def recent_anomalies(spark, d):
    return publish(views.recent_anomalies(_stored(spark, d)), *ANOMALY_COLUMNS)


@query
def top_shocks(spark, d):
    return publish(views.top_shocks(_stored(spark, d)), *ANOMALY_COLUMNS)


@query
def top_tickers(spark, d):
    return publish(aggregates.top_tickers(fx.sentiment(spark, d)))


@query
def ordered_momentum(spark, d):
    return publish(views.ordered(_momentum(spark, d), ["sector", "window_days", "end_date"]), *MOMENTUM_COLUMNS)


# --- stored tables -------------------------------------------------------------------------------------

@query
def write_fixed_files(spark, d):
    """A dataset as three files."""
    path = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    sinks.write_dataset(fx.bars(spark, d), path, files=3)
    return publish(sinks.dataset_status(spark, {"bars": path}))


@query
def append_batches(spark, d):
    """Two fetches appended in one column order, below the days they came."""
    path, posts = f"{shared_folder(spark)}/appended-{uuid.uuid4().hex}", fx.posts(spark, d).select("selftext", "post_id", "subreddit", "conv_id")
    first = F.col("conv_id") % 3 > 0
    sinks.append_batch(posts.where(first), path, ["post_id", "subreddit", "flair", "selftext"], "2024-01-01")
    sinks.append_batch(posts.where(~first), path, ["post_id", "subreddit", "flair", "selftext"], "2024-01-02")
    return publish(spark.read.parquet(path), "ingest_date", "post_id", "subreddit")


@query
def stored_tables(spark, d):
    """Stored tables as views of their names, one of which joins two of them."""
    root = f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"
    sinks.write_dataset(fx.sentiment(spark, d), f"{root}/sentiment_scores")
    readers.register_tables(spark, root)
    return publish(spark.table("daily_ticker_sentiment"))


# --- pages: what one page shows, from one call ----------------------------------------------------------

YEAR = ("1996-01-01", "1996-12-31")


@query
def page_overview(spark, d):
    """The newest anomalies of a span and a kind, with the span's key figures beside them."""
    page = views.overview(fx.bars(spark, d), fx.sentiment(spark, d), _stored(spark, d), _momentum(spark, d), fx.dim(spark, d), *YEAR, "volume_surge")
    recent = page["recent"].select(*ANOMALY_COLUMNS)
    return publish(recent.join(page["kpis"].select("stocks_tracked", "avg_sentiment", "mood", "anomalies"), how="cross"))


@query
def page_ticker(spark, d):
    """Candles of one ticker with its summary and the day's sentiment and anomaly."""
    page = views.ticker_detail("S1", fx.bars(spark, d), fx.sentiment(spark, d), _stored(spark, d))
    candles = page["candles"].select("ticker", "trade_date", "close_price")
    day = page["daily_sentiment"].select(F.col("ticker"), F.col("event_day").alias("trade_date"), "daily_sentiment", "article_count")
    flagged = page["anomalies"].select("ticker", F.col("anomaly_date").alias("trade_date"), "anomaly_type")
    summary = page["summary"].select("ticker", "latest_close", "high", "low")
    return publish(candles.join(day, ["ticker", "trade_date"], "left").join(flagged, ["ticker", "trade_date"], "left").join(summary, "ticker"))


@query
def page_heatmap(spark, d):
    """Every cell of the sector heat map with the newest score of its sector."""
    page = views.heatmap(_momentum(spark, d), fx.bars(spark, d), _stored(spark, d), fx.dim(spark, d), 30)
    latest = page["latest"].select("sector", F.col("end_date").alias("latest_date"), F.col("momentum_score").alias("latest_score"))
    return publish(page["matrix"].join(latest, "sector"))


@query
def page_replay(spark, d):
    """Prices of a basket in a span, the first being 100, with the anomalies of the same days."""
    page = views.replay(fx.bars(spark, d), _stored(spark, d), ["S1", "S2", "S3", "S5"], *YEAR)
    flagged = page["anomalies"].select("ticker", F.col("anomaly_date").alias("trade_date"), "anomaly_type")
    relative = page["relative"].select("ticker", "trade_date", "close_price", "normalized_return")
    return publish(relative.join(flagged, ["ticker", "trade_date"], "left"))


# --- text --------------------------------------------------------------------------------------------

@query
def text_events(spark, d):
    return publish(sentiment.text_events(fx.news(spark, d), fx.posts(spark, d)))


@query
def tokenize(spark, d):
    words = sentiment.tokenize(fx.table(spark, d, "documents").select("doc_id", "text"))
    kept = sentiment.remove_stopwords(words)
    return publish(kept.select("doc_id", F.size("words").alias("words"), F.size("filtered_words").alias("kept"),
                               F.array_join("filtered_words", " ").alias("text")))


@query
def term_tfidf(spark, d):
    return publish(sentiment.term_tfidf(fx.table(spark, d, "documents")))


@query
def hashing_tfidf(spark, d):
    from pyspark.ml.functions import vector_to_array

    out = sentiment.hashing_tfidf(fx.table(spark, d, "documents").select("doc_id", "text"))
    weights = F.filter(vector_to_array("tfidf_features"), lambda x: x != 0)
    return publish(out.select("doc_id", F.size("filtered_words").alias("words"), F.size(weights).alias("buckets"),
                              F.aggregate(weights, F.lit(0.0), lambda a, x: a + x).alias("weight")))


@query
def lexicon_sentiment(spark, d):
    docs = fx.table(spark, d, "documents").select("doc_id", "lang", "text")
    return publish(sentiment.lexicon_sentiment(docs, fx.lexicon(spark), negators=fx.FX_NEGATORS))


@query
def sentiment_by_ticker(spark, d):
    out = sentiment.sentiment_by_ticker(fx.news(spark, d), fx.posts(spark, d), fx.lexicon(spark), "2024-01-01T00:00:00",
                                        negators=fx.FX_NEGATORS)
    return publish(out)


def _scorer(text: str) -> tuple[float, float]:
    """A user's scorer: share of upper-case letters, and the digit share."""
    return sum(c.isupper() for c in text) / len(text), sum(c.isdigit() for c in text) / len(text)


@query
def score_partitions(spark, d):
    """A user's scorer, batch by batch."""
    docs = fx.table(spark, d, "documents").select("doc_id", "text")
    return publish(sentiment.score_partitions(docs, _scorer), "doc_id", "sentiment_score", "sentiment_label", "confidence")


@query
def score_udf(spark, d):
    """The same scorer as a column."""
    docs = fx.table(spark, d, "documents").select("doc_id", sentiment.score_udf(_scorer)("text").alias("s"))
    return publish(docs.select("doc_id", "s.*"))


# --- cleaning ----------------------------------------------------------------------------------------

@query
def rename(spark, d):
    return publish(clean.rename(fx.table(spark, d, "supplier"), {"s_suppkey": "ticker_id", "s_acctbal": "close_price"}))


def _landed(spark, d):
    """Bars as they land: foreign names, suffixed symbols, text numbers."""
    suffix = F.when(F.month("trade_date") % 2 == 0, ".NS").otherwise(".bo ")
    return fx.bars(spark, d).select(
        F.date_format("trade_date", "yyyy-MM-dd").alias("Date"), F.col("open_price").alias("OPEN"),
        F.col("close_price").alias("Close"), F.col("low_price").alias("Adj Close"),
        F.when(F.col("volume") > 60, "n/a").otherwise(F.col("volume").cast("string")).alias("Volume"),
        F.concat(F.lit(" "), F.lower("ticker"), F.upper(suffix)).alias("Ticker"),
    )


@query
def normalize_prices(spark, d):
    return publish(clean.normalize_prices(_landed(spark, d)), "ticker", "trade_date", "open_price", "close_price", "volume")


@query
def normalize_sentiment(spark, d):
    raw = fx.sentiment(spark, d).select(
        F.concat(F.lower("ticker"), F.lit(".NS")).alias("TICKER"), F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss").alias("Published"),
        F.col("sentiment_score").cast("string").alias("Polarity"), F.col("sentiment_label").alias("Label"), "source_id")
    return publish(clean.normalize_sentiment(raw))


@query
def normalize_anomalies(spark, d):
    raw = _anomalies(spark, d).select(
        F.col("ticker").alias("Ticker"), F.date_format("trade_date", "yyyy-MM-dd").alias("Date"),
        F.col("close_price").alias("Close"), F.col("anomaly_score").cast("string").alias("Score"),
        F.concat(F.lit(" "), "anomaly_type").alias("Type"))
    return publish(clean.normalize_anomalies(raw))


@query
def normalize_momentum(spark, d):
    raw = _momentum(spark, d).select(
        F.col("sector").alias("Sector_Name"), F.col("momentum_score").alias("Momentum"),
        F.col("window_days").alias("Window"), F.date_format("end_date", "yyyy-MM-dd").alias("Date"))
    return publish(clean.normalize_momentum(raw))


def _with_headers(spark, d):
    key = F.col("o_orderkey")
    return fx.table(spark, d, "orders").select(
        F.when(key % 97 == 0, "source").otherwise(F.col("o_orderpriority")).alias("source"),
        F.when(key % 89 == 0, " title ").when(key % 83 == 0, None).otherwise(F.col("o_orderstatus")).alias("title"),
        F.col("o_orderkey").alias("id"))


@query
def drop_header_rows_first(spark, d):
    return publish(clean.drop_header_rows(_with_headers(spark, d), "first"))


@query
def drop_header_rows_any(spark, d):
    return publish(clean.drop_header_rows(_with_headers(spark, d), "any"))


@query
def parse_dates(spark, d):
    key, ts = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    text = (
        F.when(key % 6 == 0, F.date_format(ts, "yyyy-MM-dd"))
        .when(key % 6 == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(key % 6 == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(key % 6 == 3, F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0530")))
        .when(key % 6 == 4, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("-05:00")))
        .otherwise(F.concat(F.date_format(ts, "dd/MM"), F.lit(" soon")))
    )
    df = fx.table(spark, d, "orders").select("o_orderkey", text.alias("raw"))
    return publish(df.select("o_orderkey", C.to_day(F.col("raw")).alias("day_key"), C.to_naive_ts(F.col("raw")).alias("ts"),
                             C.to_date_key(F.col("raw")).alias("day")))


@query
def norm_key(spark, d):
    padded = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))
    return publish(fx.table(spark, d, "customer").select("c_custkey", C.norm_key(padded).alias("key")))


@query
def clean_symbol(spark, d):
    raw = F.concat(F.lit(" sym"), "c_custkey", F.when(F.col("c_custkey") % 2 == 0, ".NS").otherwise(".BO"))
    return publish(fx.table(spark, d, "customer").select(
        "c_custkey", C.clean_symbol(raw).alias("symbol"), C.exchange_of(raw).alias("exchange")))


@query
def to_number(spark, d):
    text = F.when(F.col("o_orderkey") % 7 == 0, "n/a").when(F.col("o_orderkey") % 11 == 0, None).otherwise(
        F.col("o_totalprice").cast("string"))
    df = fx.table(spark, d, "orders").select("o_orderkey", text.alias("price"))
    return publish(clean.to_number(df, ["price"]))


@query
def to_number_if_all(spark, d):
    df = fx.table(spark, d, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("string").alias("all_numbers"),
        F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("some_numbers"))
    return publish(clean.to_number_if_all(df))


@query
def build_text(spark, d):
    df = fx.table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, None).otherwise(F.col("o_orderpriority")).alias("a"),
        F.when(F.col("o_orderkey") % 3 == 0, None).otherwise(F.concat(F.col("o_orderstatus"), F.lit(" "))).alias("b"))
    return publish(clean.build_text(df, ["a", "b"]), "o_orderkey", "text")


@query
def clean_html(spark, d):
    return publish(fx.table(spark, d, "pages").select("page_id", C.clean_html(F.col("html")).alias("text")))


@query
def sanitize_text(spark, d):
    return publish(fx.table(spark, d, "documents").select(
        "doc_id", C.sanitize_text(F.col("text"), 500).alias("title"), C.sanitize_text(F.col("text"), 1000).alias("body")))


@query
def epoch_text(spark, d):
    millis = (F.col("event_id") * 7_919 + 1_700_000_000_000).alias("ms")
    df = fx.table(spark, d, "events").select("event_id", millis)
    return publish(df.select(
        "event_id", C.epoch_to_iso(F.floor(F.col("ms") / 1000)).alias("iso"), C.epoch_ms_text(F.col("ms")).alias("readable"),
        C.fmt_duration(F.col("event_id") * 7_919).alias("duration")))


@query
def fill_defaults(spark, d):
    df = fx.table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("author"),
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("flair"),
        F.when(F.col("c_custkey") % 5 != 0, F.lit("S1")).alias("matched_tickers"))
    tags = F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit("A"), F.lit("B"))).otherwise(F.array().cast("array<string>"))
    return publish(clean.fill_defaults(df).withColumn("joined", C.or_general(tags)))


@query
def drop_null(spark, d):
    df = series.daily_return(fx.bars(spark, d)).select("ticker", "trade_date", "daily_return", "close_price")
    return publish(clean.drop_null(df, ["daily_return"]))


@query
def has_value(spark, d):
    text = F.when(F.col("o_orderkey") % 5 == 0, None).when(F.col("o_orderkey") % 3 == 0, "  ").otherwise(F.col("o_orderstatus"))
    df = fx.table(spark, d, "orders").select("o_orderkey", text.alias("tag"))
    return publish(df.filter(C.has_value(F.col("tag"))))


@query
def drop_general(spark, d):
    return publish(clean.drop_general(fx.sentiment(spark, d, general=True)), "ticker", "source_type", "source_id")


@query
def filter_view(spark, d):
    out = clean.filter_view(_stored(spark, d), "anomaly_date", "ALL", "1996-01-01", "1997-12-31", "price_volume_spike")
    return publish(out, *ANOMALY_COLUMNS)


@query
def filter_view_intraday(spark, d):
    """The end of the range is midnight, so events later on the last day are out."""
    ev = fx.intraday(spark, d)
    return publish(clean.filter_view(ev, "trade_date", "ALL", "2024-01-02", "2024-01-05"), "ticker", "close_price", "volume")


@query
def filter_basket(spark, d):
    return publish(clean.filter_basket(fx.bars(spark, d), ["S1", "S2", "S3", "S5"], "trade_date", "1996-01-01", "1996-12-31"),
                   "ticker", "trade_date", "close_price")


@query
def run_columns(spark, d):
    df = clean.with_typed_null(clean.with_run_columns(fx.dim(spark, d), "2024-01-01T00:00:00"), "sentiment_avg")
    return publish(clean.select_existing(df, ["ticker", "sector", "missing", "processed_at", "sentiment_avg"]))


# --- scalars -----------------------------------------------------------------------------------------

@query
def scalar_rules(spark, d):
    """Proxy, range, label, mood, mention, percent text, title and start date in one projection."""
    df = anomaly.score_anomalies(series.features(fx.bars(spark, d)))
    ret = F.col("daily_return")
    return publish(df.select(
        "ticker", "trade_date", S.price_proxy(ret).alias("proxy"),
        S.price_range(F.col("high_price"), F.col("low_price"), F.col("close_price")).alias("spread"),
        S.sentiment_label(ret, 0.05).alias("label"), S.market_mood(ret).alias("mood"),
        S.mentions(F.col("anomaly_type"), "VOLUME").alias("volume_type"), S.signed_pct(ret).alias("pct"),
        S.title_code(F.col("anomaly_type")).alias("title"), S.start_date(F.col("trade_date"), 30).alias("start_date")))


# --- landed files and batch jobs: tables are written as CSV to the shared folder, then read or run -------

def _landing(spark, d, *names: str) -> jobs.Paths:
    paths = jobs.Paths(f"{shared_folder(spark)}/landing-{uuid.uuid4().hex}")
    if "prices" in names:
        # Both folders are written from one aggregate.
        bars = materialize(fx.bars(spark, d), "bars").select(
            F.col("trade_date").alias("Date"), F.col("close_price").alias("Close"), F.col("high_price").alias("High"),
            F.col("low_price").alias("Low"), F.col("open_price").alias("Open"), F.col("volume").alias("Volume"),
            F.col("ticker").alias("Ticker"))
        # Two layouts in one folder, as from two fetchers.
        first = F.month("Date") <= 6
        sinks.write_dataset(bars.filter(first), paths.raw("prices/a"), fmt="csv")
        sinks.write_dataset(bars.filter(~first).select(
            "Date", "Open", "High", "Low", "Close", F.col("Close").alias("Adj Close"), "Volume", "Ticker",
            F.lit("NSE").alias("Exchange")), paths.raw("prices/b"), fmt="csv")
    if "news" in names:
        sinks.write_dataset(fx.news_refetched(spark, d).select(
            "title", "summary", "link", F.col("published_date").alias("published"), "source", "matched_tickers",
            "fetched_at"), paths.raw("news"), fmt="csv")
    if "reddit" in names:
        sinks.write_dataset(fx.posts(spark, d).drop("event_ts", "conv_id", "turn"), paths.raw("reddit"), fmt="csv")
    if "sentiment" in names:
        sinks.write_dataset(fx.sentiment(spark, d), paths.processed("sentiment"))
    if "intraday" in names:
        bars = fx.intraday(spark, d).select(
            F.date_format("trade_date", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("Date"), F.col("close_price").alias("Open"),
            F.col("high_price").alias("High"), F.col("low_price").alias("Low"), F.col("close_price").alias("Close"),
            F.col("volume").alias("Volume"), F.col("ticker").alias("Ticker"))
        # The bars of a ticker and day are spread over both folders.
        first = F.xxhash64("Date") % 2 == 0
        sinks.write_dataset(bars.filter(first), paths.raw("prices/a"), fmt="csv")
        sinks.write_dataset(bars.filter(~first).select("Ticker", "Date", "Volume", "Low", "High", "Open", "Close"),
                            paths.raw("prices/b"), fmt="csv")
        sinks.write_dataset(fx.intraday_sentiment(spark, d), paths.processed("sentiment"))
    return paths


@query
def read_prices_csv(spark, d):
    out = readers.read_prices(spark, _landing(spark, d, "prices").raw("prices/*"))
    return publish(out, "ticker", "trade_date", "open_price", "high_price", "low_price", "close_price", "volume")


@query
def read_news_csv(spark, d):
    out = readers.read_news(spark, _landing(spark, d, "news").raw("news"))
    return publish(out, "link", "source", "title", "summary", "published_date", "matched_tickers")


@query
def read_reddit_csv(spark, d):
    out = readers.read_reddit(spark, _landing(spark, d, "reddit").raw("reddit"))
    return publish(out, "post_id", "subreddit", "selftext", "created_utc", "matched_tickers")


def _raw_lines(rows: DataFrame, names: str, path: str, *fields) -> None:
    """CSV as another program writes it: text fields quoted, line ends inside them, and nothing checked."""
    quoted = [F.concat(F.lit('"'), F.replace(f, F.lit('"'), F.lit('""')), F.lit('"')) if isinstance(f, F.Column) else F.col(f) for f in fields]
    lines = rows.select(F.concat_ws(",", *quoted).alias("line")).withColumns({"file": F.pmod(F.xxhash64("line"), F.lit(4)), "at": F.lit(1)})
    heads = rows.sparkSession.range(4).select(F.lit(names).alias("line"), F.col("id").alias("file"), F.lit(0).alias("at"))
    # One file each, its header first.
    lines.unionByName(heads).repartition("file").sortWithinPartitions("file", "at").select("line", "file").write.partitionBy("file").text(path)


def _turns_landing(spark, d):
    """Conversations in two layouts; of every ten turns one has a field too many and one a turn that is no number."""
    path, turns = f"{shared_folder(spark)}/turns {uuid.uuid4().hex}", fx.table(spark, d, "conversations")
    kind = (F.col("conv_id") * 7 + F.col("turn")) % 10
    turn = F.when(kind == 3, F.concat(F.lit("no "), "turn")).otherwise(F.col("turn").cast("string"))
    rows = turns.withColumns({"t": turn, "more": F.when(kind == 5, F.lit("one,more"))})
    text, first = F.concat(F.lit('say "'), "role", F.lit('", '), "text"), F.col("conv_id") % 2 == 0
    _raw_lines(rows.where(first), "conv_id,turn,text", f"{path}/a, b", "conv_id", "t", text, "more")
    _raw_lines(rows.where(~first), '"Text", TURN ,Conv_ID', f"{path}/c", text, "t", "conv_id", "more")
    return f"{path}/*/*"


TURNS = "conv_id long, turn int, text string"


@query
def read_dir_bad_lines(spark, d):
    """Sound records by header name, rejected ones with their reason, from one reading."""
    good, rejects = readers.read_dir_parts(spark, _turns_landing(spark, d), TURNS)
    size = F.length("text").alias("size")
    sound = good.select(F.lit("sound").alias("kind"), "conv_id", "turn", F.md5("text").alias("digest"), size)
    out = rejects.select(F.col("reason").alias("kind"), F.lit(None).cast("long").alias("conv_id"), F.lit(None).cast("int").alias("turn"),
                         F.md5("record").alias("digest"), F.length("record").alias("size"))
    return publish(sound.unionByName(out))


@query
def read_or_empty(spark, d):
    """A stored CSV table with skipped malformed records, a stored Parquet table, and one that is not there."""
    path, parts = _turns_landing(spark, d), f"{shared_folder(spark)}/part-{uuid.uuid4().hex}"
    sinks.write_dataset(fx.table(spark, d, "part").select("p_partkey", "p_name"), parts)
    return publish(readers.read_or_empty(spark, path, TURNS, "csv").agg(
        F.count("*").alias("turns"), F.sum("turn").alias("total"), F.count("text").alias("texts")).crossJoin(
        readers.read_or_empty(spark, parts, "p_partkey long, p_name string").agg(F.count("*").alias("parts"), F.max("p_name").alias("last"))).crossJoin(
        readers.read_or_empty(spark, parts + "-none", "p_partkey long").agg(F.count("*").alias("none"))))


@query
def read_first_available(spark, d):
    """Of a missing folder, one without rows and two with rows the third."""
    path = f"{shared_folder(spark)}/first-{uuid.uuid4().hex}"
    parts = fx.table(spark, d, "part").select("p_partkey", "p_name", "p_type")
    sinks.write_dataset(parts.limit(0), f"{path}/empty", fmt="csv")
    sinks.write_dataset(parts.where("p_partkey % 2 = 0"), f"{path}/even", fmt="csv")
    sinks.write_dataset(parts.where("p_partkey % 2 = 1"), f"{path}/odd", fmt="csv")
    return publish(readers.read_first_available(spark, [f"{path}/{k}" for k in ("missing", "empty", "even", "odd")]))


@query
def read_ticker(spark, d):
    """Point load of one symbol from a dataset clustered by ticker; ticker filter and columns reach the scan."""
    path = f"{shared_folder(spark)}/bars-{uuid.uuid4().hex}"
    sinks.write_clustered(fx.bars(spark, d).withColumn("year", F.year("trade_date")), path, "ticker", ["trade_date"])
    return publish(readers.read_ticker(spark, path, " s1.NS"), "ticker", "trade_date", "close_price", "year")


@query
def etl_job(spark, d):
    paths = _landing(spark, d, "news")
    sinks.write_dataset(fx.ticks(spark, d).select(
        F.col("trade_date").alias("Date"), F.col("open_price").alias("Open"), F.col("high_price").alias("High"),
        F.col("low_price").alias("Low"), F.col("close_price").alias("Close"), F.col("volume").alias("Volume"),
        F.concat(F.lit(" "), F.lower("ticker")).alias("Ticker")), paths.raw("prices"), fmt="csv")
    return publish(jobs.run_etl(spark, paths)["news_price_aligned"])


@query
def sentiment_job(spark, d):
    out = jobs.run_sentiment(spark, _landing(spark, d, "news", "reddit"), "2024-01-01T00:00:00", fx.lexicon(spark))
    return publish(out["sentiment"])


@query
def anomaly_job(spark, d):
    paths = _landing(spark, d, "prices", "sentiment")
    return publish(jobs.run_anomalies(spark, paths, folder="prices/*")["anomalies"], *anomaly.OUTPUT)


@query
def anomaly_job_intraday(spark, d):
    """Several bars per ticker and day, of which every one counts."""
    paths = _landing(spark, d, "intraday")
    out = jobs.run_anomalies(spark, paths, folder="prices/*", hot_rows=30)
    return publish(out["anomalies"], *ANOMALY_COLUMNS, "sentiment_avg", "anomaly_ts")


@query
def momentum_job(spark, d):
    paths = _landing(spark, d, "prices", "sentiment")
    out = jobs.run_momentum(spark, paths, fx.dim(spark, d), "2024-01-01T00:00:00", folder="prices/*")
    return publish(out["momentum"], *MOMENTUM_COLUMNS)


@query
def strict_anomaly_job_intraday(spark, d):
    """Isolation forest over landed intraday bars, in pieces."""
    out = jobs.run_anomalies(spark, _landing(spark, d, "intraday"), True, 50, "prices/*", 30)
    return publish(out["anomalies"], *ANOMALY_COLUMNS, "sentiment_avg", "anomaly_ts")


@query
def momentum_job_intraday(spark, d):
    paths = _landing(spark, d, "intraday")
    out = jobs.run_momentum(spark, paths, fx.intraday_dim(spark, d), "2024-01-01T00:00:00", folder="prices/*", hot_rows=30)
    return publish(out["momentum"], *MOMENTUM_COLUMNS)


# --- streaming: files that land are processed once, up to the last one available --------------------

def _folders(spark):
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    return f"{root}/out", f"{root}/checkpoint"


def _posts_stream(spark, path, layout):
    landed = stream.read_landing(spark, path, layout, "parquet")
    # Every post is fetched twice, as by two sort modes of the same forum.
    fetched = landed.withColumn("fetch", F.explode(F.array(F.lit("hot"), F.lit("new"))))
    return fetched.select(
        F.concat("conv_id", F.lit("_"), "turn").alias("post_id"), F.col("role").alias("subreddit"),
        F.concat(F.lit("S"), "conv_id").alias("ticker"), fx.stamp(F.col("conv_id")).alias("event_ts"),
        ((F.col("conv_id") * 37 % 201 - 100) / F.lit(100.0)).alias("sentiment_score"))


@query
def stream_ingest(spark, d):
    """Three batches: the newest posts first, then the oldest, then the others; a tenth of each comes again in the next one."""
    posts, (out, checkpoint) = fx.table(spark, d, "conversations"), _folders(spark)
    landing = f"{shared_folder(spark)}/landing-{uuid.uuid4().hex}"
    third, again = F.floor(F.col("conv_id") * 37 % 2499 / 833), F.col("conv_id") % 10 == 0
    for k, (now, last) in enumerate([(2, None), (0, 2), (1, 0)]):
        come = (third == now) if last is None else (third == now) | ((third == last) & again)
        sinks.write_dataset(posts.filter(come), f"{landing}/{k}")
        landed = stream.stream_ingest(_posts_stream(spark, f"{landing}/*", posts.schema), out, checkpoint)
    return publish(landed, "post_id", "subreddit", "event_ts")


@query
def stream_daily_sentiment(spark, d):
    """Days the watermark has passed; the newest days stay open."""
    layout = fx.table(spark, d, "events").schema
    landed = stream.read_landing(spark, d, layout, "parquet", "events.parquet").select(
        F.concat(F.lit("U"), "user_id").alias("ticker"), F.col("ts").cast("timestamp").alias("event_ts"),
        (F.col("value") - 20).alias("sentiment_score"))
    return publish(stream.stream_daily_sentiment(landed, *_folders(spark)))
