"""Market-shaped views over the given tables: bars, news, posts, sentiment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.align import small
from tidemark.operators.clean import drop_general
from tidemark.operators.tagging import explode_tickers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


TICK_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.to_date("l_shipdate").alias("trade_date"),
        (100 * (1 + F.col("l_discount") - F.col("l_tax"))).alias("px"), *TICK_ORDER,
    )



def _ticker() -> Column:
    return F.concat(F.lit("S"), "l_suppkey").alias("ticker")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several one-price bars per ticker and day."""
    price = [F.col("px").alias(f"{c}_price") for c in ("open", "high", "low", "close")]
    return _ticks(spark, sf_dir).select(_ticker(), "trade_date", *price, F.col("l_quantity").alias("volume"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per ticker and day.

    First and last price come from min_by/max_by, which combine map-side, so a
    supplier with very many lines shrinks to its days before the shuffle. The
    grouping key stays a number until then, as that sorts faster than text.
    """
    order = F.struct(*TICK_ORDER)
    days = _ticks(spark, sf_dir).groupBy("l_suppkey", "trade_date").agg(
        F.min_by("px", order).alias("open_price"), F.max("px").alias("high_price"), F.min("px").alias("low_price"),
        F.max_by("px", order).alias("close_price"), F.sum("l_quantity").alias("volume"),
    )
    return days.select(_ticker(), *days.columns[1:])


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker and sector; every 17th ticker is unknown."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("sector"))
    return (
        table(spark, sf_dir, "supplier").filter(F.col("s_suppkey") % 17 != 0).join(small(nation), "s_nationkey")
        .select(F.concat(F.lit("S"), "s_suppkey").alias("ticker"), "sector")
    )


def _date_of(key: Column) -> Column:
    return F.date_add(F.lit("1995-01-02").cast("date"), (key * 37 % 2499).cast("int"))


def _tickers_of(spark: SparkSession, sf_dir: str, key: Column) -> Column:
    n = table(spark, sf_dir, "supplier").agg(F.count("*").alias("n")).scalar()
    first, second = F.concat(F.lit("S"), key % n), F.concat(F.lit("S"), (key * 7 + 3) % n)
    return F.when(key % 11 == 0, "GENERAL").otherwise(F.concat_ws(", ", first, second))


def stamp(key: Column) -> Column:
    return _date_of(key).cast("timestamp") + F.make_dt_interval(hours=(key % 24).cast("int"))


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.substring("text", 1, 80).alias("title"),
        F.expr("substring(text, 81)").alias("summary"), _date_of(key).alias("published_date"),
        key.cast("string").alias("link"), _tickers_of(spark, sf_dir, key).alias("matched_tickers"),
        stamp(key).alias("event_ts"), (stamp(key) + F.expr("INTERVAL 1 HOUR")).alias("fetched_at"),
    )


def news_refetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News of which every fifth article was fetched a second time a day later."""
    first = news(spark, sf_dir)
    again = first.filter(F.col("doc_id") % 5 == 0).withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 1 DAY"))
    return first.unionByName(again)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("conv_id")
    return table(spark, sf_dir, "conversations").select(
        F.col("role").alias("subreddit"), F.concat("conv_id", F.lit("_"), "turn").alias("post_id"),
        F.lit("").alias("title"), F.col("text").alias("selftext"), _date_of(key).alias("created_utc"),
        _tickers_of(spark, sf_dir, key).alias("matched_tickers"), stamp(key).alias("event_ts"),
        (stamp(key) + F.expr("INTERVAL 1 HOUR")).alias("fetched_at"), "conv_id", "turn",
    )


def sentiment(spark: SparkSession, sf_dir: str, general: bool = False) -> DataFrame:
    """Scored news and posts, one row per ticker. The score is a function of the key."""
    n = news(spark, sf_dir).select(
        F.lit("news").alias("source_type"), F.col("link").alias("source_id"), F.col("doc_id").alias("_k"),
        "matched_tickers", F.col("published_date").alias("event_date"), "event_ts")
    p = posts(spark, sf_dir).select(
        F.lit("reddit").alias("source_type"), F.col("post_id").alias("source_id"), F.col("conv_id").alias("_k"),
        "matched_tickers", F.col("created_utc").alias("event_date"), "event_ts")
    score = (F.col("_k") * 37 % 201 - 100) / F.lit(100.0)
    from tidemark.functions.scalars import sentiment_label

    out = explode_tickers(n.unionByName(p)).select(
        "source_type", "source_id", "ticker", score.alias("sentiment_score"),
        sentiment_label(score).alias("sentiment_label"), (F.col("_k") % 101 / F.lit(100.0)).alias("confidence"),
        "event_date", "event_ts",
    )
    return out if general else drop_general(out)


# Words that occur in the given texts, with a polarity and a subjectivity of our own choice.
FX_LEXICON = {
    "best": (1.0, 0.3), "worthless": (-0.8, 0.9), "stupid": (-0.8, 1.0), "idiot": (-0.8, 0.8),
    "rewh": (0.5, 0.5), "ment": (-0.25, 0.5), "eau": (0.75, 0.25), "tion": (-0.5, 0.75), "thand": (0.25, 0.5),
}
FX_NEGATORS = ("not", "no", "never", "nicht")

FX_KEYWORDS = [
    ("S1", "s1"), ("S1", "ment"), ("S2", "eau"), ("S2", "worthless"), ("S3", "idiot"), ("S3", "tion"),
    ("S4", "thtion"), ("S5", "ement"), ("S5", "éeau"), ("S6", "of the"), ("S7", "in"), ("S7", "stupid"),
    ("S8", "thbl"), ("S9", "ouonr"),
]


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w, p, s) for w, (p, s) in FX_LEXICON.items()],
                                 "word string, polarity double, subjectivity double")


def keywords(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FX_KEYWORDS, "ticker string, keyword string")


def intraday_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker and sector of the users; every 17th is unknown."""
    user = F.col("user_id")
    return table(spark, sf_dir, "events").filter(user % 17 != 0).select(
        F.concat(F.lit("U"), user).alias("ticker"), F.concat(F.lit("G"), user % 4).alias("sector")).distinct()


def intraday_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth event as a text about its user."""
    key = F.col("event_id")
    return table(spark, sf_dir, "events").filter(key % 10 == 0).select(
        F.concat(F.lit("U"), "user_id").alias("ticker"), F.to_date("ts").alias("event_date"),
        ((key * 37 % 201 - 100) / F.lit(100.0)).alias("sentiment_score"))


def intraday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an intraday series: user as ticker, value as price and size."""
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), "user_id").alias("ticker"), F.col("ts").cast("timestamp").alias("trade_date"),
        (value + 1).alias("close_price"), (value + 2).alias("high_price"), value.alias("low_price"),
        (value * 10).alias("volume"),
    )
