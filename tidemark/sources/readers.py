"""Readers. Landed CSV is bound by header name, never by position."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import clean as C
from tidemark.operators.clean import apply_aliases
from tidemark.session import materialize
from tidemark.sources import csvlines

# Headers of the landed files, by table column.
PRICE_HEADERS = {
    "trade_date": ("date", "trade_date"), "open_price": ("open", "open_price"), "high_price": ("high", "high_price"),
    "low_price": ("low", "low_price"), "close_price": ("close", "close_price"),
    "adj_close": ("adj close", "adj_close"), "volume": ("volume",), "ticker": ("ticker",), "exchange": ("exchange",),
}
NEWS_HEADERS = {
    "source": ("source",), "title": ("title",), "summary": ("summary",),
    "published_date": ("published_date", "published"), "link": ("link",), "matched_tickers": ("matched_tickers",),
    "fetched_at": ("fetched_at",),
}
# Fixed values end.


def read_named(spark: SparkSession, path: str, aliases: dict, uniform: bool = False, **options) -> DataFrame:
    """CSV folder as strings under the table's column names, bound by each file's own header.

    `uniform=True` trusts one header for all files and records of one line, and leaves the parsing to Spark's reader.
    """
    if not uniform:
        return csvlines.read_csv(spark, path, aliases, **options).select(*aliases)
    raw = apply_aliases(spark.read.options(header=True, quote='"', escape='"', **options).csv(path), aliases)
    return raw.select(*[
        F.trim(F.col(c)).alias(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in aliases])


def read_prices(spark: SparkSession, path: str, uniform: bool = False) -> DataFrame:
    """OHLCV bars with dates and numbers; header rows inside the data are dropped."""
    raw = read_named(spark, path, PRICE_HEADERS, uniform).filter(
        ~F.coalesce(F.lower("trade_date").isin("date", "trade_date"), F.lit(False)))
    ts = C.to_naive_ts(F.col("trade_date"))
    return raw.select(
        "ticker", F.to_date(ts).alias("trade_date"), ts.alias("ts"),
        *[C.number(F.col(c)).alias(c) for c in
          ("open_price", "high_price", "low_price", "close_price", "adj_close", "volume")],
        "exchange",
    )


def read_news(spark: SparkSession, path: str) -> DataFrame:
    raw = read_named(spark, path, NEWS_HEADERS)
    return raw.withColumn("published_date", F.to_date(C.to_naive_ts(F.col("published_date"))))


def read_reddit(spark: SparkSession, path: str) -> DataFrame:
    columns = [f.split()[0] for f in schema.REDDIT.split(", ")]
    raw = read_named(spark, path, {c: (c,) for c in columns})
    return raw.withColumns({
        "score": F.col("score").try_cast("int"), "upvote_ratio": C.number(F.col("upvote_ratio")),
        "num_comments": F.col("num_comments").try_cast("int"),
    })


def exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    try:
        spark.read.format(fmt).load(path).schema
        return True
    except AnalysisException:
        return False


def read_or_empty(spark: SparkSession, path: str, layout: str, fmt: str = "parquet") -> DataFrame:
    """Stored table, or a typed empty frame where there is none yet."""
    try:
        if fmt == "csv":
            return read_dir(spark, path, layout)
        return spark.read.schema(layout).format(fmt).load(path)
    except AnalysisException:
        return spark.createDataFrame([], layout)


def _checked(spark: SparkSession, path: str, layout: str | None, ignore_corrupt: bool) -> tuple[DataFrame, list[str]]:
    names = None if layout is None else [c.strip().split()[0] for c in layout.split(",")]
    rows = csvlines.read_csv(spark, path, None if names is None else {c: (c.lower(),) for c in names}, ignoreCorruptFiles=ignore_corrupt)
    names = names or rows.columns[:-3]
    return csvlines.typed(rows, layout or ", ".join(f"{c} string" for c in names)), names


def read_dir(spark: SparkSession, path: str, layout: str | None = None, ignore_corrupt: bool = True,
             bad_lines: str = "skip") -> DataFrame:
    """All CSV files of a directory, columns by header name. Unreadable files are skipped; malformed records
    are skipped, kept in `_corrupt_record` ("keep") or an error ("fail"), whichever columns are used later."""
    rows, names = _checked(spark, path, layout, ignore_corrupt)
    bad = F.col("_reason").isNotNull()
    if bad_lines == "skip":
        return rows.where(~bad).select(*names)
    if bad_lines == "keep":
        return rows.select(*names, F.when(bad, F.col("_record")).alias("_corrupt_record"))
    if bad_lines != "fail":
        raise ValueError(f"bad_lines: {bad_lines}")
    stop = F.raise_error(F.concat(F.lit("malformed record ("), "_reason", F.lit("): "), "_record")).cast("boolean")
    return rows.where(F.when(bad, stop).otherwise(True)).select(*names)


def read_dir_parts(spark: SparkSession, path: str, layout: str, ignore_corrupt: bool = True) -> tuple[DataFrame, DataFrame]:
    """The sound records of a directory, and the malformed ones with file and reason, from one reading."""
    rows, names = _checked(spark, path, layout, ignore_corrupt)
    rows = materialize(rows, "csv-records")
    rejects = rows.where("_reason IS NOT NULL").select(F.col("_file").alias("file"), F.col("_record").alias("record"), F.col("_reason").alias("reason"))
    return rows.where("_reason IS NULL").select(*names), rejects


def read_first_available(spark: SparkSession, paths: list[str], max_rows: int | None = None,
                         fmt: str = "csv") -> DataFrame | None:
    """The first location that exists and holds rows."""
    for path in paths:
        try:
            df = read_dir(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
        except AnalysisException:
            continue
        if not df.isEmpty():
            return df.limit(max_rows) if max_rows else df
    return None


def read_ticker(spark: SparkSession, path: str, ticker: str) -> DataFrame:
    """History of one symbol from stored Parquet; the filter reaches the scan."""
    symbol = ticker.replace(".NS", "").replace(".BO", "").strip().upper()
    return spark.read.parquet(path).filter(F.col("ticker") == symbol)


def register_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> list[str]:
    """Temporary views over the stored tables, and the two analytical views on them."""
    for name, layout in schema.TABLES.items():
        read_or_empty(spark, f"{root}/{name}", layout, fmt).createOrReplaceTempView(name)
    from tidemark.operators.aggregates import daily_ticker_sentiment
    from tidemark.operators.align import price_sentiment_joined

    daily = daily_ticker_sentiment(spark.table("sentiment_scores"))
    daily.createOrReplaceTempView("daily_ticker_sentiment")
    price_sentiment_joined(spark.table("stock_prices"), daily).createOrReplaceTempView("price_sentiment_joined")
    return [*schema.TABLES, "daily_ticker_sentiment", "price_sentiment_joined"]


def ticker_dim(spark: SparkSession, path: str) -> DataFrame:
    """`ticker, sector` from a CSV file of symbols; exchange suffixes are removed."""
    raw = csvlines.read_csv(spark, path, {c: (c,) for c in ("ticker", "sector")})
    return raw.select(C.clean_symbol(F.col("ticker")).alias("ticker"), F.trim("sector").alias("sector")).distinct()
