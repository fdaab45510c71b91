"""Frame-level cleaning: renames, header rows, nulls, filters, deduplication."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import clean as C
from tidemark.operators.series import top_per_key

# Column names and the aliases under which files carry them.
PRICE_ALIASES = {
    "trade_date": ("date", "trade_date"),
    "open_price": ("open", "open_price"),
    "high_price": ("high", "high_price"),
    "low_price": ("low", "low_price"),
    "close_price": ("close", "close_price", "adj close", "adj_close"),
    "volume": ("volume",),
    "ticker": ("ticker",),
}
SENTIMENT_ALIASES = {
    "ticker": ("ticker",),
    "event_date": ("event_date", "date", "published_date", "published"),
    "sentiment_score": ("sentiment_score", "score", "polarity"),
    "sentiment_label": ("sentiment_label", "label"),
}
ANOMALY_ALIASES = {
    "ticker": ("ticker",),
    "anomaly_date": ("anomaly_date", "trade_date", "date"),
    "close_price": ("close_price", "close"),
    "volume": ("volume",),
    "anomaly_score": ("anomaly_score", "score"),
    "anomaly_type": ("anomaly_type", "type"),
}
MOMENTUM_ALIASES = {
    "sector": ("sector", "sector_name"),
    "momentum_score": ("momentum_score", "momentum"),
    "window_days": ("window_days", "window"),
    "end_date": ("end_date", "date"),
}
PRICE_NUMBERS = ("open_price", "high_price", "low_price", "close_price", "volume")
ANOMALY_NUMBERS = ("anomaly_score", "close_price", "volume")
# Fixed values end.


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def apply_aliases(df: DataFrame, aliases: Mapping[str, Iterable[str]]) -> DataFrame:
    """Rename by case-insensitive alias; of several candidates the first column wins."""
    target = {alias: name for name, group in aliases.items() for alias in group}
    taken: set[str] = set()
    out = []
    for column in df.columns:
        name = target.get(column.strip().lower())
        if name and name not in taken:
            taken.add(name)
            out.append(F.col(f"`{column}`").alias(name))
        elif not name:
            out.append(F.col(f"`{column}`"))
    return df.select(*out)


def _normalize(df: DataFrame, aliases, dates: Iterable[str], numbers: Iterable[str]) -> DataFrame:
    df = apply_aliases(df, aliases)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    new: dict[str, Column] = {}
    if "ticker" in kinds:
        new["ticker"] = C.clean_symbol(F.col("ticker"))
    for name in dates:
        if isinstance(kinds.get(name), T.StringType):
            new[name] = C.to_naive_ts(F.col(name))
        elif name in kinds:
            new[name] = F.col(name).cast("timestamp")
    for name in numbers:
        if name in kinds:
            new[name] = C.number(F.col(name))
    return df.withColumns(new) if new else df


def normalize_prices(df: DataFrame) -> DataFrame:
    return _normalize(df, PRICE_ALIASES, ["trade_date"], PRICE_NUMBERS)


def normalize_sentiment(df: DataFrame) -> DataFrame:
    return _normalize(df, SENTIMENT_ALIASES, ["event_date"], ["sentiment_score"])


def normalize_anomalies(df: DataFrame) -> DataFrame:
    out = _normalize(df, ANOMALY_ALIASES, ["anomaly_date"], ANOMALY_NUMBERS)
    return out.withColumn("anomaly_type", F.trim("anomaly_type")) if "anomaly_type" in out.columns else out


def normalize_momentum(df: DataFrame) -> DataFrame:
    return _normalize(df, MOMENTUM_ALIASES, ["end_date"], ["momentum_score", "window_days"])


def require_columns(df: DataFrame, columns: Iterable[str], empty: bool = False) -> DataFrame:
    """The frame itself when all columns exist; else an error, or no rows."""
    missing = [c for c in columns if c not in df.columns]
    if not missing:
        return df
    if empty:
        return df.limit(0)
    raise ValueError(f"missing columns: {', '.join(missing)}")


def drop_header_rows(df: DataFrame, mode: str = "any") -> DataFrame:
    """Drop rows that repeat the header: in the first column, or in any column."""
    columns = df.columns[:1] if mode == "first" else df.columns
    for column in columns:
        same = F.trim(F.col(f"`{column}`").cast("string")) == column
        df = df.filter(~F.coalesce(same, F.lit(False)))
    return df


def to_number(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: C.number(F.col(c)) for c in columns})


def to_number_if_all(df: DataFrame) -> DataFrame:
    """Convert the text columns of which every value is a number.

    One aggregate decides for all columns; only its single row reaches the driver.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df
    bad = df.agg(*[
        F.count_if(F.col(c).isNotNull() & C.number(F.col(c)).isNull()).alias(c) for c in texts
    ]).first()
    return to_number(df, [c for c in texts if bad[c] == 0])


def build_text(df: DataFrame, columns: Iterable[str], name: str = "text") -> DataFrame:
    """Join the text columns; rows without any text are dropped."""
    return df.withColumn(name, C.joined_text(*[F.col(c) for c in columns])).filter(F.length(name) > 0)


def fill_defaults(df: DataFrame) -> DataFrame:
    """The default of each optional forum or news field."""
    defaults = {"author": "[deleted]", "flair": "", "matched_tickers": C.GENERAL}
    new = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if c in df.columns}
    return df.withColumns(new) if new else df


def drop_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.dropna(subset=subset)


def drop_general(df: DataFrame) -> DataFrame:
    return df.filter(F.col("ticker") != C.GENERAL)


def filter_view(df: DataFrame, day: str, ticker: str = "ALL", start: str | None = None,
                end: str | None = None, kind: str = "All") -> DataFrame:
    """Ticker, inclusive date range and anomaly type; "ALL"/"All" mean no filter.

    The end is midnight of its day, so later bars of that day are outside.
    """
    if ticker != "ALL":
        df = df.filter(F.col("ticker") == ticker)
    if start and end:
        df = df.filter(F.col(day).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    if kind != "All":
        df = df.filter(F.col("anomaly_type") == kind)
    return df


def filter_basket(df: DataFrame, tickers: list[str], day: str, start: str, end: str) -> DataFrame:
    return filter_view(df.filter(F.col("ticker").isin(tickers)), day, start=start, end=end)


def with_run_columns(df: DataFrame, ts: str, name: str = "processed_at") -> DataFrame:
    """Stamp rows with the run time, which the caller passes in."""
    return df.withColumn(name, F.lit(ts))


def with_typed_null(df: DataFrame, name: str, kind: str = "double") -> DataFrame:
    return df.withColumn(name, F.lit(None).cast(kind))


def select_existing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


# --- deduplication -------------------------------------------------------------------
# "First row per key" keeps one row per key and map task before the shuffle, so a
# group of copies of any size stays cheap.

def dedupe(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key. What `order` leaves open a hash of the row decides, so the
    survivor is the same in every run and unused text columns are not shuffled."""
    rest = [c for c in df.columns if c not in keys]
    return top_per_key(df, keys, [*order, F.xxhash64(*rest)])


def dedupe_prices(df: DataFrame) -> DataFrame:
    """The bar with the highest volume per ticker and day; of equal ones the lowest prices."""
    prices = [F.col(c) for c in ("close_price", "open_price", "high_price", "low_price") if c in df.columns]
    return dedupe(df, ["ticker", "trade_date"], [F.col("volume").desc_nulls_last(), *prices])


def dedupe_news(df: DataFrame, keys: tuple[str, ...] = ("title", "published_date")) -> DataFrame:
    return dedupe(df, list(keys), [F.col("fetched_at"), F.col("link")])


def dedupe_posts(df: DataFrame) -> DataFrame:
    return dedupe(df, ["post_id"], [F.col("fetched_at")])


# --- set operations --------------------------------------------------------------------

def union_all(frames: list[DataFrame]) -> DataFrame:
    """Concatenate frames whose columns differ; missing ones become NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
