"""Row-frame windows over one time series per key.

A daily series has at most one row per key and day, so one key never holds
more rows than the calendar has days and a plain window partition is bounded.
An intraday series has no such bound. `over_series(..., hot_rows=n)` cuts the
series of every key above n rows into pieces that start with a copy of the
rows their frames look back on, so no task sees a whole hot series.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.session import materialize

KEY, ORDER = "ticker", "trade_date"


def series(*parts: str, order: str = ORDER, tie: tuple[str, ...] = ()):
    return Window.partitionBy(*(parts or (KEY,))).orderBy(order, *tie)


def last_rows(spec, n: int):
    """Frame of the current row and the n-1 rows before it."""
    return spec.rowsBetween(-(n - 1), 0)


#: Cuts that a time with more than hot_rows rows gets for each hot_rows of them.
SLOTS = 4
#: Rows that a task sorts for its windows.
TASK_ROWS = 500_000
#: Cells of the map that are sent to every task; files of a map tell little of the memory it takes.
BROADCAST_CELLS = 100_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """`df`, of about `rows` rows, dealt by `keys` to as many tasks as its rows ask for; a small one is left to Spark."""
    if rows <= TASK_ROWS:
        return df
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS)), *keys)


def _counted(rows: DataFrame, by: list[str], part: str, hot_rows: int, name: str, seen: Observation | None = None) -> DataFrame:
    """Counts of `part` within `by`, with the rows of the key before (`_before`) and up to (`_after`) each of them. `seen` gets
    the number of all rows."""
    first = "_from" not in rows.columns
    spec = Window.partitionBy(*by)
    counts = rows.groupBy(*by, part, *([] if first else ["_from"])).agg(F.count("*").alias("_n"))
    if seen is not None:
        counts = counts.observe(seen, F.sum("_n").alias("rows"))
    so_far = F.sum("_n").over(spec.orderBy(part).rowsBetween(Window.unboundedPreceding, 0)) + (F.lit(0) if first else F.col("_from"))
    out = counts.withColumns({"_after": so_far, "_total": F.sum("_n").over(spec)}).withColumn("_before", F.col("_after") - F.col("_n"))
    return materialize(out.filter(F.col("_total") > hot_rows).select(*by, part, "_n", "_before", "_after"), name)


def split_hot(df: DataFrame, key: str, order: str, look_back: int, hot_rows: int, grain: str, tie: tuple[str, ...] = ()) -> DataFrame:
    """Tag rows with a piece number and deal them by key and piece; look-back copies carry `_copy = true`.

    Cuts come from counts that are refined level by level: per period, in periods of more than `hot_rows` rows per second, in such
    seconds per time stamp, and at one time stamp per range of the first tie column (of the rows' hash `_rank`, if there is no
    tie). Each window over counts is bounded by the calendar or by the number of ranges. Keys below `hot_rows` are not in the map
    and stay one piece. Small jobs run when this is called, one for each level that is needed.
    """
    if look_back > hot_rows:
        raise ValueError("hot_rows must be at least the look-back")
    time = F.col(order).cast("timestamp")
    rows = df.withColumns({"_l0": F.date_trunc(grain, time), "_l1": F.date_trunc("second", time), "_l2": time})
    if not tie:
        rows = rows.withColumn("_rank", F.xxhash64(*df.columns))
    rank = F.col(tie[0] if tie else "_rank").cast("double")

    def within(levels: DataFrame, by: str) -> DataFrame:
        """Rows of the parts that are too big, with the rows before the part."""
        return rows.join(levels.filter(F.col("_n") > hot_rows).select(key, by, F.col("_before").alias("_from")), [key, by])

    seen = Observation("rows")
    levels = [_counted(rows, [key], "_l0", hot_rows, "hot-periods", seen)]
    size = seen.get["rows"] or 0
    for k in (1, 2):
        if levels[-1].filter(F.col("_n") > hot_rows).isEmpty():
            break
        levels.append(_counted(within(levels[-1], f"_l{k - 1}"), [key, f"_l{k - 1}"], f"_l{k}", 0, "hot-times"))
    slots = None
    if len(levels) == 3 and not levels[2].filter(F.col("_n") > hot_rows).isEmpty():
        big = within(levels[2], "_l2").withColumn("_v", rank)
        most = int(levels[2].agg(F.max("_n")).first()[0]) * SLOTS // hot_rows
        shares = F.array(*(F.lit(x / (most + 1)) for x in range(1, most + 1)))
        bounds = materialize(big.groupBy(key, "_l2").agg(F.array_distinct(F.percentile_approx("_v", shares, F.lit(10_000))).alias("_bounds")), "hot-bounds")
        # Nulls come first, as in the window's order.
        slot = F.when(F.col("_v").isNull(), 0).otherwise(1 + F.size(F.filter("_bounds", lambda x: x < F.col("_v"))))
        rows = rows.join(bounds, [key, "_l2"], "left").withColumn("_v", rank)
        rows = rows.withColumn("_slot", F.when(F.col("_bounds").isNotNull(), slot)).drop("_bounds", "_v")
        slots = _counted(within(levels[2], "_l2").where("_slot IS NOT NULL"), [key, "_l2"], "_slot", 0, "hot-slots")

    # Every row lies in one cell: a part that is small enough, or one that cannot be refined.
    cells = []
    for k, level in enumerate(levels):
        refined = k + 1 < len(levels) or slots is not None
        own = level.filter(F.col("_n") <= hot_rows) if refined else level
        cells.append(own.select(key, F.lit(k).alias("_level"), F.col(f"_l{k}").alias("_t"), F.lit(None).cast("int").alias("_slot"), "_before", "_after"))
    if slots is not None:
        cells.append(slots.select(key, F.lit(3).alias("_level"), F.col("_l2").alias("_t"), "_slot", "_before", "_after"))
    counts = cells[0]
    for more in cells[1:]:
        counts = counts.unionByName(more)
    # One dealing by key serves all that is done with the counts.
    counts = dealt(counts.withColumn("_piece", F.floor(F.col("_before") / hot_rows)), counts.count(), key)
    pieces = Window.partitionBy(key).orderBy("_piece")
    starts = (
        counts.groupBy(key, "_piece").agg(F.min("_before").alias("_start"))
        .withColumn("_next", F.array(*[
            F.struct(F.lead("_piece", k).over(pieces).alias("piece"), F.lead("_start", k).over(pieces).alias("start"))
            for k in (1, 2)
        ]))
    )
    # A look-back never reaches over more than two piece starts, as pieces start hot_rows apart on average
    # and each slot of hot_rows holds one start.
    reach = F.filter("_next", lambda x: x["piece"].isNotNull() & (x["start"] < F.col("_after") + look_back))
    targets = F.concat(
        F.array(F.struct(F.col("_piece").alias("piece"), F.lit(False).alias("copy"))),
        F.transform(reach, lambda x: F.struct(x["piece"].alias("piece"), F.lit(True).alias("copy"))),
    )
    where = materialize(counts.join(starts, [key, "_piece"]).select(key, "_level", "_t", "_slot", targets.alias("_targets")), "hot-pieces")
    found = []
    for k in range(len(cells)):
        at, more = ("_l2", ["_slot"]) if k == 3 else (f"_l{k}", [])
        own = where.filter(F.col("_level") == k).select(key, F.col("_t").alias(at), *more, F.col("_targets").alias(f"_targets{k}"))
        few = own.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS
        rows = rows.join(own.hint("broadcast" if few else "merge"), [key, at, *more], "left")
        found.append(f"_targets{k}")
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("piece"), F.lit(False).alias("copy")))
    tagged = (
        rows.withColumn("_target", F.explode(F.coalesce(*found, whole)))
        .withColumns({"_piece": F.col("_target.piece"), "_copy": F.col("_target.copy")})
        .drop("_l0", "_l1", "_l2", "_slot", "_target", *found)
    )
    return dealt(tagged, size, key, "_piece")


def over_series(
    df: DataFrame,
    columns: Callable[[object], list[list[Column]]],
    *,
    key: str = KEY,
    order: str = ORDER,
    look_back: int,
    hot_rows: int | None = None,
    grain: str = "hour",
    tie: tuple[str, ...] = (),
) -> DataFrame:
    """Append window columns; one exchange, one sort.

    `columns(spec)` returns one list per level; a level may use the columns of
    the level before it. `tie` orders rows of one key that have the same time.
    """
    parts, source = (key,), df
    if hot_rows is not None:
        parts, source = (key, "_piece"), split_hot(df, key, order, look_back, hot_rows, grain, tie)
        tie = tie or ("_rank",)
    spec = series(*parts, order=order, tie=tie)
    for level in columns(spec):
        source = source.select("*", *level)
    if hot_rows is not None:
        source = source.filter(~F.col("_copy")).drop("_piece", "_copy", "_rank")
    return source


# --- returns and rolling features -------------------------------------------------

def _return_cols(spec, close: str = "close_price") -> list[list[Column]]:
    return [
        [F.lag(close, 1).over(spec).alias("prev_close")],
        [S.simple_return(F.col(close), F.col("prev_close")).alias("daily_return")],
    ]


def daily_return(df: DataFrame, **kw) -> DataFrame:
    return over_series(df, _return_cols, look_back=1, **kw)


def volatility(df: DataFrame, n: int = 7, **kw) -> DataFrame:
    """Sample standard deviation of the last n returns."""
    def cols(spec):
        return _return_cols(spec) + [[F.stddev_samp("daily_return").over(last_rows(spec, n)).alias(f"volatility_{n}d")]]
    return over_series(df, cols, look_back=n, **kw)


def _volume_cols(spec) -> list[list[Column]]:
    return [
        [F.avg("volume").over(last_rows(spec, n)).alias(f"avg_volume_{n}d") for n in (7, 20)],
        [F.try_divide(F.col("volume"), F.col("avg_volume_20d")).alias("volume_ratio")],
    ]


def volume_features(df: DataFrame, **kw) -> DataFrame:
    return over_series(df, _volume_cols, look_back=20, **kw)


def _average_cols(spec) -> list[list[Column]]:
    return [
        [F.avg("close_price").over(last_rows(spec, n)).alias(f"sma_{n}") for n in (7, 20)],
        [F.try_divide(F.col("sma_7") - F.col("sma_20"), F.col("sma_20")).alias("ma_crossover")],
    ]


def moving_averages(df: DataFrame, **kw) -> DataFrame:
    return over_series(df, _average_cols, look_back=20, **kw)


FEATURES = ["daily_return", "volatility_7d", "volume_ratio", "price_range", "ma_crossover"]
NEEDED = ["daily_return", "volatility_7d", "volume_ratio", "ma_crossover"]


def features(df: DataFrame, volatility_rows: tuple[int, ...] = (7,), **kw) -> DataFrame:
    """Return, volatility, volume and moving-average features of every bar.

    All frames share one partitioning and one order, so the plan has a single
    exchange and a single sort. Frames at the start of a series average what is there.
    """
    def cols(spec):
        first, ratio = _return_cols(spec)
        volumes, volume_ratio = _volume_cols(spec)
        averages, crossover = _average_cols(spec)
        return [
            first + volumes + averages,
            ratio + volume_ratio + crossover + [
                S.price_range(F.col("high_price"), F.col("low_price"), F.col("close_price")).alias("price_range")
            ],
            [F.stddev_samp("daily_return").over(last_rows(spec, n)).alias(f"volatility_{n}d") for n in volatility_rows],
        ]
    return over_series(df, cols, look_back=max(20, *volatility_rows) + 1, **kw).dropna(subset=NEEDED)


# --- windows that wait for enough values --------------------------------------------

def when_enough(agg: Column, value: str, spec, n: int, min_periods: int) -> Column:
    """`agg` over the last n rows, NULL until min_periods of them have a value."""
    frame = last_rows(spec, n)
    return F.when(F.count(value).over(frame) >= min_periods, agg.over(frame))


def rolling(df: DataFrame, value: str, n: int, min_periods: int | None = None, **kw) -> DataFrame:
    """Rolling mean and sample deviation of one column under the min-periods rule."""
    need = n if min_periods is None else min_periods
    def cols(spec):
        return [[
            when_enough(F.avg(value), value, spec, n, need).alias("rolling_mean"),
            when_enough(F.stddev_samp(value), value, spec, n, need).alias("rolling_std"),
        ]]
    return over_series(df, cols, look_back=n, **kw)


def min_history(df: DataFrame, rows: int = 30, key: str = KEY) -> DataFrame:
    """Keep the keys that have at least `rows` rows.

    Counting combines map-side; the semi join lets AQE split a hot key.
    """
    enough = df.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") >= rows).select(key)
    return df.join(enough, key, "left_semi")


def full_windows(df: DataFrame, rows: int = 30, **kw) -> DataFrame:
    """Features with full windows only, of keys with at least `rows` rows. Rows are counted per key with partial aggregates, never in
    a window over a series; as they are read for that too, they are computed once and kept in the shared folder."""
    def cols(spec):
        first, ratio = _return_cols(spec)
        return [
            first + [
                when_enough(F.avg("volume"), "volume", spec, 20, 20).alias("avg_volume_20d"),
                when_enough(F.avg("close_price"), "close_price", spec, 7, 7).alias("sma_7"),
                when_enough(F.avg("close_price"), "close_price", spec, 20, 20).alias("sma_20"),
            ],
            ratio + [
                F.try_divide(F.col("volume"), F.col("avg_volume_20d")).alias("volume_ratio"),
                S.price_range(F.col("high_price"), F.col("low_price"), F.col("close_price")).alias("price_range"),
                F.try_divide(F.col("sma_7") - F.col("sma_20"), F.col("sma_20")).alias("ma_crossover"),
            ],
            [when_enough(F.stddev_samp("daily_return"), "daily_return", spec, 7, 7).alias("volatility_7d")],
        ]
    bars = materialize(df, "strict-bars")
    if kw.get("hot_rows") is None:  # one dealing serves the join and the windows
        bars = dealt(bars, bars.count(), KEY)
    return over_series(min_history(bars, rows), cols, look_back=21, **kw).dropna(subset=NEEDED)


def strict_features(df: DataFrame, rows: int = 30, **kw) -> DataFrame:
    """Features with full windows only, for keys with enough history before and after. They are computed once, too."""
    return min_history(materialize(full_windows(df, rows, **kw), "strict-features"), rows)


def zscore_features(df: DataFrame, n: int = 20, min_periods: int = 5, **kw) -> DataFrame:
    """Rolling z-score of the return and volume ratio, with the fallbacks
    ratio 1, deviation 0.01 (also for 0) and z 0."""
    def cols(spec):
        first, ratio = _return_cols(spec)
        return [
            first + [when_enough(F.avg("volume"), "volume", spec, n, min_periods).alias("_volume_mean")],
            ratio + [F.coalesce(F.try_divide(F.col("volume"), F.col("_volume_mean")), F.lit(1.0)).alias("volume_ratio")],
            [
                when_enough(F.avg("daily_return"), "daily_return", spec, n, min_periods).alias("_mean"),
                F.coalesce(
                    F.nullif(when_enough(F.stddev_samp("daily_return"), "daily_return", spec, n, min_periods), F.lit(0.0)),
                    F.lit(0.01),
                ).alias("_std"),
            ],
            [F.coalesce((F.col("daily_return") - F.col("_mean")) / F.col("_std"), F.lit(0.0)).alias("z_score")],
        ]
    return over_series(df, cols, look_back=n + 1, **kw).drop("_volume_mean", "_mean", "_std")


# --- positions within a series --------------------------------------------------------

def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str = "_rank") -> DataFrame:
    """row_number per key. Followed by `<= k` Spark keeps k rows per key before
    the shuffle as well, so a hot key sends k rows per map task."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    return ranked(df, keys, order).filter(F.col("_rank") <= k).drop("_rank")


def tail_per_ticker(df: DataFrame, n: int, order: str = ORDER) -> DataFrame:
    return top_per_key(df, [KEY], [F.col(order).desc()], n)


def nth_from_end(df: DataFrame, k: int, value: str = "close_price", order: str = ORDER) -> DataFrame:
    """Latest value and the k-th from the end, else the oldest one there is."""
    tail = ranked(df, [KEY], [F.col(order).desc()]).filter(F.col("_rank") <= k)
    return tail.groupBy(KEY).agg(
        F.max(F.when(F.col("_rank") == 1, F.col(value))).alias("latest"),
        F.max_by(value, "_rank").alias("nth_value"),
        F.max("_rank").alias("rows_seen"),
    )


def latest_versions(df: DataFrame, keys: list[str], ts: str, versions: int, ttl_seconds: int | None = None,
                    as_of: Column | None = None, tie: list[Column] | None = None) -> DataFrame:
    """The newest versions of every key that have not outlived the time to live."""
    if ttl_seconds is not None:
        df = df.filter(F.col(ts) >= as_of - F.make_dt_interval(secs=F.lit(ttl_seconds)))
    return top_per_key(df, keys, [F.col(ts).desc(), *(tie or [])], versions)


def base100(df: DataFrame, order: str = ORDER) -> DataFrame:
    """Close as percent of the first close of the series, if that is positive.

    The first close combines map-side; the join back is on a key AQE may split.
    """
    first = df.groupBy(KEY).agg(F.min_by("close_price", order).alias("first_close"))
    return (
        df.join(first.filter(F.col("first_close") > 0), KEY)
        .withColumn("normalized_return", F.col("close_price") / F.col("first_close") * 100)
    )


def standardize(df: DataFrame, columns: list[str], by: str = KEY) -> DataFrame:
    """(x - mean) / population deviation per key; a deviation of 0 counts as 1."""
    stats = df.groupBy(by).agg(*[
        agg(c).alias(f"_{tag}_{c}") for c in columns for tag, agg in (("m", F.avg), ("s", F.stddev_pop))
    ])
    scaled = {
        f"{c}_z": (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") == 0, 1.0).otherwise(F.col(f"_s_{c}"))
        for c in columns
    }
    return df.join(stats, by).withColumns(scaled).drop(*stats.columns[1:])
