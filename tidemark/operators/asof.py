"""As-of join: for each row of one side the latest row of the other side before it, per key.

Both sides become one union, ordered in time, and a window carries the last right row forward. Neither side is paired with the
other, so a look-back of any length costs the same. A hot key is cut into pieces of time; over the border of a piece only one right row
travels: the last one of the pieces before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import split_hot

HOT_ROWS = 1_000_000


def last_before(left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str, values: tuple[str, ...] = (), prefix: str = "last_",
                same_time: bool = False, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """left(key, left_at, ...) with `<prefix><right_at>` and the right row's `values` at the latest right_at before left_at.

    Of right rows of one key and time the one with the greatest values counts. `same_time` lets a right row of the very same time
    count too. Rows whose key or time is null find nothing. One row comes out for each left row.
    """
    found = F.struct(F.col(right_at).cast("timestamp").alias("at"), *values)
    one = right.where(F.col(key).isNotNull() & F.col(right_at).isNotNull()).groupBy(key, F.col(right_at).cast("timestamp").alias("_at")).agg(
        F.max(found).alias("_right"))
    kind = left.select(F.struct(*left.columns).alias("row")).schema["row"].dataType
    own = left.select(key, F.col(left_at).cast("timestamp").alias("_at"), F.struct(*left.columns).alias("_left"))
    none = F.lit(None).cast(one.schema["_right"].dataType)
    # At one time the side that sorts first is seen by the other.
    both = own.select(key, "_at", "_left", none.alias("_right"), F.lit(1.0 if same_time else 0.0).alias("_side")).unionByName(
        one.select(key, "_at", F.lit(None).cast(kind).alias("_left"), "_right", F.lit(0.0 if same_time else 1.0).alias("_side")))
    parts = [key]
    if hot_rows is not None:
        both = split_hot(both, key, "_at", 0, hot_rows, "hour", ("_side",))
        parts.append("_piece")
    earlier = Window.partitionBy(*parts).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    rows = both.withColumn("_seen", F.last("_right", ignorenulls=True).over(earlier))
    if hot_rows is not None:
        # The last right row of each piece; there are as many as pieces.
        ends = both.where("_right IS NOT NULL").groupBy(key, "_piece").agg(F.max("_right").alias("_end"))
        every = both.select(key, "_piece").distinct().join(ends, parts, "left")
        before = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
        carried = every.withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).where("_carried IS NOT NULL").drop("_end")
        rows = rows.join(carried, parts, "left").withColumn("_seen", F.coalesce("_seen", "_carried"))
    out = [F.col("_seen.at").alias(f"{prefix}{right_at}"), *(F.col(f"_seen.{c}").alias(f"{prefix}{c}") for c in values)]
    return rows.where("_left IS NOT NULL").select("_left.*", *out)
