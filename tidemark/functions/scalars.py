"""Column expressions over returns, ratios and sentiment scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds of the anomaly, proxy and label rules (all strict).
PRICE_MOVE = 0.03
SPIKE_RATIO = 2.0
SURGE_RATIO = 2.5
KEEP_SCORE = 2.5
KEEP_MOVE = 0.035
PROXY_BAND = 0.01
LABEL_BAND = 0.1
KPI_BAND = 0.05
# Fixed values end.


def simple_return(close: Column, previous: Column) -> Column:
    """Relative change; NULL when there is no previous value or it is zero."""
    return F.try_divide(close - previous, previous)


def price_range(high: Column, low: Column, close: Column) -> Column:
    return F.try_divide(high - low, close)


def price_proxy(ret: Column, band: float = PROXY_BAND) -> Column:
    """Sign of a return outside a dead band, as a stand-in for sentiment."""
    return F.when(ret > band, F.lit(1.0)).when(ret < -band, F.lit(-1.0)).otherwise(F.lit(0.0))


def anomaly_type(ret: Column, ratio: Column) -> Column:
    moved = F.abs(ret) > PRICE_MOVE
    return (
        F.when(moved & (ratio > SPIKE_RATIO), "price_volume_spike")
        .when(moved, "price_spike")
        .when(ratio > SURGE_RATIO, "volume_surge")
        .otherwise("statistical_outlier")
    )


def sentiment_label(score: Column, band: float = LABEL_BAND) -> Column:
    return F.when(score > band, "positive").when(score < -band, "negative").otherwise("neutral")


def market_mood(score: Column, band: float = KPI_BAND) -> Column:
    return F.when(score > band, "Bullish").when(score < -band, "Bearish").when(score.isNotNull(), "Neutral")


def _oversold(ret: Column, sentiment: Column) -> Column:
    return (ret < -PRICE_MOVE) & (sentiment > LABEL_BAND)


def _overbought(ret: Column, sentiment: Column) -> Column:
    return (ret > PRICE_MOVE) & (sentiment < -LABEL_BAND)


def divergence_type(ret: Column, sentiment: Column, kind: Column) -> Column:
    """Price and mood pointing in opposite directions override the type."""
    return (
        F.when(_oversold(ret, sentiment), "bearish_divergence")
        .when(_overbought(ret, sentiment), "bullish_divergence")
        .otherwise(kind)
    )


def describe(ret: Column, ratio: Column, sentiment: Column, kind: Column, advice: str = " signal") -> Column:
    """One sentence per anomaly. The wording and the decimals."""
    pct = F.format_number(F.abs(ret) * 100, 1)
    mood = F.format_number(sentiment, 2)
    down = F.concat(
        F.lit("⚠️ DIVERGENCE: Price down "), pct, F.lit("% but sentiment positive ("),
        mood, F.lit(f") — potential oversold{advice}"),
    )
    up = F.concat(
        F.lit("⚠️ DIVERGENCE: Price up "), pct, F.lit("% but sentiment negative ("),
        mood, F.lit(f") — potential overbought{advice}"),
    )
    plain = F.concat(
        kind, F.lit(" detected: return="), F.format_number(ret * 100, 1),
        F.lit("%, vol_ratio="), F.format_number(ratio, 1),
    )
    return F.when(_oversold(ret, sentiment), down).when(_overbought(ret, sentiment), up).otherwise(plain)


def fixed(value: Column, decimals: int) -> Column:
    """Number as text, ties to the even digit, without thousands separators."""
    return F.call_function("format_number", value, F.lit("0." + "0" * decimals))


def round_even(value: Column, decimals: int) -> Column:
    """Rounding of the binary value with ties to the even digit."""
    return fixed(value, decimals).cast("double")


def signed_pct(value: Column) -> Column:
    """A fraction as percent text with its sign, one decimal."""
    return F.concat(F.when(value < 0, "-").otherwise("+"), fixed(F.abs(value) * 100, 1), F.lit("%"))


def title_code(code: Column) -> Column:
    return F.initcap(F.replace(code, F.lit("_"), F.lit(" ")))


def start_date(end: Column, days: int | Column) -> Column:
    return F.date_sub(end, days)


def mentions(text: Column, word: str) -> Column:
    """Case-insensitive contains; NULL text does not mention anything."""
    return F.coalesce(F.contains(F.lower(text), F.lit(word.lower())), F.lit(False))
