"""Ticker tags: exploding lists of tickers and finding tickers in text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import clean as C
from tidemark.operators.align import small
from tidemark.session import materialize

# A word is a run of letters, digits or underscore in any script;
# keywords of at most this many characters must stand alone.
NON_WORD = r"[^\p{L}\p{N}_]+"
SHORT = 4
# Fixed values end.


def explode_tickers(df: DataFrame, column: str = "matched_tickers", trim: bool = True) -> DataFrame:
    """One row per listed ticker. Untrimmed items keep their blanks, as a plain tokenizer would."""
    item = F.explode(F.split(column, ","))
    out = df.withColumn("ticker", item)
    if trim:
        out = out.withColumn("ticker", F.trim("ticker"))
    return out.filter(F.length("ticker") > 0)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), NON_WORD), "")


def _regex_literal(text: Column) -> Column:
    return F.regexp_replace(text, r"([^\p{L}\p{N}_\s])", r"\\$1")


def keyword_anchors(keywords: DataFrame) -> DataFrame:
    """For every keyword the word a text must show before it can match.

    The anchor is the longest word of the keyword. `exact` tells whether the
    text must hold it as a whole word (short keywords) or inside a word; `sure`
    that nothing but the anchor needs a check. A keyword without a word character
    is its own anchor: it can only lie inside a run of such characters.
    """
    kw = keywords.select(
        F.upper(F.trim("ticker")).alias("ticker"), F.lower(F.trim("keyword")).alias("kw")
    ).filter(F.length("kw") > 0).distinct()
    words = _words(F.col("kw"))
    by_length = F.array_sort(words, lambda a, b: F.length(b) - F.length(a))
    short = F.length("kw") <= SHORT
    bare = F.size(words) == 0
    one_word = (F.size(words) == 1) & (F.length(F.get(by_length, 0)) == F.length("kw"))
    return kw.select(
        "ticker", "kw", short.alias("short"), F.coalesce(F.get(by_length, 0), "kw").alias("anchor"),
        (short & ~bare).alias("exact"), (one_word | (bare & ~short)).alias("sure"), bare.alias("bare"),
    )


def tag_tickers(docs: DataFrame, keywords: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key, matched_tickers`: tickers of which a keyword occurs in the text.

    No text is compared with every keyword. The distinct words of the corpus
    (a vocabulary, far smaller than the texts) are matched with the anchors
    first, then texts meet that small table by word equality; only keywords of
    several words look at the text again, for the texts that hold the anchor.
    """
    anchors = keyword_anchors(keywords)
    exact = anchors.filter("exact").select("ticker", "kw", "short", "sure", F.col("anchor").alias("word"))
    # Inside-a-word anchors: an equi join on the first characters of the anchor, found at
    # any place of a vocabulary word, then an exact check. At most four lengths occur.
    loose = anchors.filter(~F.col("exact")).withColumn("probe", F.substring("anchor", 1, SHORT))
    kinds = loose.select(F.length("probe").alias("n"), "bare").distinct().collect()
    lengths = sorted({row.n for row in kinds})
    pieces = _words(F.col(text))
    if any(row.bare for row in kinds):
        pieces = F.concat(pieces, F.regexp_extract_all(F.lower(text), F.lit(NON_WORD), F.lit(0)))
    words = docs.select(key, F.explode(F.array_distinct(pieces)).alias("word"))

    def parts(n: int) -> Column:
        # A look-ahead matches at every character, so this yields all overlapping parts of n characters.
        return F.regexp_extract_all("word", F.lit("(?s)(?=(.{%d}))" % n), F.lit(1))

    grams = words.select("word").distinct().select(
        "word",
        F.explode(F.array_distinct(F.concat(F.array().cast("array<string>"), *[parts(n) for n in lengths]))).alias("probe"),
    )
    inside = (
        grams.join(small(loose), "probe").filter(F.contains(F.col("word"), F.col("anchor")))
        .select("ticker", "kw", "short", "sure", "word").distinct()
    )
    # Written once: both branches below read it, and its size decides about broadcasting.
    matches = materialize(exact.unionByName(inside), "keyword-words")
    hits = words.join(small(matches), "word")
    found = hits.filter("sure").select(key, "ticker")
    if not matches.filter(~F.col("sure")).isEmpty():
        candidates = hits.filter(~F.col("sure")).select(key, "ticker", "kw", "short").distinct()
        found = found.unionByName(_in_text(docs, candidates, key, text))
    tags = found.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("ticker")), ",").alias("matched_tickers"))
    return docs.select(key).join(tags, key, "left").withColumn(
        "matched_tickers", F.coalesce("matched_tickers", F.lit(C.GENERAL))
    )


def _in_text(docs: DataFrame, candidates: DataFrame, key: str, text: str) -> DataFrame:
    """Candidates whose keyword of several words is really in the text."""
    edge, off = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
    lowered = F.lower(F.col(text))
    # A boundary is asked for on the word-character ends of a short keyword, its other ends are free.
    pattern = F.concat(
        F.when(F.rlike(F.col("kw"), F.lit(r"^[\p{L}\p{N}_]")), edge).otherwise(r"(?<=[\p{L}\p{N}_])"),
        _regex_literal(F.col("kw")),
        F.when(F.rlike(F.col("kw"), F.lit(r"[\p{L}\p{N}_]$")), off).otherwise(r"(?=[\p{L}\p{N}_])"),
    )
    match = F.when(F.col("short"), F.rlike(lowered, pattern)).otherwise(F.contains(lowered, F.col("kw")))
    return candidates.join(docs.select(key, text), key).filter(match).select(key, "ticker")


# --- keyword tables ---------------------------------------------------------------------

def ticker_keywords(dim: DataFrame, aliases: DataFrame) -> DataFrame:
    """Each symbol in lower case as its own keyword, plus the aliases of known symbols."""
    own = dim.select("ticker", F.lower("ticker").alias("keyword"))
    known = aliases.join(dim.select("ticker"), "ticker", "left_semi").select("ticker", "keyword")
    return own.unionByName(known).distinct()


def keywords_from_names(df: DataFrame, symbol: str = "symbol", name: str = "company_name") -> DataFrame:
    """Symbol and first word of the company name, without legal forms; the word only if longer than 3.

    Fixed values: the legal forms that are removed.
    """
    bare = F.trim(F.regexp_replace(name, r"(?i)\b(ltd\.|limited|co\.|corporation|company)\b", ""))
    first = F.lower(F.try_element_at(F.split(bare, r"\s+"), F.lit(1)))
    words = F.array_compact(F.array(F.lower(F.trim(symbol)), F.when(F.length(first) > 3, first)))
    return (
        df.filter(C.has_value(F.col(symbol)))
        .select(F.trim(symbol).alias("ticker"), F.explode(F.array_distinct(words)).alias("keyword"))
        .distinct()
    )
