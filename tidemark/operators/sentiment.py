"""Text features and lexicon sentiment."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.ml.feature import IDF, HashingTF, IDFModel, RegexTokenizer, StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.functions import words as W
from tidemark.functions.clean import has_value
from tidemark.operators.align import small
from tidemark.operators.clean import build_text, drop_general
from tidemark.operators.tagging import explode_tickers
from tidemark.session import materialize

BUCKETS = 4096
#: Bytes of text whose words a task counts.
TASK_TEXT = 16 << 20


def words_of(text: Column) -> Column:
    """Lower-case words, split where the tokenizer of Spark ML splits."""
    return F.array_remove(F.split(F.lower(text), r"\W+"), "")


def tokenize(df: DataFrame, text: str = "text", name: str = "words") -> DataFrame:
    return df.withColumn(name, words_of(F.col(text)))


def remove_stopwords(df: DataFrame, words: str = "words", name: str = "filtered_words",
                     stop: Iterable[str] = W.STOP_WORDS) -> DataFrame:
    # isin with a literal list is a hash lookup per word, inside generated code.
    return df.withColumn(name, F.filter(words, lambda w: ~w.isin(*stop)))


def hashing_tf(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Sparse term-frequency vectors over hashed words without stop words."""
    df = RegexTokenizer(inputCol=text, outputCol="words", pattern=r"\W+", toLowercase=True).transform(df)
    df = StopWordsRemover(inputCol="words", outputCol="filtered_words").transform(df)
    return HashingTF(inputCol="filtered_words", outputCol="tf_features", numFeatures=buckets).transform(df)


def fit_idf(tf: DataFrame, min_doc_freq: int = 1) -> IDFModel:
    """One pass over the vectors; what reaches the driver is one vector of `buckets` numbers."""
    return IDF(inputCol="tf_features", outputCol="tfidf_features", minDocFreq=min_doc_freq).fit(tf)


def hashing_tfidf(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    tf = hashing_tf(df, text, buckets)
    return fit_idf(tf).transform(tf)


def term_tfidf(df: DataFrame, key: str = "doc_id", text: str = "text", smooth: bool = False) -> DataFrame:
    """Exact TF-IDF per document and word: tf * ln((N + 1) / (df + 1)), plus 1 in the log's place when smoothed.

    Texts are dealt by their key, in tasks that follow their bytes, and words are
    counted where their text lies: texts are shorter than their counted words. The counts are
    written once, for the word table and for its join. That table is a vocabulary; where it is too
    big to broadcast, AQE splits the words that occur in very many documents.
    """
    rows, size = df.agg(F.count("*"), F.sum(F.octet_length(text))).first()
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // TASK_TEXT))
    words = df.select(key, text).repartition(tasks, key).select(key, F.explode(words_of(F.col(text))).alias("term"))
    tf = words.filter(~F.col("term").isin(*W.STOP_WORDS)).groupBy(key, "term").agg(F.count("*").alias("tf"))
    tf = materialize(tf, "term-counts")
    freq = materialize(tf.groupBy("term").agg(F.count("*").alias("df")), "terms")
    idf = F.log((F.lit(rows) + 1) / (F.col("df") + 1)) + (1.0 if smooth else 0.0)
    return tf.join(small(freq.withColumn("idf", idf)), "term").select(
        key, "term", "tf", "df", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))


# --- lexicon scores ----------------------------------------------------------------------

def default_lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(word, p, s) for word, (p, s) in W.LEXICON.items()], "word string, polarity double, subjectivity double")


#: Units of 1 in which lexicon values are added up: nine decimals of a value count.
UNITS = 1_000_000_000


def lexicon_sentiment(df: DataFrame, lexicon: DataFrame, key: str = "doc_id", text: str = "text",
                      negators: Iterable[str] = W.NEGATORS) -> DataFrame:
    """Mean polarity and subjectivity of the lexicon words of each text.

    A word right after a negator counts with -0.5 of its polarity. Texts
    without any lexicon word score (0, neutral, 0). The words of a text stay
    in one task until partial aggregation has made one row of them.

    Sums are of whole units, and one division makes the mean: it does not
    depend on the order of the words, and a mean of just 0.1 is not above 0.1.
    """
    tokens = words_of(F.col(text))
    pairs = F.arrays_zip(tokens.alias("word"), F.concat(F.array(F.lit("")), tokens).alias("previous"))
    hits = df.select(key, F.inline(pairs)).join(small(lexicon), "word")
    negated = F.col("previous").isin(*negators)
    polarity = F.col("polarity") * F.when(negated, W.NEGATION_FACTOR).otherwise(1.0)

    def mean(value: Column) -> Column:
        return F.sum(F.round(value * UNITS).cast("long")) / (F.count(value) * UNITS)

    scores = hits.groupBy(key).agg(mean(polarity).alias("score"), mean(F.col("subjectivity")).alias("subjectivity"))
    rest = [c for c in df.columns if c != text]
    return df.select(*rest).join(scores, key, "left").select(
        *rest,
        F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.coalesce("score", F.lit(0.0)))).alias("sentiment_score"),
        F.coalesce("subjectivity", F.lit(0.0)).alias("confidence"),
    ).withColumn("sentiment_label", S.sentiment_label(F.col("sentiment_score")))


# --- user scorers ------------------------------------------------------------------------

SCORE_SCHEMA = "sentiment_score double, sentiment_label string, confidence double"


def _safe(fn: Callable[[str], tuple[float, float]], text: str | None) -> tuple[float, str, float]:
    try:
        score, confidence = fn(text) if text else (0.0, 0.0)
    except Exception:  # a text the scorer cannot read counts as neutral
        score, confidence = 0.0, 0.0
    label = "positive" if score > S.LABEL_BAND else "negative" if score < -S.LABEL_BAND else "neutral"
    return float(score), label, float(confidence)


def score_udf(fn: Callable[[str], tuple[float, float]]):
    """Arrow-batched struct column from a function text -> (polarity, subjectivity)."""
    names = ["sentiment_score", "sentiment_label", "confidence"]

    @F.pandas_udf(SCORE_SCHEMA)
    def score(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_safe(fn, t) for t in text], columns=names)

    return score


def score_partitions(df: DataFrame, fn: Callable[[str], tuple[float, float]], text: str = "text") -> DataFrame:
    """Same rule batch by batch, for scorers with a costly set-up per task."""
    names = ["sentiment_score", "sentiment_label", "confidence"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch[names] = pd.DataFrame([_safe(fn, t) for t in batch[text]], columns=names, index=batch.index)
            yield batch

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{fields}, {SCORE_SCHEMA}")


# --- per-ticker table ----------------------------------------------------------------------

def _texts(df: DataFrame, kind: str, source_id: str, columns: list[str], day: str) -> DataFrame:
    return build_text(df, columns).filter(has_value(F.col("matched_tickers"))).select(
        F.lit(kind).alias("source_type"), F.col(source_id).cast("string").alias("source_id"), "text",
        "matched_tickers", F.col(day).alias("event_date"),
    )


def text_events(news: DataFrame | None, posts: DataFrame | None) -> DataFrame:
    """News and forum posts as one input: kind, id, text, tickers, date."""
    parts = []
    if news is not None:
        parts.append(_texts(news, "news", "link", ["title", "summary"], "published_date"))
    if posts is not None:
        parts.append(_texts(posts, "reddit", "post_id", ["title", "selftext"], "created_utc"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def sentiment_by_ticker(news: DataFrame | None, posts: DataFrame | None, lexicon: DataFrame,
                        processed_at: str | None = None, keep_general: bool = False,
                        negators: Iterable[str] = W.NEGATORS) -> DataFrame:
    """One scored row per text and ticker; every text is scored once, before tickers are exploded."""
    # Ids may repeat, so the text is part of the key. Copies of one text share a key and a mean.
    key = F.concat_ws(":", "source_type", "source_id", F.xxhash64("text").cast("string"))
    scored = lexicon_sentiment(text_events(news, posts).withColumn("_key", key), lexicon, key="_key", negators=negators)
    rows = explode_tickers(scored)
    out = rows.select(
        "source_type", "source_id", "ticker", "sentiment_score", "sentiment_label", "confidence", "event_date",
        F.lit(processed_at).cast("string").alias("processed_at"),
    )
    return out if keep_general else drop_general(out)
