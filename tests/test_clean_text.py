"""Cleaning, tagging, sentiment and fusion on hand-made frames."""

import datetime as dt
import itertools
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clean as C
from tidemark.functions import scalars as S
from tidemark.operators import aggregates, align, anomaly, clean, fusion, sentiment, series, tagging, views
from tidemark.plans import fixtures as fx


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize("text,want", [
    ("2024-03-05", dt.datetime(2024, 3, 5)),
    ("2024-03-05 10:20:30", dt.datetime(2024, 3, 5, 10, 20, 30)),
    ("Tue, 05 Mar 2024 10:20:30 +0530", dt.datetime(2024, 3, 5, 4, 50, 30)),
    ("Tue, 5 Mar 2024 10:20:30 GMT", dt.datetime(2024, 3, 5, 10, 20, 30)),
    ("2024-03-05T10:20:30Z", dt.datetime(2024, 3, 5, 10, 20, 30)),
    ("not a date", None), (None, None),
])
def test_dates(spark, text, want):
    assert one(spark, text, C.to_naive_ts) == want


def test_references_are_decoded_as_the_library_does(spark):
    """Every name with and without semicolon, code points of every kind, and drawn texts, without a Python worker."""
    import html
    import random
    from html import entities

    from pyspark.sql import functions as F

    draw = random.Random(5)
    texts = [f"a&{n}{end}" for n in entities.html5 for end in ("", "b", " ")]
    points = [*range(0x110), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1F600, 0x1FFFF, 0x10FFFF, 0x110000, 10 ** 12, 10 ** 60]
    texts += [f"{a}{p:{kind}}{b}" for p in points for a, kind in (("&#", "d"), ("&#x", "x"), ("&#X", "X"), ("&#000", "d"), ("&#x00", "x")) for b in (";", "", "z")]
    texts += ["".join(draw.choice(["&", "amp", "lt;", "#", "x", "12", ";", " ", "notit;", "<", "é", "\n"]) for _ in range(draw.randrange(12))) for _ in range(3_000)]
    texts += ["", "&", "&&amp;&", "&amp;amp;", "&" + "a" * 40 + ";"]
    out = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", C.decode_references(F.col("t")).alias("t"))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    got = dict(out.collect())
    wrong = [(t, got[k], html.unescape(t)) for k, t in enumerate(texts) if got[k] != html.unescape(t)]
    assert not wrong, wrong[:5]


def test_html_entities_beyond_the_basic_ones(spark):
    assert one(spark, " <p>a &eacute;&nbsp;&#8364; &lt;b&gt; &amp;lt;</p> ", C.clean_html) == "a é\xa0€ <b> &lt;"


def test_numbers_and_symbols(spark):
    assert one(spark, "1e3", C.number) == 1000.0 and one(spark, "n/a", C.number) is None
    assert one(spark, " tcs.NS ", C.clean_symbol) == "TCS"
    assert one(spark, "TCS.NS", C.exchange_of) == "NSE" and one(spark, "TCS.BO", C.exchange_of) == "BSE"


def test_number_text_rounds_half_even(spark):
    df = spark.createDataFrame([(2.25,), (-0.0625,), (0.0,), (12345.67,)], "v double")
    assert [r[0] for r in df.select(S.fixed(F.col("v"), 1)).collect()] == ["2.2", "-0.1", "0.0", "12345.7"]
    assert df.select(S.signed_pct(F.col("v"))).collect()[1][0] == "-6.2%"


def test_normalize_first_close_wins(spark):
    df = spark.createDataFrame([("2024-01-01", 1.0, 2.0, " x.ns".upper())], "`DATE` string, `Adj Close` double, Close double, Ticker string")
    row = clean.normalize_prices(df).first()
    assert (row.close_price, row.ticker, row.trade_date) == (1.0, "X", dt.datetime(2024, 1, 1))


def test_require_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert clean.require_columns(df, ["a"]).count() == 1
    assert clean.require_columns(df, ["b"], empty=True).count() == 0
    with pytest.raises(ValueError):
        clean.require_columns(df, ["b"])


def test_blank_tags(spark):
    df = spark.createDataFrame([(1, " A, B,,C "), (2, "  "), (3, None)], "id int, matched_tickers string")
    assert sorted(tuple(r) for r in tagging.explode_tickers(df).select("id", "ticker").collect()) == [
        (1, "A"), (1, "B"), (1, "C")]
    raw = tagging.explode_tickers(df.filter("id = 1"), trim=False)
    assert [r.ticker for r in raw.collect()] == [" A", " B", "C "]


def test_union_all_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, 3)], "x int, y int")
    assert sorted(map(tuple, clean.union_all([a, b]).fillna(-1).collect())) == [(1, -1), (2, 3)]


def test_dedupe_survivors(spark):
    posts = spark.createDataFrame([("p", "b", 2), ("p", "a", 1), ("q", "c", 1)], "post_id string, t string, fetched_at int")
    assert sorted(r.t for r in clean.dedupe_posts(posts).collect()) == ["a", "c"]
    bars = spark.createDataFrame([("A", "d", 1.0, None), ("A", "d", 2.0, 5.0), ("A", "d", 3.0, 4.0)],
                                 "ticker string, trade_date string, close_price double, volume double")
    assert clean.dedupe_prices(bars).first().close_price == 2.0


# --- tagging against brute force -----------------------------------------------------------

def tag_brute(text, keywords):
    found = set()
    for ticker, word in keywords:
        kw = word.strip().lower()
        if not kw:
            continue
        if len(kw) <= 4:
            if re.search(r"\b" + re.escape(kw) + r"\b", text.lower()):
                found.add(ticker.upper())
        elif kw in text.lower():
            found.add(ticker.upper())
    return ",".join(sorted(found)) or "GENERAL"


KEYWORDS = [("rel", "ril"), ("REL", "mukesh ambani"), ("LT", "l&t "), ("LT", "larsen"), ("ITC", "itc limited"), ("ITC", "itc "),
            ("SBI", "sbi"), ("HUL", "hul"), ("AIR", "airtel"), ("ODD", "a & b c"), ("DOT", ".com"), ("UML", "größe"), ("E", ""),
            ("PLUS", "c++"), ("LONG", "x.y-zed"), ("NUM", "360one")]
PIECES = ["ril", "April", "mukesh ambani", "mukesh", "ambani", "L&T", "l & t", "xl&ty", "Larsenia", "ITC Limited", "itc", "sbi.", "_sbi",
          "bharti-airtels", "a & b c", "za & b cd", "foo.com", ".com", "Übergröße", "c++", "c++a", "x.y-zedd", "x.y", "360ONE", "hülhul", ""]


def test_tagging_equals_brute_force(spark):
    texts = [" ".join(p) for p in itertools.permutations(PIECES, 2)] + PIECES
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = tagging.tag_tickers(docs, spark.createDataFrame(KEYWORDS, "ticker string, keyword string"))
    assert {r.doc_id: r.matched_tickers for r in got.collect()} == {i: tag_brute(t, KEYWORDS) for i, t in enumerate(texts)}


def test_tagging_without_loose_or_composed_keywords(spark):
    docs = spark.createDataFrame([(1, "sbi up"), (2, "sbis up")], "doc_id long, text string")
    got = tagging.tag_tickers(docs, spark.createDataFrame([("S", "sbi")], "ticker string, keyword string"))
    assert {r.doc_id: r.matched_tickers for r in got.collect()} == {1: "S", 2: "GENERAL"}


def test_tagging_by_keywords_without_word_characters(spark):
    keywords = [("A", "$$$ >>>"), ("B", "%%"), ("C", "sbi"), ("D", "-----")]
    texts = ["up $$$ >>> now", "up $$$ >> now", "a%%b", "a %% b", "sbi -----\n", "", "----", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = tagging.tag_tickers(docs, spark.createDataFrame(keywords, "ticker string, keyword string"))
    assert {r.doc_id: r.matched_tickers for r in got.collect()} == {i: tag_brute(t or "", keywords) for i, t in enumerate(texts)}


def test_keyword_tables(spark):
    names = spark.createDataFrame([("TCS", "Tata Consultancy Services Ltd."), ("ACC", "ACC Limited"), ("", "No Symbol")],
                                  "symbol string, company_name string")
    assert sorted(map(tuple, tagging.keywords_from_names(names).collect())) == [("ACC", "acc"), ("TCS", "tata"), ("TCS", "tcs")]
    dim = spark.createDataFrame([("TCS", "IT")], "ticker string, sector string")
    alias = spark.createDataFrame([("TCS", "tata consultancy"), ("XXX", "nobody")], "ticker string, keyword string")
    assert sorted(r.keyword for r in tagging.ticker_keywords(dim, alias).collect()) == ["tata consultancy", "tcs"]


# --- sentiment -------------------------------------------------------------------------------

def test_lexicon_scores(spark):
    lexicon = spark.createDataFrame([("good", 0.7, 0.6), ("bad", -0.7, 0.6)], "word string, polarity double, subjectivity double")
    docs = spark.createDataFrame([(1, "Good, good!"), (2, "not good"), (3, "bad good"), (4, ""), (5, None), (6, "nothing here")],
                                 "doc_id int, text string")
    got = {r.doc_id: (round(r.sentiment_score, 6), r.sentiment_label, r.confidence) for r in sentiment.lexicon_sentiment(docs, lexicon).collect()}
    assert got == {1: (0.7, "positive", 0.6), 2: (-0.35, "negative", 0.6), 3: (0.0, "neutral", 0.6),
                   4: (0.0, "neutral", 0.0), 5: (0.0, "neutral", 0.0), 6: (0.0, "neutral", 0.0)}


def test_default_lexicon_is_in_range(spark):
    row = sentiment.default_lexicon(spark).agg(
        F.min("polarity"), F.max("polarity"), F.min("subjectivity"), F.max("subjectivity")).first()
    assert row[0] >= -1 and row[1] <= 1 and row[2] >= 0 and row[3] <= 1


def test_user_scorers_survive_errors(spark):
    def scorer(text):
        if text == "boom":
            raise RuntimeError
        return len(text) / 10, 0.5

    df = spark.createDataFrame([(1, "boom"), (2, "aaaaa"), (3, None)], "id int, text string")
    want = {1: (0.0, "neutral", 0.0), 2: (0.5, "positive", 0.5), 3: (0.0, "neutral", 0.0)}
    got = sentiment.score_partitions(df, scorer).collect()
    assert {r.id: (r.sentiment_score, r.sentiment_label, r.confidence) for r in got} == want
    got = df.select("id", sentiment.score_udf(scorer)("text").alias("s")).select("id", "s.*").collect()
    assert {r.id: (r.sentiment_score, r.sentiment_label, r.confidence) for r in got} == want


def test_sql_words_equal_ml_words(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    ours = sentiment.remove_stopwords(sentiment.tokenize(docs, name="w"), "w", "kept")
    ml = sentiment.hashing_tf(ours)
    # MLlib yields one empty word for a text without any word.
    assert ml.filter(F.array_remove("words", "") != F.col("w")).count() == 0
    assert ml.filter(F.array_remove("filtered_words", "") != F.col("kept")).count() == 0


def test_repeated_ids_keep_their_own_score(spark):
    news = spark.createDataFrame(
        [("l1", "best", "", "A"), ("l1", "worthless", "", "A,B"), ("l1", "best", "", "C")],
        "link string, title string, summary string, matched_tickers string").withColumn("published_date", F.lit("2024-01-01").cast("date"))
    got = sentiment.sentiment_by_ticker(news, None, sentiment.default_lexicon(spark))
    assert sorted((r.ticker, r.sentiment_score) for r in got.collect()) == [("A", -0.8), ("A", 1.0), ("B", -0.8), ("C", 1.0)]


# --- anomalies and fusion ----------------------------------------------------------------------

D0 = dt.date(2024, 1, 10)


def anomalies(spark, *rows):
    return spark.createDataFrame(
        [(t, D0 + dt.timedelta(days=d), r, v, k) for t, d, r, v, k in rows],
        "ticker string, trade_date date, daily_return double, volume_ratio double, anomaly_type string")


def sentiments(spark, *rows):
    return spark.createDataFrame(
        [(k, t, dt.datetime(2024, 1, 10) + dt.timedelta(hours=h), s) for k, t, h, s in rows],
        "source_type string, ticker string, event_ts timestamp, sentiment_score double").withColumn("event_date", F.to_date("event_ts"))


def test_divergence_text_and_type(spark):
    found = anomalies(spark, ("A", 0, -0.05, 1.0, "price_spike"), ("B", 0, 0.05, 1.0, "price_spike"), ("C", 0, 0.05, 1.25, "price_spike"))
    scores = sentiments(spark, ("news", "A", 1, 0.25), ("news", "B", 1, -0.3), ("news", "C", 1, -0.1))
    got = {r.ticker: (r.anomaly_type, r.description) for r in anomaly.divergences(found, scores).collect()}
    assert got["A"] == ("bearish_divergence", "⚠️ DIVERGENCE: Price down 5.0% but sentiment positive (0.25) — potential oversold")
    assert got["B"][0] == "bullish_divergence" and "Price up 5.0%" in got["B"][1]
    assert got["C"] == ("price_spike", "price_spike detected: return=5.0%, vol_ratio=1.2")


def test_four_way_context_and_window_bounds(spark):
    found = anomalies(spark, *[(t, 0, 0.1, 1.0, "price_spike") for t in "ABCDEF"]).withColumnRenamed("trade_date", "anomaly_date")
    scores = sentiments(
        spark, ("news", "A", 24, 0.45), ("news", "B", 25, 0.9), ("reddit", "C", -24, -0.5), ("news", "C", 0, 0.44),
        ("news", "D", 3, 0.09), ("news", "E", 3, 0.2))
    got = {r.ticker: r.context for r in fusion.classify_context(found, scores).collect()}
    assert got == {"A": "news", "B": "structural", "C": "retail", "D": "structural", "E": "unexplained", "F": "structural"}
    rate = fusion.association_rate(fusion.classify_context(found, scores)).first()
    assert (rate.anomalies, rate.associated, round(rate.association_rate, 4)) == (6, 2, 0.3333)
    assert fusion.align_events(found, scores).count() == 5


def test_sentiment_lead_takes_the_last_post_before(spark):
    found = anomalies(spark, ("A", 0, 0.1, 3.0, "volume_surge"), ("B", 0, 0.1, 1.0, "price_spike")).withColumnRenamed("trade_date", "anomaly_date")
    scores = sentiments(spark, ("reddit", "A", -30, 0.1), ("reddit", "A", -20, 0.1), ("reddit", "A", 0, 0.1), ("news", "A", -1, 0.1), ("reddit", "B", -5, 0.1))
    assert [(r.ticker, r.lead_hours) for r in fusion.sentiment_lead(scores, found).collect()] == [("A", 20.0)]


def test_no_sentiment_table(spark):
    row = anomaly.correlate_sentiment(anomalies(spark, ("A", 0, 0.1, 1.0, "price_spike")), None).first()
    assert row.sentiment_avg is None and row.description == "No sentiment data available"


def test_unknown_ticker_is_other(spark):
    dim = spark.createDataFrame([("A", "IT")], "ticker string, sector string")
    found = anomalies(spark, ("A", 0, 0.1, 1.0, "x"), ("Z", 0, 0.1, 1.0, "x"))
    assert {r.ticker: r.sector for r in align.with_sector(found, dim).collect()} == {"A": "IT", "Z": "Other"}
    assert align.small(dim, 0).count() == 1


def test_divergence_fallbacks(spark):
    found = anomaly.correlate_sentiment(anomalies(spark, ("A", 0, 0.1, 1.0, "price_spike")), None)
    scores = sentiments(spark, *[("news", "A", h, 0.0) for h in range(25)])
    assert found.agg(aggregates.divergence_count(found)).first()[0] == 0
    assert found.agg(aggregates.divergence_count(found, scores, guess=True)).first()[0] == 1


def test_price_summary_of_one_row(spark):
    df = spark.createDataFrame([("A", D0, 2.0, 1.0, 1.5, 10.0)], "ticker string, trade_date date, high_price double, low_price double, close_price double, volume double")
    row = views.price_summary(df).first()
    assert (row.latest_close, row.change_pct) == (1.5, 0.0)


def test_pages(spark, sf):
    bars, scores, dim = fx.bars(spark, sf), fx.sentiment(spark, sf), fx.dim(spark, sf)
    stored = anomaly.correlate_sentiment(anomaly.detect_anomalies(bars), scores).select(*anomaly.OUTPUT).cache()
    detail = views.ticker_detail("S1", bars, scores, stored, "1996-01-01", "1997-12-31", candles=5)
    assert detail["candles"].count() == 5 and detail["summary"].count() == 1 and detail["anomalies"].count() > 0
    replay = views.replay(bars, stored, ["S1", "S2"], "1996-01-01", "1996-06-30")
    assert replay["relative"].select("ticker").distinct().count() == 2
    assert views.shock_replay(bars, stored, "S1").select("shock_date").distinct().count() == 8
    lookup = anomaly.lookup_anomalies(stored, "S1", 7)
    assert lookup.count() == 7
    stored.unpersist()


def test_a_mean_of_just_the_band_is_neutral(spark):
    words = spark.createDataFrame([("bad", -0.8, 1.0), ("fine", 0.5, 0.1), ("flat", 0.0, 0.4)], "word string, polarity double, subjectivity double")
    docs = spark.createDataFrame([(1, "bad fine flat"), (2, "flat fine bad"), (3, "bad bad fine"), (4, "none")], "doc_id long, text string")
    got = {r.doc_id: (r.sentiment_score, r.sentiment_label, r.confidence) for r in sentiment.lexicon_sentiment(docs, words).collect()}
    assert got[1] == got[2] == (-0.1, "neutral", 0.5)
    assert got[3][1] == "negative" and got[4] == (0.0, "neutral", 0.0)


def test_copies_of_a_text_keep_the_neutral_band(spark):
    words = spark.createDataFrame([("bad", -0.8, 1.0), ("fine", 0.5, 0.1), ("flat", 0.0, 0.4)], "word string, polarity double, subjectivity double")
    news = spark.createDataFrame([("1", "bad fine", "flat", "S1, S2", dt.date(2024, 1, 1))] * 2, "link string, title string, summary string, matched_tickers string, published_date date")
    rows = sentiment.sentiment_by_ticker(news, None, words).collect()
    assert sorted((r.ticker, r.sentiment_score, r.sentiment_label) for r in rows) == [("S1", -0.1, "neutral")] * 2 + [("S2", -0.1, "neutral")] * 2


def test_layouts_are_tried_where_their_separators_are(spark):
    texts = ["2024-01-02", "2024-01-02 03:04:05", "2024-01-02 03:04:05-05:00", "2024-01-02T03:04:05", "2024-01-02t03:04:05z", "2024-01-02T03:04:05.123456",
             "Tue, 2 Jan 2024 03:04:05 +0530", "2 jan 2024 03:04:05 GMT", "", " ", None, "soon: 2024", "2024-01-02T", "2024-01-02 03:04:05.5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    every = F.coalesce(*[C._parse(F.col("t"), layout) for layout in C.TIME_FORMATS])
    assert df.where(~every.eqNullSafe(C.to_naive_ts(F.col("t")))).collect() == []
    tried = {t: [x for x in C.TIME_FORMATS if df.where(F.col("t") == t).select(C._may_be(F.col("t"), x)).first()[0]] for t in texts[:6:5]}
    assert tried == {texts[0]: [C.TIME_FORMATS[0]], texts[5]: [C.TIME_FORMATS[5]]}
