"""The registered queries once more, as plain SQL over the same tables."""

from __future__ import annotations

import re

from tidemark.functions.words import NEGATORS, STOP_WORDS
from tidemark.plans.fixtures import FX_KEYWORDS, FX_LEXICON, FX_NEGATORS


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _values(rows) -> str:
    def one(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)
    return ", ".join("(" + ", ".join(one(v) for v in row) + ")" for row in rows)


_W = "PARTITION BY ticker ORDER BY trade_date"


def _rows(n: int, by: str = _W) -> str:
    return f"({by} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _feature_sql(source: str) -> str:
    return f"""
  SELECT *, CASE WHEN sma_20 <> 0 THEN (sma_7 - sma_20) / sma_20 END AS ma_crossover,
         CASE WHEN avg_volume_20d <> 0 THEN volume / avg_volume_20d END AS volume_ratio,
         (high_price - low_price) / close_price AS price_range,
         stddev_samp(daily_return) OVER {_rows(7)} AS volatility_7d
  FROM (SELECT *, CASE WHEN prev_close <> 0 THEN (close_price - prev_close) / prev_close END AS daily_return
        FROM (SELECT *, lag(close_price) OVER ({_W}) AS prev_close,
                     avg(volume) OVER {_rows(7)} AS avg_volume_7d, avg(volume) OVER {_rows(20)} AS avg_volume_20d,
                     avg(close_price) OVER {_rows(7)} AS sma_7, avg(close_price) OVER {_rows(20)} AS sma_20
              FROM {source}))"""


_FULL = "daily_return IS NOT NULL AND volatility_7d IS NOT NULL AND volume_ratio IS NOT NULL AND ma_crossover IS NOT NULL"


def _type(ret: str = "daily_return", ratio: str = "volume_ratio") -> str:
    return (f"CASE WHEN abs({ret}) > 0.03 AND {ratio} > 2.0 THEN 'price_volume_spike' WHEN abs({ret}) > 0.03 THEN 'price_spike' "
            f"WHEN {ratio} > 2.5 THEN 'volume_surge' ELSE 'statistical_outlier' END")


def _describe(advice: str) -> str:
    return f"""CASE
    WHEN daily_return < -0.03 AND sentiment_avg > 0.1 THEN '⚠️ DIVERGENCE: Price down ' || format('{{:.1f}}', abs(daily_return) * 100)
      || '% but sentiment positive (' || format('{{:.2f}}', sentiment_avg) || ') — potential oversold{advice}'
    WHEN daily_return > 0.03 AND sentiment_avg < -0.1 THEN '⚠️ DIVERGENCE: Price up ' || format('{{:.1f}}', abs(daily_return) * 100)
      || '% but sentiment negative (' || format('{{:.2f}}', sentiment_avg) || ') — potential overbought{advice}'
    ELSE anomaly_type || ' detected: return=' || format('{{:.1f}}', daily_return * 100) || '%, vol_ratio=' || format('{{:.1f}}', volume_ratio) END"""


def _label(score: str, band: float = 0.1) -> str:
    return f"CASE WHEN {score} > {band} THEN 'positive' WHEN {score} < -{band} THEN 'negative' ELSE 'neutral' END"


def _text_keys(key: str) -> dict[str, str]:
    n = "(SELECT count(*) FROM supplier)"
    date = f"(DATE '1995-01-02' + CAST(({key} * 37) % 2499 AS INTEGER))"
    return {
        "date": f"CAST({date} AS DATE)",
        "ts": f"(CAST({date} AS TIMESTAMP) + to_hours(CAST({key} % 24 AS INTEGER)))",
        "tickers": f"CASE WHEN {key} % 11 = 0 THEN 'GENERAL' ELSE 'S' || ({key} % {n}) || ', S' || (({key} * 7 + 3) % {n}) END",
    }


_D, _C = _text_keys("doc_id"), _text_keys("conv_id")


def _explode(source: str, keep: str) -> str:
    return f"SELECT * FROM (SELECT {keep}, trim(unnest(string_split(matched_tickers, ','))) AS ticker FROM {source}) WHERE ticker <> ''"


def _momentum(source: str, n: int, strict: bool) -> str:
    w = _rows(n, "PARTITION BY sector ORDER BY date")
    std = f"stddev_samp(sector_avg_sentiment) OVER {w}"
    if strict:
        std = f"CASE WHEN count(sector_avg_sentiment) OVER {w} >= 5 THEN {std} END"
    tickers = "ticker_count" if strict else f"CAST(trunc(avg(ticker_count) OVER {w}) AS BIGINT)"
    return f"""SELECT sector, CAST({n} AS BIGINT) AS window_days,
      CASE WHEN s > 0 THEN (x - m) / s ELSE 0.0 END AS momentum_score, m AS avg_sentiment, k AS ticker_count,
      CAST(date - {n} AS DATE) AS start_date, date AS end_date
    FROM (SELECT sector, date, sector_avg_sentiment AS x, avg(sector_avg_sentiment) OVER {w} AS m, {std} AS s, {tickers} AS k,
                 count(*) OVER (PARTITION BY sector) AS days FROM {source}) {'WHERE days >= 5' if strict else ''}"""


_LEXICON = _values((w, p, s) for w, (p, s) in FX_LEXICON.items())


def _lexicon_scores(source: str, key: str, text: str, negators=FX_NEGATORS) -> str:
    return f"""
  SELECT k AS {key}, avg(polarity * CASE WHEN previous IN ({_quoted(negators)}) THEN -0.5 ELSE 1.0 END) AS score,
         avg(subjectivity) AS subjectivity
  FROM (SELECT k, w[i] AS word, w[i - 1] AS previous
        FROM (SELECT k, w, unnest(generate_series(1, len(w))) AS i
              FROM (SELECT {key} AS k, list_filter(string_split_regex(lower({text}), '\\W+'), lambda x: x <> '') AS w FROM {source})))
  JOIN (SELECT * FROM (VALUES {_LEXICON}) AS l(word, polarity, subjectivity)) USING (word) GROUP BY k"""


CTES = {
    "fx_r": """SELECT 'S' || l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS trade_date, 100 * (1 + l_discount - l_tax) AS px, l_quantity AS q,
      row_number() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax) AS rn,
      row_number() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
        ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC) AS rd
    FROM lineitem""",
    "fx_bars": """SELECT ticker, trade_date, max(CASE WHEN rn = 1 THEN px END) AS open_price, max(px) AS high_price, min(px) AS low_price,
      max(CASE WHEN rd = 1 THEN px END) AS close_price, sum(q) AS volume FROM fx_r GROUP BY ticker, trade_date""",
    "fx_dim": """SELECT 'S' || s_suppkey AS ticker, n_name AS sector FROM supplier JOIN nation ON s_nationkey = n_nationkey
      WHERE s_suppkey % 17 <> 0""",
    "fx_news": f"""SELECT doc_id, source, substr(text, 1, 80) AS title, substr(text, 81) AS summary, {_D['date']} AS published_date,
      CAST(doc_id AS VARCHAR) AS link, {_D['tickers']} AS matched_tickers, {_D['ts']} AS event_ts,
      {_D['ts']} + INTERVAL 1 HOUR AS fetched_at FROM documents""",
    "fx_news_refetched": """SELECT * FROM fx_news UNION ALL
      SELECT * REPLACE (fetched_at + INTERVAL 1 DAY AS fetched_at) FROM fx_news WHERE doc_id % 5 = 0""",
    "fx_posts": f"""SELECT role AS subreddit, conv_id || '_' || turn AS post_id, text AS selftext, {_C['date']} AS created_utc,
      {_C['tickers']} AS matched_tickers, {_C['ts']} AS event_ts, {_C['ts']} + INTERVAL 1 HOUR AS fetched_at, conv_id FROM conversations""",
    "fx_general": f"""SELECT *, (k * 37 % 201 - 100) / 100.0::DOUBLE AS sentiment_score,
        {_label("((k * 37 % 201 - 100) / 100.0::DOUBLE)")} AS sentiment_label, (k % 101) / 100.0::DOUBLE AS confidence FROM (
      {_explode("fx_news", "'news' AS source_type, link AS source_id, doc_id AS k, published_date AS event_date, event_ts")}
      UNION ALL
      {_explode("fx_posts", "'reddit' AS source_type, post_id AS source_id, conv_id AS k, created_utc AS event_date, event_ts")})""",
    "fx_sentiment": "SELECT * FROM fx_general WHERE ticker <> 'GENERAL'",
    "fx_daily": """SELECT ticker, event_date AS event_day, avg(sentiment_score) AS daily_sentiment, count(*) AS article_count
      FROM fx_sentiment GROUP BY ALL""",
    "fx_all": _feature_sql("fx_bars"),
    "fx_feat": f"SELECT * FROM fx_all WHERE {_FULL}",
    "fx_scored": f"""SELECT *, round(0.6 * abs(daily_return) / CASE WHEN volatility_7d > 0.0001 THEN volatility_7d ELSE 0.01 END
        + 0.4 * coalesce(volume_ratio, 1.0), 3) AS anomaly_score, {_type()} AS anomaly_type FROM fx_feat""",
    "fx_anom": """SELECT *, trade_date AS anomaly_date FROM fx_scored
      WHERE anomaly_score > 2.5 OR abs(daily_return) > 0.035 OR volume_ratio > 2.5""",
    "fx_stored": f"""SELECT ticker, anomaly_date, close_price, volume, anomaly_score, anomaly_type, sentiment_avg, {_describe(' signal')} AS description
      FROM (SELECT a.*, d.daily_sentiment AS sentiment_avg FROM fx_anom a LEFT JOIN fx_daily d ON a.ticker = d.ticker AND a.trade_date = d.event_day)""",
    "fx_blend": """SELECT r.*, coalesce(s.sector, 'Other') AS sector, d.daily_sentiment AS real_sentiment,
        coalesce(d.daily_sentiment, r.price_sentiment) AS blended_sentiment
      FROM (SELECT *, CASE WHEN daily_return > 0.01 THEN 1.0 WHEN daily_return < -0.01 THEN -1.0 ELSE 0.0 END::DOUBLE AS price_sentiment FROM fx_all) r
      LEFT JOIN fx_daily d ON r.ticker = d.ticker AND r.trade_date = d.event_day LEFT JOIN fx_dim s ON r.ticker = s.ticker""",
    "fx_sector_day": """SELECT sector, trade_date AS date, avg(blended_sentiment) AS sector_avg_sentiment, count(*) AS sector_article_count,
      count(DISTINCT ticker) AS ticker_count FROM fx_blend GROUP BY ALL""",
    "fx_mom": " UNION ALL ".join(_momentum("fx_sector_day", n, False) for n in (30, 60, 90)),
    "fx_clean_prices": """SELECT ticker, trade_date, px AS close_price, px AS high_price, px AS low_price, q AS volume FROM fx_r
      QUALIFY row_number() OVER (PARTITION BY ticker, trade_date ORDER BY q DESC, px) = 1""",
    "fx_clean_news": """SELECT * FROM fx_news_refetched
      QUALIFY row_number() OVER (PARTITION BY title, published_date ORDER BY fetched_at, link, doc_id) = 1""",
    "fx_flat_news": _explode("fx_clean_news", "*"),
    "fx_near": """SELECT a.ticker, a.anomaly_date, a.anomaly_type, a.anomaly_score, s.source_type, s.source_id, s.event_ts, s.sentiment_score
      FROM (SELECT *, unnest([anomaly_date - 1, anomaly_date, anomaly_date + 1]) AS day FROM fx_anom) a
      JOIN (SELECT *, CAST(event_ts AS DATE) AS day FROM fx_sentiment) s ON a.ticker = s.ticker AND CAST(a.day AS DATE) = s.day
       AND s.event_ts BETWEEN CAST(a.anomaly_date AS TIMESTAMP) - INTERVAL 24 HOUR AND CAST(a.anomaly_date AS TIMESTAMP) + INTERVAL 24 HOUR""",
    "fx_context": """SELECT ticker, anomaly_date, n AS news_polarity, r AS retail_polarity, m AS max_polarity,
        CASE WHEN n >= 0.45 THEN 'news' WHEN r >= 0.45 THEN 'retail' WHEN coalesce(m, 0) < 0.1 THEN 'structural' ELSE 'unexplained' END AS context
      FROM fx_anom LEFT JOIN (SELECT ticker, anomaly_date, max(CASE WHEN source_type = 'news' THEN abs(sentiment_score) END) AS n,
          max(CASE WHEN source_type = 'reddit' THEN abs(sentiment_score) END) AS r, max(abs(sentiment_score)) AS m
        FROM fx_near GROUP BY ALL) USING (ticker, anomaly_date)""",
    "fx_shocks": """SELECT * FROM fx_anom QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY anomaly_score DESC, anomaly_date) <= 8""",
    "fx_z": f"""SELECT *, CASE WHEN ratio0 IS NULL THEN 1.0 ELSE ratio0 END AS volume_ratio, coalesce((daily_return - mean0) / coalesce(nullif(std0, 0), 0.01), 0.0) AS z
      FROM (SELECT *, CASE WHEN volume_mean <> 0 THEN volume / volume_mean END AS ratio0 FROM (
        SELECT ticker, trade_date, close_price, volume, daily_return,
          count(*) OVER (PARTITION BY ticker) AS n,
          CASE WHEN count(volume) OVER {_rows(20)} >= 5 THEN avg(volume) OVER {_rows(20)} END AS volume_mean,
          CASE WHEN count(daily_return) OVER {_rows(20)} >= 5 THEN avg(daily_return) OVER {_rows(20)} END AS mean0,
          CASE WHEN count(daily_return) OVER {_rows(20)} >= 5 THEN stddev_samp(daily_return) OVER {_rows(20)} END AS std0
        FROM fx_all)) WHERE n >= 5""",
    "fx_zanom": """SELECT ticker, trade_date AS anomaly_date, close_price, volume, CAST(format('{:.2f}', greatest(volume_ratio, abs(z))) AS DOUBLE) AS anomaly_score,
        CASE WHEN volume_ratio > 2 AND abs(z) > 2 THEN 'price_volume_spike' WHEN volume_ratio > 2 THEN 'volume_surge' ELSE 'price_spike' END AS anomaly_type,
        0.0::DOUBLE AS sentiment_avg, coalesce(daily_return, 0) AS ret, volume_ratio FROM fx_z WHERE volume_ratio > 2 OR abs(z) > 2""",
    "fx_intraday": """SELECT 'U' || user_id AS ticker, ts AS trade_date, value + 1 AS close_price, value + 2 AS high_price, value AS low_price,
      value * 10 AS volume FROM events""",
    "fx_iday_daily": """SELECT 'U' || user_id AS ticker, CAST(ts AS DATE) AS event_day, avg((event_id * 37 % 201 - 100) / 100.0) AS daily_sentiment
      FROM events WHERE event_id % 10 = 0 GROUP BY ALL""",
    "fx_iday_dim": "SELECT DISTINCT 'U' || user_id AS ticker, 'G' || user_id % 4 AS sector FROM events WHERE user_id % 17 <> 0",
    "fx_iday_all": _feature_sql("fx_intraday"),
    "fx_iday_stored": f"""SELECT ticker, CAST(trade_date AS DATE) AS anomaly_date, trade_date AS anomaly_ts, close_price, volume, anomaly_score, anomaly_type, sentiment_avg
      FROM (SELECT a.*, d.daily_sentiment AS sentiment_avg FROM (
          SELECT *, round(0.6 * abs(daily_return) / CASE WHEN volatility_7d > 0.0001 THEN volatility_7d ELSE 0.01 END
            + 0.4 * coalesce(volume_ratio, 1.0), 3) AS anomaly_score, {_type()} AS anomaly_type FROM fx_iday_all WHERE {_FULL}) a
        LEFT JOIN fx_iday_daily d ON a.ticker = d.ticker AND CAST(a.trade_date AS DATE) = d.event_day)
      WHERE anomaly_score > 2.5 OR abs(daily_return) > 0.035 OR volume_ratio > 2.5""",
    "fx_iday_sector": """SELECT sector, CAST(trade_date AS DATE) AS date, avg(coalesce(daily_sentiment, proxy)) AS sector_avg_sentiment,
        count(*) AS sector_article_count, count(DISTINCT ticker) AS ticker_count
      FROM (SELECT r.*, coalesce(s.sector, 'Other') AS sector, d.daily_sentiment,
          CASE WHEN daily_return > 0.01 THEN 1.0 WHEN daily_return < -0.01 THEN -1.0 ELSE 0.0 END::DOUBLE AS proxy FROM fx_iday_all r
        LEFT JOIN fx_iday_daily d ON r.ticker = d.ticker AND CAST(r.trade_date AS DATE) = d.event_day
        LEFT JOIN fx_iday_dim s ON r.ticker = s.ticker) GROUP BY ALL""",
    "fx_words": f"""SELECT doc_id, list_filter(string_split_regex(lower(text), '\\W+'), lambda x: x <> '') AS w FROM documents""",
    "fx_kept": f"""SELECT doc_id, w, list_filter(w, lambda x: x NOT IN ({_quoted(STOP_WORDS)})) AS kept FROM fx_words""",
    "fx_terms": "SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(kept) AS term FROM fx_kept) GROUP BY ALL",
    "fx_texts": f"""SELECT 'news' AS source_type, link AS source_id, trim(title || ' ' || summary) AS text, matched_tickers, published_date AS event_date
        FROM fx_news WHERE length(trim(title || ' ' || summary)) > 0
      UNION ALL SELECT 'reddit', post_id, trim(' ' || selftext), matched_tickers, created_utc FROM fx_posts WHERE length(trim(' ' || selftext)) > 0""",
}


# Read several times by one query, as by a range join and the rows it goes back to.
STORED = {"fx_anom", "fx_sentiment", "fx_near"}


def _sql(body: str, doubles: str = "", dates: str = "", times: str = "") -> str:
    """CTEs a query needs, the query, and the same presentation rules as `publish`."""
    fixes = [f"round({c} + 1e-10, 6) + 0.0 AS {c}" for c in doubles.split()]
    fixes += [f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()]
    fixes += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in times.split()]
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for name in re.findall(r"\bfx_\w+", text):
            if name in CTES and name not in needed:
                visit(CTES[name])
                needed[name] = None

    visit(body)
    head = "WITH " + ",\n".join(f"{n} AS {'MATERIALIZED ' if n in STORED else ''}({CTES[n]})" for n in needed) + "\n" if needed else ""
    star = f"* REPLACE ({', '.join(fixes)})" if fixes else "*"
    return f"{head}SELECT {star} FROM ({body})"


_ANOM = "ticker, anomaly_date, close_price, volume, anomaly_score, anomaly_type"
_ANOM_D, _ANOM_T = "close_price volume anomaly_score", "anomaly_date"
_MOM_D, _MOM_T = "momentum_score avg_sentiment", "start_date end_date"


def _anom(body: str, more: str = "") -> str:
    return _sql(body, f"{_ANOM_D} {more}", _ANOM_T)


def _mom(body: str) -> str:
    return _sql(body, _MOM_D, _MOM_T)


_FEATS = ["daily_return", "volatility_7d", "volume_ratio", "price_range", "ma_crossover"]

_BOUNDARY = "[^\\p{L}\\p{N}_]"


def _keyword_match() -> str:
    return f"""contains(lower(text), kw)
      AND (length(kw) > 4 OR regexp_matches(lower(text), '(^|{_BOUNDARY})' || kw || '($|{_BOUNDARY})'))"""


_STRICT = f"""
  SELECT *, count(*) OVER (PARTITION BY ticker) AS n2 FROM (
  SELECT * FROM (SELECT ticker, trade_date, daily_return, price_range, count(*) OVER (PARTITION BY ticker) AS n1,
      CASE WHEN count(daily_return) OVER {_rows(7)} >= 7 THEN volatility_7d END AS volatility_7d,
      CASE WHEN count(volume) OVER {_rows(20)} >= 20 THEN volume_ratio END AS volume_ratio,
      CASE WHEN count(close_price) OVER {_rows(20)} >= 20 THEN ma_crossover END AS ma_crossover FROM fx_all)
  WHERE n1 >= 30 AND {_FULL})"""


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    bar = "ticker, trade_date"
    q["detect_anomalies"] = _sql(
        f"SELECT {bar}, close_price, volume, daily_return, volatility_7d, volume_ratio, ma_crossover, price_range, anomaly_score, anomaly_type FROM fx_anom",
        "close_price volume daily_return volatility_7d volume_ratio ma_crossover price_range anomaly_score", "trade_date")
    q["daily_return"] = _sql(f"SELECT {bar}, close_price, prev_close, daily_return FROM fx_all", "close_price prev_close daily_return", "trade_date")
    for n in (7, 20):
        q[f"volatility_{n}"] = _sql(f"SELECT {bar}, stddev_samp(daily_return) OVER {_rows(n)} AS volatility_{n}d FROM fx_all", f"volatility_{n}d", "trade_date")
    q["volume_features"] = _sql(f"SELECT {bar}, avg_volume_7d, avg_volume_20d, volume_ratio FROM fx_all", "avg_volume_7d avg_volume_20d volume_ratio", "trade_date")
    q["moving_averages"] = _sql(f"SELECT {bar}, sma_7, sma_20, ma_crossover FROM fx_all", "sma_7 sma_20 ma_crossover", "trade_date")
    q["intraday_features"] = _sql(
        f"SELECT {bar}, {', '.join(_FEATS)} FROM ({_feature_sql('fx_intraday')}) WHERE {_FULL}", " ".join(_FEATS), "", "trade_date")
    q["rolling_min_periods"] = _sql(f"""SELECT {bar},
        CASE WHEN count(close_price) OVER {_rows(20)} >= 10 THEN avg(close_price) OVER {_rows(20)} END AS rolling_mean,
        CASE WHEN count(close_price) OVER {_rows(20)} >= 10 THEN stddev_samp(close_price) OVER {_rows(20)} END AS rolling_std FROM fx_bars""",
        "rolling_mean rolling_std", "trade_date")
    q["zscore_anomalies"] = _anom(f"""SELECT {_ANOM}, sentiment_avg,
        CASE anomaly_type WHEN 'price_volume_spike' THEN 'Price Volume Spike' WHEN 'volume_surge' THEN 'Volume Surge' ELSE 'Price Spike' END
        || ': return=' || format('{{:+.1f}}%', ret * 100) || ', vol_ratio=' || format('{{:.1f}}x', volume_ratio) AS description FROM fx_zanom""", "sentiment_avg")
    q["base100"] = _sql(f"""SELECT {bar}, close_price, close_price / first_close * 100 AS normalized_return FROM (
        SELECT *, first_value(close_price) OVER ({_W}) AS first_close FROM fx_bars) WHERE first_close > 0""", "close_price normalized_return", "trade_date")
    q["nth_from_end"] = _sql("""SELECT ticker, max(CASE WHEN rk = 1 THEN close_price END) AS latest, arg_max(close_price, rk) AS nth_value, max(rk) AS rows_seen
      FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS rk FROM fx_bars) WHERE rk <= 30 GROUP BY ticker""", "latest nth_value")
    q["tail_per_ticker"] = _sql(f"""SELECT {bar}, close_price FROM fx_bars
      QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) <= 500""", "close_price", "trade_date")
    q["latest_versions"] = _sql("""SELECT user_id, event_id, event_type, value FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) <= 3""", "value")
    q["price_momentum"] = _sql(f"""SELECT coalesce(sector, 'Other') AS sector, trade_date, avg(m30) AS momentum_30, avg(m60) AS momentum_60, avg(m90) AS momentum_90
      FROM (SELECT ticker, trade_date, {', '.join(f'close_price / lag(close_price, {n}) OVER ({_W}) - 1 AS m{n}' for n in (30, 60, 90))} FROM fx_bars)
      LEFT JOIN fx_dim USING (ticker) GROUP BY ALL""", "momentum_30 momentum_60 momentum_90", "trade_date")
    q["min_history"] = _sql("""SELECT ticker, source_type, source_id, sentiment_score FROM fx_sentiment
      QUALIFY count(*) OVER (PARTITION BY ticker) >= 30""", "sentiment_score")
    q["strict_features"] = _sql(f"SELECT {bar}, {', '.join(_FEATS)} FROM ({_STRICT}) WHERE n2 >= 30", " ".join(_FEATS), "trade_date")
    z = ", ".join(f"({c} - avg({c}) OVER p) / CASE WHEN stddev_pop({c}) OVER p = 0 THEN 1 ELSE stddev_pop({c}) OVER p END AS {c}_z" for c in _FEATS)
    q["standardize"] = _sql(f"SELECT {bar}, {z} FROM fx_feat WINDOW p AS (PARTITION BY ticker)", " ".join(f"{c}_z" for c in _FEATS), "trade_date")

    q["correlate_sentiment"] = _anom("SELECT * FROM fx_stored", "sentiment_avg")
    q["correlate_without_sentiment"] = _anom(f"""SELECT {_ANOM}, CAST(NULL AS DOUBLE) AS sentiment_avg,
        'No sentiment data available' AS description FROM fx_anom""")
    q["divergences"] = _sql(f"""SELECT ticker, anomaly_date, daily_return, sentiment_avg,
        CASE WHEN daily_return < -0.03 AND sentiment_avg > 0.1 THEN 'bearish_divergence'
             WHEN daily_return > 0.03 AND sentiment_avg < -0.1 THEN 'bullish_divergence' ELSE anomaly_type END AS anomaly_type, {_describe('')} AS description
      FROM (SELECT a.*, a.trade_date AS anomaly_date, d.daily_sentiment AS sentiment_avg
            FROM fx_scored a LEFT JOIN fx_daily d ON a.ticker = d.ticker AND a.trade_date = d.event_day)""",
        "daily_return sentiment_avg", "anomaly_date")
    q["stored_or_dynamic"] = _anom(f"""SELECT {_ANOM} FROM fx_stored WHERE anomaly_type = 'statistical_outlier' UNION ALL
      SELECT {_ANOM} FROM fx_zanom WHERE ticker NOT IN (SELECT ticker FROM fx_stored WHERE anomaly_type = 'statistical_outlier')""")
    q["lookup_anomalies"] = _anom(f"SELECT {_ANOM} FROM fx_stored WHERE ticker = 'S1' ORDER BY anomaly_date LIMIT 200")
    q["align_events"] = _sql("SELECT ticker, anomaly_date, anomaly_score, source_type, source_id, event_ts, sentiment_score FROM fx_near",
                             "anomaly_score sentiment_score", "anomaly_date", "event_ts")
    q["classify_context"] = _sql("SELECT * FROM fx_context", "news_polarity retail_polarity max_polarity", "anomaly_date")
    q["association_rate"] = _sql("""SELECT count(*) AS anomalies, count(*) FILTER (context IN ('news', 'retail')) AS associated,
      avg(CASE WHEN context IN ('news', 'retail') THEN 1.0 ELSE 0.0 END) AS association_rate FROM fx_context""", "association_rate")
    q["directional_accuracy"] = _sql("""SELECT count(*) AS observations, count(*) FILTER (ok) AS matching, avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) AS accuracy
      FROM (SELECT sign(d.daily_sentiment) = sign(a.daily_return) AS ok FROM fx_all a JOIN fx_daily d
            ON a.ticker = d.ticker AND a.trade_date = d.event_day WHERE a.daily_return IS NOT NULL)""", "accuracy")
    q["sentiment_lead"] = _sql("""SELECT ticker, anomaly_date, last_event, date_diff('second', last_event, CAST(anomaly_date AS TIMESTAMP)) / 3600.0::DOUBLE AS lead_hours
      FROM (SELECT a.ticker, a.anomaly_date, max(s.event_ts) AS last_event FROM fx_anom a JOIN fx_sentiment s ON a.ticker = s.ticker
              AND s.event_ts < CAST(a.anomaly_date AS TIMESTAMP) AND s.event_ts >= CAST(a.anomaly_date AS TIMESTAMP) - INTERVAL 2160 HOUR
            WHERE s.source_type = 'reddit' AND a.anomaly_type IN ('volume_surge', 'price_volume_spike') GROUP BY ALL)""",
        "lead_hours", "anomaly_date", "last_event")

    q["dedupe_prices"] = _sql(f"SELECT {bar}, close_price, volume FROM fx_clean_prices", "close_price volume", "trade_date")
    q["dedupe_news"] = _sql("SELECT doc_id, title, published_date, fetched_at FROM fx_clean_news", "", "published_date", "fetched_at")
    q["dedupe_posts"] = _sql("SELECT post_id, subreddit, fetched_at FROM fx_posts", "", "", "fetched_at")
    q["explode_tickers"] = _sql(_explode("fx_news", "doc_id"))
    q["explode_tickers_raw"] = _sql("SELECT * FROM (SELECT doc_id, unnest(string_split(matched_tickers, ',')) AS ticker FROM fx_news) WHERE ticker <> ''")
    q["tag_tickers"] = _sql(f"""SELECT doc_id, coalesce(t, 'GENERAL') AS matched_tickers FROM documents LEFT JOIN (
        SELECT doc_id, string_agg(ticker, ',' ORDER BY ticker) AS t FROM (
          SELECT DISTINCT doc_id, ticker FROM documents JOIN (SELECT * FROM (VALUES {_values(FX_KEYWORDS)}) AS k(ticker, kw)) ON {_keyword_match()})
        GROUP BY doc_id) USING (doc_id)""")
    q["keywords_from_names"] = _sql("""SELECT DISTINCT 'P' || p_partkey AS ticker, unnest(CASE WHEN length(word) > 3 THEN ['p' || p_partkey, word] ELSE ['p' || p_partkey] END) AS keyword
      FROM (SELECT p_partkey, lower(string_split(trim(CASE WHEN p_partkey % 3 IN (0, 1) THEN p_name ELSE p_name || ' Ltd.' END), ' ')[1]) AS word FROM part)""")
    q["ticker_keywords"] = _sql("""SELECT ticker, lower(ticker) AS keyword FROM fx_dim UNION
      SELECT 'S' || c_custkey, lower(c_mktsegment) FROM customer WHERE 'S' || c_custkey IN (SELECT ticker FROM fx_dim)""")

    join = """fx_flat_news n {} JOIN fx_clean_prices p ON n.ticker = p.ticker AND n.published_date = p.trade_date"""
    q["news_price_aligned"] = _sql(f"""SELECT n.ticker, n.published_date AS event_date, n.source AS news_source, n.title AS headline, n.summary,
        p.close_price, p.volume, p.high_price, p.low_price FROM {join.format('')}""", "close_price volume high_price low_price", "event_date")
    q["news_price_outer"] = _sql(f"""SELECT coalesce(n.ticker, p.ticker) AS ticker, coalesce(n.published_date, p.trade_date) AS event_date, n.source AS news_source,
        n.title AS headline, p.close_price, p.volume FROM {join.format('FULL')}""", "close_price volume", "event_date")
    q["price_sentiment_joined"] = _sql(f"""SELECT a.ticker, a.trade_date, a.close_price, a.volume, d.daily_sentiment AS avg_sentiment, d.article_count,
        a.daily_return * 100 AS price_change_pct FROM fx_all a LEFT JOIN fx_daily d ON a.ticker = d.ticker AND a.trade_date = d.event_day""",
        "close_price volume avg_sentiment price_change_pct", "trade_date")
    q["blend_sentiment"] = _sql(f"SELECT {bar}, price_sentiment, real_sentiment, blended_sentiment FROM fx_blend",
                                "price_sentiment real_sentiment blended_sentiment", "trade_date")
    q["with_sector"] = _sql(f"SELECT {bar}, sector FROM fx_blend", "", "trade_date")
    q["peers"] = _sql("SELECT ticker, sector FROM fx_dim WHERE sector = (SELECT sector FROM fx_dim WHERE ticker = 'S1')")
    q["shock_window"] = _sql("""SELECT b.ticker, s.anomaly_date AS shock_date, b.trade_date, b.close_price, b.volume FROM fx_bars b JOIN fx_shocks s
      ON b.ticker = s.ticker AND b.trade_date BETWEEN s.anomaly_date - 25 AND s.anomaly_date + 25""", "close_price volume", "shock_date trade_date")

    q["daily_sentiment"] = _sql("SELECT * FROM fx_daily", "daily_sentiment", "event_day")
    q["daily_sentiment_by_source"] = _sql("""SELECT ticker, event_date AS event_day, source_type, avg(sentiment_score) AS daily_sentiment,
      count(*) AS article_count FROM fx_sentiment GROUP BY ALL""", "daily_sentiment", "event_day")
    signs = "count(*) FILTER (sentiment_label = 'positive') AS {}, count(*) FILTER (sentiment_label = 'negative') AS {}"
    q["daily_ticker_sentiment"] = _sql(f"""SELECT ticker, event_date AS trade_date, avg(sentiment_score) AS avg_sentiment, count(*) AS article_count,
      {signs.format('positive_count', 'negative_count')} FROM fx_sentiment GROUP BY ALL""", "avg_sentiment", "trade_date")
    q["daily_sector"] = _sql("SELECT * FROM fx_sector_day", "sector_avg_sentiment", "date")
    q["daily_news_volume"] = _sql("SELECT ticker, published_date AS event_date, count(*) AS article_count FROM fx_flat_news GROUP BY ALL", "", "event_date")
    q["value_counts"] = _sql("SELECT anomaly_type, count(*) AS count FROM fx_anom GROUP BY ALL")
    q["value_counts_label"] = _sql("SELECT sentiment_label, count(*) AS count FROM fx_sentiment GROUP BY ALL")
    q["sentiment_summary"] = _sql(f"""SELECT ticker, count(*) AS articles, avg(sentiment_score) AS avg_score, {signs.format('positive', 'negative')}
      FROM fx_sentiment GROUP BY ticker""", "avg_score")
    q["price_summary"] = _sql(f"""SELECT ticker, arg_max(close_price, trade_date) AS latest_close, max(high_price) AS high, min(low_price) AS low,
      avg(volume) AS avg_volume, coalesce(arg_max(daily_return, trade_date), 0) * 100 AS change_pct FROM fx_all GROUP BY ticker""",
        "latest_close high low avg_volume change_pct")
    q["overview_kpis"] = _sql("""SELECT greatest((SELECT count(*) FROM fx_dim), (SELECT count(DISTINCT ticker) FROM fx_bars)) AS stocks_tracked, m AS avg_sentiment,
        CASE WHEN m > 0.05 THEN 'Bullish' WHEN m < -0.05 THEN 'Bearish' ELSE 'Neutral' END AS mood, a AS anomalies,
        CASE WHEN named > 0 THEN named ELSE moody END AS divergences
      FROM (SELECT count(*) AS a, count(*) FILTER (lower(description) LIKE '%divergence%' OR anomaly_type LIKE '%divergence%') AS named,
              count(*) FILTER (abs(coalesce(sentiment_avg, 0)) >= 0.05) AS moody FROM fx_stored), (SELECT avg(sentiment_score) AS m FROM fx_sentiment)""", "avg_sentiment")
    q["divergence_count"] = _sql("""SELECT count(*) FILTER (lower(description) LIKE '%divergence%') AS named,
      count(*) FILTER (abs(coalesce(sentiment_avg, 0)) >= 0.05) AS by_sentiment FROM fx_stored""")
    peer = """SELECT t.ticker, sector, CAST(format('{{:.2f}}', latest) AS DOUBLE) AS current_price, CAST(format('{{:.2f}}', (latest - nth) / nth * 100) AS DOUBLE) AS return_pct,
        coalesce(n, 0) AS total_anomalies, {} AS status
      FROM (SELECT ticker, max(CASE WHEN rk = 1 THEN close_price END) AS latest, arg_max(close_price, rk) AS nth, max(rk) AS seen
            FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS rk FROM fx_bars) WHERE rk <= 30 GROUP BY ticker) t
      JOIN fx_dim USING (ticker) LEFT JOIN (SELECT ticker, count(*) AS n FROM fx_anom GROUP BY ticker) USING (ticker) WHERE seen >= 2 {}"""
    q["peer_table"] = _sql(peer.format("'Peer'", ""), "current_price return_pct")
    q["peer_table_selected"] = _sql(peer.format("CASE WHEN ticker = 'S1' THEN 'Selected' ELSE 'Peer' END",
        "AND sector = (SELECT sector FROM fx_dim WHERE ticker = 'S1')"), "current_price return_pct")
    q["row_count"] = _sql("SELECT count(*) AS rows FROM fx_anom")
    q["distinct_values"] = _sql("SELECT DISTINCT ticker FROM fx_general ORDER BY ticker")
    q["symbol_universe"] = _sql("""SELECT ticker FROM fx_dim UNION SELECT ticker FROM fx_bars
      UNION SELECT ticker FROM fx_sentiment""")
    q["dataset_status"] = _sql(" UNION ALL ".join(
        f"SELECT '{n}' AS dataset, CAST(1 AS BIGINT) AS files, count(*) AS rows, count(*) > 0 AS ready FROM {n}" for n in
        ("benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation", "orders", "pages", "part", "region",
         "supplier")))

    for n in (30, 60, 90):
        q[f"sector_momentum_{n}"] = _mom(_momentum("fx_sector_day", n, False))
    q["all_momentum"] = q["ordered_momentum"] = _mom("SELECT * FROM fx_mom")
    q["strict_momentum"] = _mom(" UNION ALL ".join(_momentum("fx_sector_day", n, True) for n in (30, 60, 90)))
    q["momentum_pivot"] = _sql("""SELECT * FROM (PIVOT (SELECT sector, strftime(end_date, '%Y-%m-%d') AS day, momentum_score FROM fx_mom
        WHERE window_days = 30 AND end_date >= DATE '1998-01-01') ON day USING round(avg(momentum_score) + 1e-10, 6) + 0.0 GROUP BY sector)""")
    q["momentum_matrix"] = _sql("SELECT sector, end_date, avg(momentum_score) AS momentum_score FROM fx_mom WHERE window_days = 30 GROUP BY ALL",
                                "momentum_score", "end_date")
    q["latest_momentum"] = _mom("SELECT * FROM fx_mom WHERE end_date = (SELECT max(end_date) FROM fx_mom)")
    q["latest_per_sector"] = _sql("""SELECT sector, end_date, momentum_score, avg_sentiment, ticker_count FROM fx_mom WHERE window_days = 30
      QUALIFY row_number() OVER (PARTITION BY sector ORDER BY end_date DESC) = 1""", _MOM_D, "end_date")

    q["top_anomalies"] = _anom(f"SELECT {_ANOM} FROM fx_stored ORDER BY anomaly_score DESC, ticker, anomaly_date LIMIT 10")
    q["recent_anomalies"] = _anom(f"SELECT {_ANOM} FROM fx_stored ORDER BY anomaly_date DESC, anomaly_score DESC, ticker LIMIT 10")
    q["top_shocks"] = _anom(f"SELECT {_ANOM} FROM fx_shocks")
    q["top_tickers"] = _sql("""SELECT ticker, count(*) AS article_count, avg(sentiment_score) AS avg_sentiment FROM fx_sentiment GROUP BY ticker
      ORDER BY article_count DESC, ticker LIMIT 10""", "avg_sentiment")

    share = "len(regexp_extract_all(text, '{}')) / length(text)::DOUBLE"
    q["score_partitions"] = q["score_udf"] = _sql(f"""SELECT doc_id, sentiment_score, {_label('sentiment_score')} AS sentiment_label, confidence FROM (
        SELECT doc_id, CASE WHEN length(text) > 0 THEN {share.format('\\p{Lu}')} ELSE 0.0 END AS sentiment_score,
               CASE WHEN length(text) > 0 THEN {share.format('[0-9]')} ELSE 0.0 END AS confidence FROM documents)""", "sentiment_score confidence")
    q["write_fixed_files"] = _sql("SELECT 'bars' AS dataset, CAST(3 AS BIGINT) AS files, count(*) AS rows, count(*) > 0 AS ready FROM fx_bars")
    q["append_batches"] = _sql("SELECT CASE WHEN conv_id % 3 > 0 THEN '2024-01-01' ELSE '2024-01-02' END AS ingest_date, post_id, subreddit FROM fx_posts")
    q["stored_tables"] = q["daily_ticker_sentiment"]

    span = "BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"
    q["page_overview"] = _sql(f"""SELECT r.*, k.* FROM (SELECT {_ANOM} FROM fx_stored WHERE anomaly_date {span} AND anomaly_type = 'volume_surge'
        ORDER BY anomaly_date DESC, anomaly_score DESC, ticker LIMIT 10) r,
      (SELECT greatest((SELECT count(*) FROM fx_dim), (SELECT count(DISTINCT ticker) FROM fx_bars WHERE trade_date {span})) AS stocks_tracked, m AS avg_sentiment,
          CASE WHEN m > 0.05 THEN 'Bullish' WHEN m < -0.05 THEN 'Bearish' ELSE 'Neutral' END AS mood,
          (SELECT count(*) FROM fx_stored WHERE anomaly_date {span} AND anomaly_type = 'volume_surge') AS anomalies
        FROM (SELECT avg(sentiment_score) AS m FROM fx_sentiment WHERE event_date {span})) k""", f"{_ANOM_D} avg_sentiment", _ANOM_T)
    q["page_ticker"] = _sql("""SELECT p.ticker, p.trade_date, p.close_price, daily_sentiment, article_count, anomaly_type, latest_close, high, low
      FROM (SELECT * FROM fx_bars WHERE ticker = 'S1' QUALIFY row_number() OVER (ORDER BY trade_date DESC) <= 500) p
      LEFT JOIN fx_daily d ON p.ticker = d.ticker AND p.trade_date = d.event_day LEFT JOIN fx_stored a ON p.ticker = a.ticker AND p.trade_date = a.anomaly_date,
      (SELECT arg_max(close_price, trade_date) AS latest_close, max(high_price) AS high, min(low_price) AS low FROM fx_bars WHERE ticker = 'S1')""",
        "close_price daily_sentiment latest_close high low", "trade_date")
    q["page_heatmap"] = _sql("""SELECT sector, end_date, avg(momentum_score) AS momentum_score, any_value(latest_date) AS latest_date, any_value(latest_score) AS latest_score
      FROM fx_mom JOIN (SELECT sector, end_date AS latest_date, momentum_score AS latest_score FROM fx_mom WHERE window_days = 30
        QUALIFY row_number() OVER (PARTITION BY sector ORDER BY end_date DESC) = 1) USING (sector) WHERE window_days = 30 GROUP BY sector, end_date""",
        "momentum_score latest_score", "end_date latest_date")
    q["page_replay"] = _sql(f"""SELECT b.ticker, b.trade_date, b.close_price, b.close_price / first_close * 100 AS normalized_return, anomaly_type
      FROM (SELECT *, first_value(close_price) OVER ({_W}) AS first_close FROM fx_bars WHERE ticker IN ('S1', 'S2', 'S3', 'S5') AND trade_date {span}) b
      LEFT JOIN fx_stored a ON b.ticker = a.ticker AND b.trade_date = a.anomaly_date WHERE first_close > 0""", "close_price normalized_return", "trade_date")

    q["text_events"] = _sql("SELECT * FROM fx_texts", "", "event_date")
    q["tokenize"] = _sql("""SELECT doc_id, len(w) AS words, len(kept) AS kept, array_to_string(kept, ' ') AS text FROM fx_kept""")
    q["term_tfidf"] = _sql("""SELECT doc_id, term, tf, df, idf, tf * idf AS tfidf FROM fx_terms JOIN (
        SELECT term, count(*) AS df, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)::DOUBLE) AS idf FROM fx_terms GROUP BY term) USING (term)""", "idf tfidf")
    scored = """greatest(-1.0, least(1.0, coalesce(score, 0.0))) AS sentiment_score, coalesce(subjectivity, 0.0) AS confidence"""
    q["lexicon_sentiment"] = _sql(f"""SELECT *, {_label('sentiment_score')} AS sentiment_label FROM (
        SELECT doc_id, lang, {scored} FROM documents LEFT JOIN ({_lexicon_scores('documents', 'doc_id', 'text')}) USING (doc_id))""",
        "sentiment_score confidence")
    by_ticker = """SELECT source_type, source_id, ticker, sentiment_score, {} AS sentiment_label, confidence,
        event_date, '2024-01-01T00:00:00' AS processed_at FROM (
          SELECT source_type, source_id, event_date, {}, trim(unnest(string_split(matched_tickers, ','))) AS ticker
          FROM (SELECT *, source_type || source_id AS id FROM {}) LEFT JOIN ({}) USING (id))
        WHERE ticker NOT IN ('', 'GENERAL')"""
    ids = "(SELECT source_type || source_id AS id, text FROM fx_texts)"
    q["sentiment_by_ticker"] = _sql(by_ticker.format(_label("sentiment_score"), scored, "fx_texts", _lexicon_scores(ids, "id", "text")),
                                    "sentiment_score confidence", "event_date")
    # The job reads every fetch, so articles that were fetched twice count twice.
    twice = """(SELECT * FROM fx_texts UNION ALL SELECT * FROM fx_texts WHERE source_type = 'news' AND CAST(source_id AS BIGINT) % 5 = 0)"""
    q["sentiment_job"] = _sql(by_ticker.format(_label("sentiment_score"), scored, twice, _lexicon_scores(ids, "id", "text", NEGATORS)),
                              "sentiment_score confidence", "event_date")
    q["read_prices_csv"] = _sql(f"SELECT {bar}, open_price, high_price, low_price, close_price, volume FROM fx_bars",
                                "open_price high_price low_price close_price volume", "trade_date")
    q["read_news_csv"] = _sql("SELECT link, source, trim(title) AS title, nullif(trim(summary), '') AS summary, published_date, matched_tickers FROM fx_news_refetched", "", "published_date")
    q["read_reddit_csv"] = _sql("SELECT post_id, subreddit, trim(selftext) AS selftext, created_utc, matched_tickers FROM fx_posts", "", "created_utc")
    kind, text = "(conv_id * 7 + turn) % 10", "('say \"' || role || '\", ' || text)"
    quoted = f"'\"' || replace({text}, '\"', '\"\"') || '\"'"
    bad = f"CASE {kind} WHEN 3 THEN 'no ' || turn ELSE CAST(turn AS VARCHAR) END"
    line = f"""CASE WHEN conv_id % 2 = 0 THEN conv_id || ',' || {bad} || ',' || {quoted} ELSE {quoted} || ',' || {bad} || ',' || conv_id END
      || CASE WHEN {kind} = 5 THEN ',one,more' ELSE '' END"""
    q["read_dir_bad_lines"] = f"""SELECT 'sound' AS kind, conv_id, turn, md5(trim({text})) AS digest, length(trim({text})) AS size
        FROM conversations WHERE {kind} NOT IN (3, 5)
      UNION ALL SELECT CASE {kind} WHEN 3 THEN 'turn' ELSE 'number of fields' END, NULL, NULL, md5({line}), length({line}) FROM conversations WHERE {kind} IN (3, 5)"""
    q["read_or_empty"] = f"""SELECT * FROM (SELECT count(*) AS turns, CAST(sum(turn) AS BIGINT) AS total, count(text) AS texts FROM conversations WHERE {kind} NOT IN (3, 5)),
      (SELECT count(*) AS parts, max(p_name) AS last FROM part), (SELECT CAST(0 AS BIGINT) AS none)"""
    q["read_first_available"] = "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_type FROM part WHERE p_partkey % 2 = 0"
    q["read_ticker"] = _sql(f"SELECT {bar}, close_price, year(trade_date) AS year FROM fx_bars WHERE ticker = 'S1'", "close_price", "trade_date")
    q["etl_job"] = _sql(f"""SELECT n.ticker, n.published_date AS event_date, n.source AS news_source, trim(n.title) AS headline, nullif(trim(n.summary), '') AS summary,
        p.close_price, p.volume, p.high_price, p.low_price FROM {join.format('')}""", "close_price volume high_price low_price", "event_date")
    q["anomaly_job"] = q["correlate_sentiment"]
    q["momentum_job"] = q["all_momentum"]
    q["anomaly_job_intraday"] = _sql(f"SELECT {_ANOM}, sentiment_avg, anomaly_ts FROM fx_iday_stored", f"{_ANOM_D} sentiment_avg", _ANOM_T, "anomaly_ts")
    q["momentum_job_intraday"] = _mom(" UNION ALL ".join(_momentum("fx_iday_sector", n, False) for n in (30, 60, 90)))

    q["rename"] = _sql("SELECT s_suppkey AS ticker_id, s_name, s_nationkey::BIGINT AS s_nationkey, s_acctbal AS close_price FROM supplier", "close_price")
    q["normalize_prices"] = _sql(f"""SELECT ticker, CAST(trade_date AS TIMESTAMP) AS trade_date, open_price, close_price,
        CASE WHEN volume <= 60 THEN volume END AS volume FROM fx_bars""", "open_price close_price volume", "", "trade_date")
    q["normalize_sentiment"] = _sql("""SELECT ticker, event_ts AS event_date, sentiment_score, sentiment_label, source_id FROM fx_sentiment""",
                                    "sentiment_score", "", "event_date")
    q["normalize_anomalies"] = _sql("""SELECT ticker, CAST(anomaly_date AS TIMESTAMP) AS anomaly_date, close_price, anomaly_score, anomaly_type FROM fx_anom""",
                                    "close_price anomaly_score", "", "anomaly_date")
    q["normalize_momentum"] = _sql("""SELECT sector, momentum_score, window_days::DOUBLE AS window_days, CAST(end_date AS TIMESTAMP) AS end_date FROM fx_mom""",
                                   "momentum_score window_days", "", "end_date")
    headers = """(SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'source' ELSE o_orderpriority END AS source,
      CASE WHEN o_orderkey % 89 = 0 THEN ' title ' WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_orderstatus END AS title, o_orderkey AS id FROM orders)"""
    q["drop_header_rows_first"] = _sql(f"SELECT * FROM {headers} WHERE source <> 'source'")
    q["drop_header_rows_any"] = _sql(f"SELECT * FROM {headers} WHERE source <> 'source' AND coalesce(trim(title), '') <> 'title'")
    ts = "(o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)))"
    q["parse_dates"] = _sql(f"""SELECT o_orderkey, CASE o_orderkey % 6
        WHEN 3 THEN substr(strftime({ts}, '%a, %d %b'), 1, 10) WHEN 5 THEN strftime({ts}, '%d/%m soon') ELSE strftime({ts}, '%Y-%m-%d') END AS day_key,
        ts, CAST(ts AS DATE) AS day FROM (SELECT *, CASE o_orderkey % 6 WHEN 0 THEN date_trunc('day', {ts}) WHEN 3 THEN {ts} - INTERVAL 330 MINUTE
          WHEN 4 THEN {ts} + INTERVAL 5 HOUR WHEN 5 THEN NULL ELSE {ts} END AS ts FROM orders)""", "", "day", "ts")
    q["norm_key"] = _sql("SELECT c_custkey, upper(c_mktsegment) AS key FROM customer")
    q["clean_symbol"] = _sql("SELECT c_custkey, 'SYM' || c_custkey AS symbol, CASE WHEN c_custkey % 2 = 0 THEN 'NSE' ELSE 'BSE' END AS exchange FROM customer")
    q["to_number"] = _sql("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders", "price")
    q["to_number_if_all"] = _sql("""SELECT o_orderkey, o_totalprice AS all_numbers,
      CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS some_numbers FROM orders""", "all_numbers")
    q["build_text"] = _sql("""SELECT o_orderkey, trim(CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END || ' ' ||
      CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END) AS text FROM orders WHERE o_orderkey % 15 <> 0""")
    decoded = "regexp_replace(html, '<[^>]+>', '', 'g')"
    # The entities that occur in the given pages.
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&#39;", "''"),
                         ("&amp;", "&"), ("&amp", "&")):
        decoded = f"replace({decoded}, '{entity}', '{char}')"
    q["clean_html"] = _sql(f"SELECT page_id, regexp_replace({decoded}, '^\\s+|\\s+$', '', 'g') AS text FROM pages")
    q["sanitize_text"] = _sql("""SELECT doc_id, translate(substr(text, 1, 500), chr(10) || ',', '  ') AS title,
      translate(substr(text, 1, 1000), chr(10) || ',', '  ') AS body FROM documents""")
    ms = "(event_id * 7919 + 1700000000000)"
    d = "(event_id * 7919 // 1000)"
    q["epoch_text"] = _sql(f"""SELECT event_id, strftime(epoch_ms({ms}), '%Y-%m-%dT%H:%M:%S') AS iso, strftime(epoch_ms({ms}), '%d %b %Y %H:%M:%S') AS readable,
      CASE WHEN {d} >= 3600 THEN printf('%dh %02dm %02ds', {d} // 3600, {d} % 3600 // 60, {d} % 60)
           ELSE printf('%dm %02ds', {d} // 60, {d} % 60) END AS duration FROM events""")
    q["fill_defaults"] = _sql("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '[deleted]' ELSE c_name END AS author,
      CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS flair, CASE WHEN c_custkey % 5 = 0 THEN 'GENERAL' ELSE 'S1' END AS matched_tickers,
      CASE WHEN c_custkey % 2 = 0 THEN 'A,B' ELSE 'GENERAL' END AS joined FROM customer""")
    q["drop_null"] = _sql(f"SELECT {bar}, daily_return, close_price FROM fx_all WHERE daily_return IS NOT NULL", "daily_return close_price", "trade_date")
    q["has_value"] = _sql("SELECT o_orderkey, o_orderstatus AS tag FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 3 <> 0")
    q["drop_general"] = _sql("SELECT ticker, source_type, source_id FROM fx_sentiment")
    q["filter_view"] = _anom(f"""SELECT {_ANOM} FROM fx_stored WHERE anomaly_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'
      AND anomaly_type = 'price_volume_spike'""")
    q["filter_view_intraday"] = _sql("""SELECT ticker, close_price, volume FROM fx_intraday
      WHERE trade_date BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-05'""", "close_price volume")
    q["filter_basket"] = _sql(f"""SELECT {bar}, close_price FROM fx_bars WHERE ticker IN ('S1', 'S2', 'S3', 'S5')
      AND trade_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""", "close_price", "trade_date")
    q["run_columns"] = _sql("SELECT ticker, sector, '2024-01-01T00:00:00' AS processed_at, CAST(NULL AS DOUBLE) AS sentiment_avg FROM fx_dim")
    q["stream_ingest"] = _sql("SELECT post_id, subreddit, event_ts FROM fx_posts", "", "", "event_ts")
    q["stream_daily_sentiment"] = _sql("""SELECT ticker, event_day, avg(v) AS daily_sentiment, count(*) AS article_count FROM (
        SELECT 'U' || user_id AS ticker, CAST(ts AS DATE) AS event_day, value - 20 AS v FROM events)
      GROUP BY ticker, event_day HAVING CAST(event_day + 1 AS TIMESTAMP) <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""", "daily_sentiment", "event_day")
    q["scalar_rules"] = _sql(f"""SELECT {bar}, CASE WHEN daily_return > 0.01 THEN 1.0 WHEN daily_return < -0.01 THEN -1.0 ELSE 0.0 END::DOUBLE AS proxy,
        price_range AS spread, {_label('daily_return', 0.05)} AS label,
        CASE WHEN daily_return > 0.05 THEN 'Bullish' WHEN daily_return < -0.05 THEN 'Bearish' ELSE 'Neutral' END AS mood,
        contains(anomaly_type, 'volume') AS volume_type, format('{{:+.1f}}%', daily_return * 100) AS pct,
        CASE anomaly_type WHEN 'price_volume_spike' THEN 'Price Volume Spike' WHEN 'volume_surge' THEN 'Volume Surge'
          WHEN 'price_spike' THEN 'Price Spike' ELSE 'Statistical Outlier' END AS title, CAST(trade_date - 30 AS DATE) AS start_date FROM fx_scored""",
        "proxy spread", "trade_date start_date")
    return q
