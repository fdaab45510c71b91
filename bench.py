"""Time the headline queries; prints one JSON line.

Each query is written to Spark's no-op sink, so all rows and columns are
computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "detect_anomalies", "correlate_sentiment", "divergences", "classify_context", "sentiment_by_ticker",
    "lexicon_sentiment", "tag_tickers", "term_tfidf", "all_momentum", "price_momentum", "zscore_anomalies",
    "iso_forest", "dedupe_prices", "dedupe_news", "news_price_aligned", "daily_ticker_sentiment", "shock_window",
    "peer_table", "overview_kpis", "intraday_features",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from tidemark.plans.catalog import QUERIES
    from tidemark.session import build_session

    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
        # Inputs are small here while window frames cost time per row: do not merge partitions below this size.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
