"""What a query reads several times is computed once."""

import pytest

from tidemark.operators import momentum, sentiment
from tidemark.plans import catalog, jobs


@pytest.fixture
def plans(monkeypatch):
    """Optimized plans of all that is written to the shared folder."""
    seen = []
    for module in (catalog, momentum, sentiment):
        def kept(df, name, write=getattr(module, "materialize", lambda df, name: df)):
            seen.append(plan(df))
            return write(df, name)
        monkeypatch.setattr(module, "materialize", kept, raising=False)
    return seen


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_words_are_counted_once_where_their_text_lies(spark, plans):
    docs = spark.createDataFrame([(1, "a b the b"), (2, "b c"), (2, "c"), (3, None)], "doc_id long, text string")
    out = sentiment.term_tfidf(docs)
    got = {(r.doc_id, r.term, r.tf, r.df) for r in out.collect()}
    assert got == {(1, "b", 2, 2), (2, "b", 1, 2), (2, "c", 2, 1)} and {round(r.idf, 6) for r in out.collect()} == {0.510826, 0.916291}
    assert sum(p.count("split(") for p in [*plans, plan(out)]) == 1


def test_stored_or_dynamic_aggregates_bars_once(spark, sf, plans):
    out = catalog.stored_or_dynamic(spark, sf)
    assert sum(p.count("min_by(") for p in [*plans, plan(out)]) == 1
    # Nor are the features of the outliers computed again for the tickers that have none.
    assert "sma_20" not in plan(out)


def test_wide_momentum_is_computed_once(spark, plans):
    rows = [("A", 30, "2024-01-02", 1.0), ("A", 60, "2024-01-02", 9.0), ("B", 30, "2024-01-03", 2.0)]
    frame = spark.createDataFrame(rows, "sector string, window_days int, end_date string, momentum_score double")
    out = momentum.momentum_pivot(frame.withColumn("end_date", frame.end_date.cast("date")), 30)
    assert sorted(map(tuple, out.collect())) == [("A", 1.0, None), ("B", None, 2.0)]
    assert len(plans) == 1 and "LogicalRDD" not in plan(out) and "parquet" in plan(out)


def test_jobs_parse_landed_bars_once(spark, tmp_path, monkeypatch):
    paths, seen = jobs.Paths(str(tmp_path)), []
    (tmp_path / "raw/prices").mkdir(parents=True)
    days = "\n".join(f"2024-01-{k:02d},A,{100 + 30 * (k == 25)},{k},101,99" for k in range(1, 29))
    (tmp_path / "raw/prices/a.csv").write_text(f"Date,Ticker,Close,Volume,High,Low\n{days}\n")
    write = jobs.sinks.write_dataset
    monkeypatch.setattr(jobs.sinks, "write_dataset", lambda df, *args, **kw: seen.append(plan(df)) or write(df, *args, **kw))
    out = jobs.run_anomalies(spark, paths)["anomalies"]
    assert "2024-01-25" in {str(r.anomaly_date) for r in out.collect()}
    # What counts and windows start from is typed already.
    assert len(seen) == 1 and "split(" not in seen[0]
