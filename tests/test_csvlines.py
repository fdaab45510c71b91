"""One-scan CSV reading: records over several lines and splits, mixed and quoted headers, malformed records."""

import csv
import os
import random

import pytest

from tidemark.sources import csvlines, readers


def drawn(draw):
    return "".join(draw.choice(["a", "b ", ",", '"', "\n", "é", '""', "'", ""]) for _ in range(draw.randrange(0, 30)))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Three files with their columns in three orders, in a folder whose name has to be quoted in a path."""
    path, draw, want = f"{tmp_path_factory.mktemp('csv')}/a folder, 50%", random.Random(1), []
    os.makedirs(path)
    for f, head in enumerate([["Id", "Some, Text", "n"], ["n", "ID", "some, text"], ["some, text", " id ", "other"]]):
        with open(f"{path}/f {f}.csv", "w", newline="") as file:
            writer = csv.writer(file, lineterminator="\r\n" if f == 1 else "\n")
            writer.writerow(head)
            for k in range(60):
                i, text, n = f"{f}-{k}", drawn(draw), str(k)
                writer.writerow([[i, text, n], [n, i, text], [text, i, n]][f])
                want.append((i, text.strip(" ") or None, None if f == 2 else n))
    return path, sorted(want)


NAMES = {"id": ("id",), "text": ("some, text",), "n": ("n",)}


@pytest.mark.parametrize("split", ["1500", "128m"])
def test_records_cross_lines_and_splits(spark, folder, split):
    path, want = folder
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = csvlines.read_csv(spark, path, NAMES)
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(tuple(r)[:3] for r in rows) == want and not any(r["_bad"] for r in rows)


def test_landed_bytes_are_read_once(spark, folder, monkeypatch):
    seen = []
    original = csvlines.materialize
    monkeypatch.setattr(csvlines, "materialize", lambda df, name: seen.append(df._jdf.queryExecution().toString()) or original(df, name))
    out = csvlines.read_csv(spark, folder[0], NAMES)
    plans = [*seen, out._jdf.queryExecution().toString()]
    assert sum("Format: Text" in plan for plan in plans) == 1 and "Format: CSV" not in "".join(plans)


def test_open_quotes_by_brute_force():
    draw = random.Random(2)

    def slow(line, inside):
        state = "quoted" if inside else "start"
        k = 0
        while k < len(line):
            c = line[k]
            if state == "quoted":
                if c == '"' and line[k + 1:k + 2] == '"':
                    k += 1
                elif c == '"':
                    state = "plain"
            elif c == ",":
                state = "start"
            elif state == "start":
                state = "quoted" if c == '"' else "plain"
            k += 1
        return state == "quoted"
    for _ in range(5_000):
        line = "".join(draw.choice('",a') for _ in range(draw.randrange(0, 12)))
        assert csvlines.ends_inside(line, False) == slow(line, False) and csvlines.ends_inside(line, True) == slow(line, True), line


def test_malformed_records_do_not_depend_on_the_columns_used(spark, tmp_path):
    os.makedirs(f"{tmp_path}/d")
    with open(f"{tmp_path}/d/a.csv", "w") as file:
        file.write('﻿b,a\n1,2\n\nx,3\n4,5,6,7\n8\n,9\n"open,1\n')
    layout = "a int, b int"
    skip = readers.read_dir(spark, f"{tmp_path}/d", layout)
    assert sorted(map(tuple, skip.collect()), key=str) == [(2, 1), (9, None)]
    assert skip.count() == skip.select("a").count() == len(skip.select("b").collect()) == 2
    kept = readers.read_dir(spark, f"{tmp_path}/d", layout, bad_lines="keep")
    assert kept.count() == 6 and kept.where("_corrupt_record IS NOT NULL").count() == 4
    good, rejects = readers.read_dir_parts(spark, f"{tmp_path}/d", layout)
    assert good.count() == 2
    assert sorted((r.record, r.reason) for r in rejects.collect()) == [
        ('"open,1', "number of fields"), ("4,5,6,7", "number of fields"), ("8", "number of fields"), ("x,3", "b")]
    fail = readers.read_dir(spark, f"{tmp_path}/d", layout, bad_lines="fail")
    for use in (fail.count, fail.select("a").collect):
        with pytest.raises(Exception, match="malformed record"):
            use()
    assert readers.read_dir(spark, f"{tmp_path}/d").columns == ["b", "a"]


def test_empty_files_and_folders(spark, tmp_path):
    os.makedirs(f"{tmp_path}/e")
    open(f"{tmp_path}/e/a.csv", "w").close()
    assert csvlines.read_csv(spark, f"{tmp_path}/e", NAMES).count() == 0
    with open(f"{tmp_path}/e/b.csv", "w") as file:
        file.write("id,n\n")
    assert csvlines.read_csv(spark, f"{tmp_path}/e", NAMES).count() == 0


def test_records_are_put_together_where_their_lines_lie(spark, tmp_path):
    rows = [(k, f"first {k}\nsecond, \"quoted\"\n\nlast") for k in range(300)]
    with open(tmp_path / "a.csv", "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(["id", "text"])
        writer.writerows(rows)
    lines = csvlines._lines(spark, str(tmp_path / "a.csv"))
    splits = csvlines._splits(lines)
    parts = csvlines._records(lines, splits)
    assert parts.count() == len(rows) + 1
    assert csvlines._records(lines, splits, 1).collect()[0].value == "id,text"
    got = csvlines.read_csv(spark, str(tmp_path / "a.csv"), {c: (c,) for c in ("id", "text")})
    assert sorted((int(r.id), r.text) for r in got.collect()) == rows
    # Nothing of the size of the text is shuffled: lines meet the splits, and records the headers, by broadcast.
    plan = got._jdf.queryExecution().simpleString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("ticker, quoted", [("A", False), ('"A, B"', True)])
def test_a_record_is_parsed_once_whatever_is_asked_of_its_fields(spark, tmp_path, ticker, quoted):
    with open(tmp_path / "a.csv", "w") as out:
        out.write(f"Date,Ticker,Close\n2024-01-02,{ticker},1.5\nDate,x,2\n")
    got = readers.read_prices(spark, str(tmp_path / "a.csv"))
    assert [(str(r.trade_date), r.ticker, r.close_price) for r in got.collect()] == [("2024-01-02", ticker.strip('"'), 1.5)]
    # The condition on the date stays above the parsing, records of one line take one reading, and lines without quotes no CSV parser.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("from_csv(") == quoted and plan.count("parquet") == 3
