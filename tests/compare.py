"""Run registered queries in Spark and in DuckDB and compare the rows.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is not None, str(type(v).__name__ == "str"), v if not isinstance(v, float) else round(v, 5)) for v in row)


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*names).collect()), key=_key)


def rows_of_duck(con, sql: str):
    cur = con.execute(sql)
    order = sorted(range(len(cur.description)), key=lambda i: cur.description[i][0])
    names = [cur.description[i][0] for i in order]
    return names, sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=_key)


def differences(left, right, limit: int = 3):
    (names_l, rows_l), (names_r, rows_r) = left, right
    if names_l != names_r:
        return [f"columns {names_l} / {names_r}"]
    out = [] if len(rows_l) == len(rows_r) else [f"rows {len(rows_l)} / {len(rows_r)}"]
    if rows_l and rows_r:
        kinds = [(n, type(a).__name__, type(b).__name__) for n, a, b in zip(names_l, rows_l[0], rows_r[0])
                 if type(a) is not type(b) and None not in (a, b)]
        out += [f"types {kinds}"] if kinds else []
    wrong = [(a, b) for a, b in zip(rows_l, rows_r) if a != b]
    if wrong:
        out.append(f"{len(wrong)} rows differ")
        out += [f"  {dict(zip(names_l, a))}\n  {dict(zip(names_l, b))}" for a, b in wrong[:limit]]
    return out


def main() -> int:
    import __spark_entry__ as entry
    from tidemark.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            left = rows_of_spark(run(spark, sf_dir))
            took, start = time.time() - start, time.time()
            if name not in sql:
                print(f"rows  {name:28s} {len(left[1]):8d} {took:6.2f}s", flush=True)
                continue
            diff = differences(left, rows_of_duck(con, sql[name]))
        except Exception as error:  # report and go on with the next query
            diff, took = [str(error)[:1500]], 0.0
        bad += bool(diff)
        print(f"{'DIFF ' if diff else 'ok   '} {name:28s} {len(left[1]):8d} {took:6.2f}s {time.time() - start:6.2f}s", flush=True)
        for line in diff:
            print("     ", line, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
