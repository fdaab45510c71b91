"""CSV folders in one scan: bound by header name, records over several lines, malformed records kept apart.

Files are read as lines, in splits like any text, so one big file is many tasks, also where quoted fields hold line ends. Whether a
split begins inside a quoted field is not known to its task; so each line is noted with what it would be in either case. Per file
the splits are then followed in order, which settles the case of each of them. Records of several lines are put together where
their lines lie; only those that end in another task's lines take a shuffle. The lines are written once to the shared folder; everything after starts from there.

A file's header is its first record. Headers are parsed once per file and meet the lines by split, never by file, so a file
with most of the rows is no hot key, and no list of files reaches the driver.

Quotes follow the usual rule: a quoted field begins with a quote right after a comma or the line's start, and a quote inside is
doubled; a quote elsewhere is an ordinary character. Empty lines between records are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.align import small
from tidemark.session import materialize

SPLIT = ["file", "block"]
#: A last field of our own, by whose place the fields of a record are counted. No field may be this control character.
END = "\u0001"
#: What a record has if more than its commas may matter: quotes and control characters.
ODD = r'["\x00-\x1F\x7F]'


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line that began inside one, or not."""
    at, size = 0, len(line)
    while True:
        if inside:
            while True:
                at = line.find('"', at)
                if at < 0:
                    return True
                if line[at + 1:at + 2] != '"':
                    break
                at += 2
            at = line.find(",", at + 1)
            if at < 0:
                return False
            at += 1
        # At the start of a field.
        if at >= size:
            return False
        if line[at] == '"':
            inside, at = True, at + 1
            continue
        at = line.find(",", at)
        if at < 0:
            return False
        at += 1
        inside = False


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their number in the split, and for either case of its start: is a field open before (i) and after (o) the line,
    and the number of the record it belongs to (r), 0 being the last one of the split before; and whether it is odd. Only lines with
    quotes are followed one by one; between them nothing changes."""
    split, n, state, record = None, 0, [0, 1], [0, 0]
    for batch in batches:
        file, block, value = (batch.column(c) for c in ("file", "block", "value"))
        size = batch.num_rows
        if not size:
            continue
        other = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1])).to_numpy(zero_copy_only=False)
        quoted = np.flatnonzero(pc.match_substring(value, '"').to_numpy(zero_copy_only=False))
        filled = pc.match_substring_regex(value, "[!-~]").to_numpy(zero_copy_only=False).copy()
        for k in np.flatnonzero(~filled):
            filled[k] = bool(value[int(k)].as_py().strip())
        out = np.empty((7, size), dtype=np.int32)
        starts = [0, *(np.flatnonzero(other) + 1)]
        for start, end in zip(starts, [*starts[1:], size]):
            own = (file[int(start)].as_py(), block[int(start)].as_py())
            if own != split:
                split, n, state, record = own, 0, [0, 1], [0, 0]
            lines = quoted[np.searchsorted(quoted, start):np.searchsorted(quoted, end)]
            states = [state]
            for k in lines:
                line = value[int(k)].as_py()
                states.append([int(ends_inside(line, bool(s))) for s in states[-1]])
            states, state = np.array(states, dtype=np.int32), states[-1]
            at = np.arange(start, end)
            out[0, start:end] = n + 1 + at - start
            before, after = states[np.searchsorted(lines, at, "left")], states[np.searchsorted(lines, at, "right")]
            for case in (0, 1):
                records = record[case] + np.cumsum((before[:, case] == 0) & filled[start:end])
                out[1 + case, start:end], out[3 + case, start:end], out[5 + case, start:end] = before[:, case], after[:, case], records
                record[case] = int(records[-1])
            n += int(end - start)
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x) for x in out), pc.match_substring_regex(value, ODD)],
                                         [*batch.schema.names, "n", "i0", "i1", "o0", "o1", "r0", "r1", "odd"])


PART = "file string, first long, record int, block long, n int, value string, whole boolean"


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of records over several lines, put together as far as they follow each other here: whole records, and parts of others."""
    layout = pa.schema([("file", pa.string()), ("first", pa.int64()), ("record", pa.int32()), ("block", pa.int64()), ("n", pa.int32()),
                        ("value", pa.string()), ("whole", pa.bool_())])
    key, last, begun, closed, start, lines, out = None, 0, False, False, 0, [], []

    def part() -> tuple:
        return (*key, start, "\n".join(lines), begun and closed)

    for batch in batches:
        for *own, n, value, before, after in zip(*(c.to_pylist() for c in batch.columns)):
            if lines and (own != key or n != last + 1 or closed):
                out.append(part())
                lines = []
            if not lines:
                key, begun, start = own, not before, n
            lines.append(value)
            last, closed = n, not after
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), layout)], schema=layout)
            out = []
    if lines:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(part(), layout)], schema=layout)


def _lines(spark: SparkSession, path: str, **options) -> DataFrame:
    text = spark.read.options(lineSep="\n", **options).text(path)
    value = F.when(F.contains("value", F.lit("\r")), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value"))
    raw = text.select(value.alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    layout = "value string, file string, block long, n int, i0 int, i1 int, o0 int, o1 int, r0 int, r1 int, odd boolean"
    return materialize(raw.mapInArrow(_number, layout), "csv-lines")


def _splits(lines: DataFrame) -> DataFrame:
    """(file, block, inside, owner, owner_record, opens, odd): the case of each split, the record that its first lines continue, whether
    a field is open after some line, were none open at the split's start, and whether some line is odd. Where none opens in any split,
    every record is one line."""
    # Of the last line, as plain numbers: those need no sort. Record numbers only rise.
    last = F.max(F.col("n").cast("long") * 4 + F.col("o0") * 2 + F.col("o1"))
    ends = lines.groupBy(*SPLIT).agg(last.alias("l"), F.max("r0").alias("r0"), F.max("r1").alias("r1"), F.max("o0").alias("opens"), F.max("odd").alias("odd")).select(
        *SPLIT, "opens", "odd", F.struct(F.shiftright("l", 1).bitwiseAND(1).cast("int").alias("o0"), F.col("l").bitwiseAND(1).cast("int").alias("o1"), "r0", "r1").alias("e"))
    # A file has as many splits as its size asks for; they are followed in one array.
    per_file = ends.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "e.o0", "e.o1", "e.r0", "e.r1", "opens", "odd"))).alias("s"))
    start = F.struct(F.lit(0).alias("inside"), F.lit(-1).cast("long").alias("owner"), F.lit(0).alias("record"),
                     F.array().cast("array<struct<block:bigint,inside:int,owner:bigint,record:int,opens:int,odd:boolean>>").alias("out"))

    def follow(acc: Column, x: Column) -> Column:
        own = F.when(acc["inside"] == 1, x["r1"]).otherwise(x["r0"])
        return F.struct(
            F.when(acc["inside"] == 1, x["o1"]).otherwise(x["o0"]).alias("inside"),
            F.when(own > 0, x["block"]).otherwise(acc["owner"]).alias("owner"), F.when(own > 0, own).otherwise(acc["record"]).alias("record"),
            F.concat(acc["out"], F.array(F.struct(x["block"].alias("block"), acc["inside"].alias("inside"), acc["owner"].alias("owner"),
                                                  acc["record"].alias("record"), x["opens"].alias("opens"), x["odd"].alias("odd")))).alias("out"))

    found = per_file.select("file", F.explode(F.aggregate("s", start, follow)["out"]).alias("x"))
    return found.select("file", "x.block", "x.inside", "x.owner", F.col("x.record").alias("owner_record"), "x.opens", "x.odd")


def _records(lines: DataFrame, splits: DataFrame, number: int | None = None, several_lines: bool = True) -> DataFrame:
    """(file, block, record, value): block and record number of its first line, and all its lines. Of all records, or those of one
    number in their split. Without `several_lines` every record is one line, and the lines are read once.

    Only what is left of records that no task saw in whole is shuffled.
    """
    if number is not None:  # record numbers rise, and lines of number 0 may go on with a record of another split: the rest is not read
        lines = lines.where((F.col("r0") <= number) | (F.col("r1") <= number) if several_lines else F.col("r0") <= number)
    own = lines.join(splits.drop("opens", "odd"), SPLIT)
    inside = F.col("inside") == 1
    own = own.select(
        "file", "block", "n", "value", "owner", "owner_record",
        F.when(inside, F.col("i1")).otherwise(F.col("i0")).alias("before"), F.when(inside, F.col("o1")).otherwise(F.col("o0")).alias("after"),
        F.when(inside, F.col("r1")).otherwise(F.col("r0")).alias("record"))
    own = own.where((F.col("before") == 1) | (F.trim("value") != "")).withColumns({
        "first": F.when(F.col("record") > 0, F.col("block")).otherwise(F.col("owner")),
        "record": F.when(F.col("record") > 0, F.col("record")).otherwise(F.col("owner_record"))})
    if number is not None:
        own = own.where(F.col("record") == number)
    single = own.where((F.col("before") == 0) & (F.col("after") == 0)).select("file", "block", "record", "value")
    if not several_lines:
        return single
    several = own.where((F.col("before") == 1) | (F.col("after") == 1)).select(
        "file", "first", "record", "block", "n", "value", "before", "after").mapInArrow(_together, PART)
    # Plain files, and most of the others, have no part that another task continues.
    parts = F.array_sort(F.collect_list(F.struct("block", "n", "value")))
    rest = several.where("NOT whole").groupBy("file", "first", "record").agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
    for more in (several.where("whole"), rest):
        single = single.unionByName(more.select("file", F.col("first").alias("block"), "record", "value"))
    return single


def _fields(record: Column, width: int, odd: bool = True) -> Column:
    """The fields of a record and END, as an array of `width` + 2; a record with more fields, or an open quote, has no END. If none is
    `odd`, the array is as long as the record asks for."""
    # Without quotes and control characters, commas are all there is to a record.
    plain = F.split(F.concat(record, F.lit(f",{END}")), ",", -1)
    if not odd:
        return plain
    layout = ", ".join(f"c{k} string" for k in range(width + 2))
    options = {"quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1", "maxColumns": str(width + 20_480)}
    parsed = F.from_csv(F.concat(record, F.lit(f",{END}")), layout, options)
    # As a lambda's argument the record is parsed once, not once for each field.
    quoted = F.get(F.transform(F.array(parsed), lambda row: F.array(*(row[f"c{k}"] for k in range(width + 2)))), 0)
    return F.when(record.rlike(ODD), quoted).otherwise(plain)


def read_csv(spark: SparkSession, path: str, aliases: dict[str, tuple[str, ...]] | None = None, **options) -> DataFrame:
    """The columns of `aliases` as strings, each from the first of its header names that a file has, and beside them `_file`, `_record` (the
    record), `_bad` (its number of fields is not the header's). Without aliases, all names that some header has.

    Header names are compared in lower case and trimmed. Fields are trimmed; empty ones are null.
    """
    lines = _lines(spark, path, **options)
    # One row a split: written, and sent to the lines where there are not too many, so that these stay where they are.
    splits = materialize(_splits(lines), "csv-splits")
    several_lines, odd = splits.agg(F.max(F.col("opens") == 1), F.max("odd")).first()
    # The first record of each file; it begins in the first split that has one, and is that split's first.
    heads = _records(lines, small(splits), 1, several_lines).groupBy("file").agg(F.min(F.struct("block", "record", "value")).alias("h")).select("file", "h.*")
    heads = materialize(heads.select("file", F.col("block").alias("at"), F.regexp_replace("value", "^﻿", "").alias("value")), "csv-heads")
    # Commas and quotes bound the number of a header's fields; one number reaches the driver.
    width = 1 + (heads.agg(F.max(F.regexp_count("value", F.lit(",")))).first()[0] or 0)
    heads = heads.withColumn("f", _fields(F.col("value"), width, odd))
    names = F.transform(F.slice("f", 1, F.array_position("f", END).cast("int") - 1), lambda x: F.lower(F.trim(x)))
    heads = heads.withColumn("names", names)
    if aliases is None:  # as many names as the layouts have
        every = heads.select(F.posexplode("names").alias("k", "name")).groupBy("name").agg(F.min("k").alias("k"))
        aliases = {r["name"]: (r["name"],) for r in every.orderBy("k", "name").collect()}

    def place(wanted: tuple[str, ...]) -> Column:
        found = [F.nullif(F.array_position("names", name), F.lit(0)) for name in wanted]
        return F.coalesce(*found).cast("int") if len(found) > 1 else found[0].cast("int")

    heads = heads.select("file", "at", F.size("names").alias("fields"), *(place(v).alias(f"p{k}") for k, v in enumerate(aliases.values())))
    known = materialize(splits.select(*SPLIT).join(heads, "file"), "csv-known")
    rows = _records(lines, small(splits), several_lines=several_lines).join(small(known), SPLIT).where(~((F.col("block") == F.col("at")) & (F.col("record") == 1)))
    # As a generator's output: a condition on fields is then not pushed below it, where each use of a field would parse the record again.
    rows = rows.withColumn("f", F.explode(F.array(_fields(F.col("value"), width, odd)))).withColumn("count", F.array_position("f", END).cast("int") - 1)

    def field(k: int) -> Column:
        value = F.trim(F.get("f", F.col(f"p{k}") - 1))
        return F.when((value != "") & (value != END), value)

    return rows.select(*(field(k).alias(c) for k, c in enumerate(aliases)), F.col("file").alias("_file"), F.col("value").alias("_record"),
                       (~F.col("count").eqNullSafe(F.col("fields"))).alias("_bad"))


def typed(rows: DataFrame, layout: str) -> DataFrame:
    """Rows of read_csv under the types of `layout`, with `_reason` where a record is malformed: its number of fields, or a field that
    its type cannot hold. What is tested does not depend on the columns that are used later."""
    columns = [c.strip().split(None, 1) for c in layout.split(",")]
    wrong = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull(), F.lit(c)) for c, kind in columns if kind.strip().lower() != "string"]
    reason = F.when(F.col("_bad"), F.lit("number of fields"))
    for test in wrong:
        reason = F.coalesce(reason, test)
    return rows.select(*(F.col(c).try_cast(kind).alias(c) for c, kind in columns), "_file", "_record", reason.alias("_reason"))
