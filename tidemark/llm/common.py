"""What several operators of this package share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: ASCII white space; a word is a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"
FOLDS = 5
#: Bytes of text that one step of a Python task holds at once.
CHUNK_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Fold 0 of crc32 over the id as text; rows without an id are never learned from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS == 0, F.lit(True))


def shape(fields: list[StructField], more: str) -> StructType:
    """These columns, then those of a list in SQL."""
    return StructType([*fields, *StructType.fromDDL(more).fields])


#: The one model that a Python worker keeps from task to task.
_RESIDENT: dict[Hashable, object] = {}


def resident(key: Hashable, make: Callable[[], object]):
    """The worker's model of this key. Workers outlive stages, so any other model is dropped before this one is made."""
    if key not in _RESIDENT:
        forget()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def forget() -> None:
    """Drops the worker's model and gives back what earlier tasks left."""
    _RESIDENT.clear()
    release()


def release() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()


def in_chunks(batches: Iterator[pa.RecordBatch], column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `most` bytes of one text column (one row at least)."""
    for batch in batches:
        start, held = 0, 0
        for i, n in enumerate(pa.compute.binary_length(batch.column(column)).to_pylist()):
            if held and held + (n or 0) > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)
