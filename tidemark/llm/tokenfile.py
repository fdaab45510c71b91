"""Token ids as Arrow stream files with batches of fixed-size lists.

All ids of the documents, in the order of doc_id, form one line that is cut into sequences of LENGTH ids. A file is an
Arrow stream of record batches of BATCH sequences: `ids`, fixed-size lists of unsigned 16- or 32-bit integers, and `mask`,
fixed-size lists of booleans that are false where the last sequences of a file are padded. All batches of a file are of one
size, so sequence i is found by arithmetic and is a view of the mapped file. A second stream file beside it holds
(doc_id, start, n_tokens) of the documents in the file.

Documents are range-partitioned by doc_id; each range is one file, written under a temporary name and renamed, so a
repeated task replaces it by the same bytes. Only the number of ids of each file reaches the driver.

Words are encoded apart, which the tokenizer's own rules allow, and a bounded cache keeps their ids.

Defined cases: a null text is empty and gives the end id only; a null doc_id sorts first; rows that share a doc_id follow
each other by text; an empty table gives no file and no row; further columns are ignored.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import in_chunks, table
from tidemark.session import shared_folder

MODEL = "word_bpe_49k.json"
END_ID = 1
LENGTH = 1024
BATCH = 32
CACHED, TOGETHER = 800_000, 2_000
#: The tokenizer's pattern on lower-case ASCII.
ASCII_WORDS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9 \t\n\r\x0b\x0c]+")
#: A word between the words of one call, by whose id their ids are told apart.
MARK = b"\x01"


class Words:
    """Ids of texts as the tokenizers library gives them, with bounded caches.

    ASCII text is cut into words as the tokenizer's own pattern does; other text is cut at ASCII white space only.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        (self.mark,) = self._encode(MARK)
        suffix = self.tokenizer.model.end_of_word_suffix
        self.last = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.cache: dict[bytes, bytes] = {}

    def _encode(self, text: bytes) -> list[int]:
        return self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids

    def learn(self, words: list[bytes]) -> None:
        for w in (w for w in words if MARK in w):
            self.cache[w] = np.array(self._encode(w), dtype=self.kind).tobytes()
        # A plain word is one word to the tokenizer, whose last id says so; between others stands the mark.
        alone = [w for w in words if w.isascii() and len(ASCII_WORDS.findall(w)) == 1 and MARK not in w and w == w.lower()]
        taken = set(alone)
        self._learn(alone, b" ", lambda ids: np.flatnonzero(self.last[ids]) + 1, 0)
        self._learn([w for w in words if w not in taken and MARK not in w], b" " + MARK + b" ",
                    lambda ids: np.append(np.flatnonzero(ids == self.mark), len(ids)), 1)

    def _learn(self, words: list[bytes], between: bytes, ends_of, skip: int) -> None:
        size = self.kind.itemsize
        for a in range(0, len(words), TOGETHER):
            some = words[a:a + TOGETHER]
            ids = np.array(self._encode(between.join(some)), dtype=self.kind)
            ends, data = ends_of(ids).tolist(), ids.tobytes()
            for w, start, end in zip(some, [0, *(e + skip for e in ends[:-1])], ends, strict=True):
                self.cache[w] = data[start * size:end * size]

    def _cut(self, text: str | None) -> list[bytes]:
        if not text:
            return []
        data = text.encode()
        if data.isascii() and not any(s in data for s in self.special):
            return ASCII_WORDS.findall(data.lower())
        return data.split()

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian ids of each text with the end id."""
        split = [self._cut(t) for t in texts]
        cache = self.cache
        unknown = [w for w in set().union(*split) if w not in cache]
        if unknown:
            if len(cache) + len(unknown) > CACHED:
                cache.clear()
                unknown = list(set().union(*split))
            self.learn(unknown)
        end = self.kind.type(END_ID).tobytes()
        return [b"".join([*map(cache.__getitem__, own), end]) for own in split]


@lru_cache(maxsize=1)
def words(path: str) -> Words:
    return Words(path)


class Writer:
    """Writes ids one after another into a file; padded to whole batches at the end."""

    def __init__(self, sink, kind: np.dtype, length: int = LENGTH, batch: int = BATCH):
        self.kind, self.length, self.batch = kind, length, batch
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.out, self.held, self.size, self.total = pa.ipc.new_stream(sink, self.schema), [], 0, 0

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.size += len(ids)
        self.total += len(ids) // self.kind.itemsize
        if self.size >= (full := self.length * self.batch * self.kind.itemsize):
            data = b"".join(self.held)
            whole = len(data) // full * full
            for a in range(0, whole, full):
                self._put(np.frombuffer(data, dtype=self.kind, count=self.length * self.batch, offset=a), self.length * self.batch)
            self.held, self.size = [data[whole:]], len(data) - whole

    def _put(self, ids: np.ndarray, real: int) -> None:
        cells = self.length * self.batch
        mask = pa.array(np.arange(cells) < real)
        self.out.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length), pa.FixedSizeListArray.from_arrays(mask, self.length)],
            schema=self.schema))

    def close(self) -> None:
        if self.size:
            rest = np.frombuffer(b"".join(self.held), dtype=self.kind)
            cells = np.zeros(self.length * self.batch, dtype=self.kind)
            cells[:len(rest)] = rest
            self._put(cells, len(rest))
        self.out.close()


class Reader:
    """Random access to a file of Writer, by views of its bytes."""

    def __init__(self, data: pa.Buffer):
        self.data = data
        stream = pa.BufferReader(data)
        self.schema = pa.ipc.read_schema(stream)
        self.start = stream.tell()
        self.length = self.schema.field("ids").type.list_size
        first = pa.ipc.read_message(stream)
        self.stride = stream.tell() - self.start
        self.batch = pa.ipc.read_record_batch(first, self.schema).num_rows
        self.batches = (data.size - self.start) // self.stride  # the end mark is shorter than a batch

    def _batch(self, k: int) -> pa.RecordBatch:
        message = pa.ipc.read_message(pa.BufferReader(self.data.slice(self.start + k * self.stride, self.stride)))
        return pa.ipc.read_record_batch(message, self.schema)

    def __len__(self) -> int:
        return self.batches * self.batch

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view) and mask of sequence i."""
        batch, row = self._batch(i // self.batch), i % self.batch
        return batch.column("ids")[row].values.to_numpy(), batch.column("mask")[row].values.to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int) -> np.ndarray:
        """n ids from place `start` of the file."""
        cells, out = self.length * self.batch, []
        while n:
            k, at = divmod(start, cells)
            own = self._batch(k).column("ids").values.to_numpy()[at:at + n]
            out.append(own)
            start, n = start + len(own), n - len(own)
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.zeros(0, dtype=np.uint16)


def write(docs: DataFrame, path: str, folder: str) -> list[tuple[int, int]]:
    """Writes the files of docs(doc_id, text) into a folder all executors share; (file, ids) of each, in order."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    data = docs.select("doc_id", docs["text"].alias("_text")).repartitionByRange(parts, "doc_id").sortWithinPartitions(
        "doc_id", "_text").withColumn("_part", F.spark_partition_id())
    kind = pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, fs, base = words(path), *pyarrow.fs.FileSystem.from_uri(folder)
        writer = index = None
        for batch in in_chunks(batches, "_text"):
            if writer is None:
                part = batch.column("_part")[0].as_py()
                name, mark = f"{base}/part-{part:06d}", f".{uuid.uuid4().hex}"
                fs.create_dir(base)
                sink, side = fs.open_output_stream(name + mark), fs.open_output_stream(name + mark + "-docs")
                writer = Writer(sink, own.kind)
                index = pa.ipc.new_stream(side, pa.schema([("doc_id", kind), ("start", pa.int64()), ("n_tokens", pa.int64())]))
            starts, sizes = [], []
            for ids in own.ids(batch.column("_text").to_pylist()):
                starts.append(writer.total)
                writer.add(ids)
                sizes.append(writer.total - starts[-1])
            index.write_batch(pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(kind), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], ["doc_id", "start", "n_tokens"]))
        if writer is None:
            return
        for stream, out in ((writer, sink), (index, side)):
            stream.close()
            out.close()
        fs.move(name + mark + "-docs", name + ".docs.arrows")
        fs.move(name + mark, name + ".ids.arrows")
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([writer.total], pa.int64())], ["part", "n"])

    return sorted(tuple(r) for r in data.mapInArrow(run, "part int, n long").collect())


def read(spark: SparkSession, folder: str, files: list[tuple[int, int]]) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files; starts count over all files."""
    before: dict[int, int] = {}
    total = 0
    for part, n in files:
        before[part] = total
        total += n
    order = sorted(before)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)

        def data(name: str) -> pa.Buffer:
            if isinstance(fs, pyarrow.fs.LocalFileSystem):
                return pa.memory_map(name).read_buffer()
            with fs.open_input_file(name) as file:
                return file.read_buffer()

        for frame in frames:
            for k in frame["id"]:
                part = order[k]
                ids = Reader(data(f"{base}/part-{part:06d}.ids.arrows"))
                for batch in pa.ipc.open_stream(data(f"{base}/part-{part:06d}.docs.arrows")):
                    own = batch.to_pandas(integer_object_nulls=True)
                    own["ids_crc32"] = [zlib.crc32(ids.ids(s, n).astype("<u4").tobytes()) for s, n in zip(own["start"], own["n_tokens"])]
                    own["start"] += before[part]
                    yield own

    return spark.range(0, len(order), 1, max(1, len(order))).mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    files = write(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL), folder)
    return read(spark, folder, files)
