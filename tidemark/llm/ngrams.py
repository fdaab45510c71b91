"""N-gram Jaccard join by a blocked sparse product of the document by n-gram incidence matrix.

A document's row holds its distinct word n-grams as 64-bit hashes; documents with equal rows form one class and are joined
once. The columns are dealt into blocks; the product over a block brings together the rows that share a column. Size bounds
discard most of the matrix before it is built: of n columns only the first n - ceil(0.75 n) + 1 in a common order can be the
first one shared with a similar row, sizes must differ by less than a quarter, and what is left after a shared column must
reach the needed overlap. The order puts columns that are frequent somewhere last; their frequency is a sketch of fixed size,
and whatever it says, the bounds hold. Overlaps of the pairs that remain are counted on whole rows.

Groups of near copies are not paired off. First every row meets two classes only: of the smallest classes of its columns the
smallest, and the one with which it shares most columns; most groups are connected by that. Then components are known, and only columns
whose rows lie in several of them count: the rows around a smallest class are compared with each other, in pieces of bounded size,
so no group is paired off. A first comparison by sketches names the rows that may link to another component; whole rows of these few
are then brought into the pieces, where pairs are verified and a union-find passes over what is connected already. So a piece gives
fewer links than it has rows. At last rows of different pieces are compared in the same way. So every link that matters for the
components is found, without all pairs inside a group.

Rows are compared by sketches: the parity of a row's hashes in each of about 4n buckets. Two rows differ in at least as many
columns as their sketches differ in bits, which bounds the overlap from above.

A column that the frequency sketch calls long is split into pieces by class, and each piece is given the column's smallest class,
which a pass of its own finds; so no task holds a whole long column.

Components come from alternating star contractions, each round written to the shared folder.

Defined cases: a null text, or one without a word, has an empty row and is its own component; fewer than n words form one
n-gram; a null doc_id is kept, and counts as the smallest id only of a component of nothing but nulls; rows that repeat are
one class; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import forget, in_chunks, table
from tidemark.operators.align import BROADCAST_ROWS
from tidemark.session import materialize

N = 5
#: Similarity as a fraction: 100 * overlap >= 75 * union.
PART, WHOLE = 75, 100
#: Bytes of text hashed at once, n-grams counted at once, rows of a column block, buckets of the two fixed-size sketches.
HASH_BYTES, COUNTED, BLOCK_ROWS, SKETCH, MARKS = 1 << 20, 1 << 21, 500_000, 1 << 20, 1 << 20
#: Parts in which a sketch comes to the driver, each as bytes.
PARTS = 256
#: Classes that a task remembers, lest it passes a row on again and again.
SEEN = 1 << 17
#: How often an n-gram must come in one step of a task to be counted as frequent.
OFTEN = 3
#: Rows of a column up to which every two of them are held against the bounds before any of them counts.
ASSUMED_OPEN = 512
#: Rows from which a column is split into pieces, by the sketch of frequent buckets.
LONG_ROWS = 1 << 17
#: Least and most bits of a row's sketch; bytes and rows in a piece of those around one class; parts in which the rows
#: around one class meet their number of pieces.
LEAST_BITS, MOST_BITS, PIECE_BYTES, PIECE_ROWS, SALTS = 256, 1 << 17, 8 << 20, 4_096, 16

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BASE, JOIN = 0x9E3779B97F4A7C15, np.uint64(0xD1342543DE82EF95)
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Rows of the incidence matrix: sorted distinct n-gram hashes of texts."""

    def __init__(self, n: int = N):
        self.n = n
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def rows(self, texts: list[str | None]) -> list[np.ndarray]:
        parts = [t.encode("utf-8", "replace").translate(LOWER) if t else b"" for t in texts]
        data = np.frombuffer(b"\n".join([*parts, b""]), dtype=np.uint8)
        starts = np.cumsum([0, *(len(p) + 1 for p in parts)])
        if len(self.up) < len(data) + 1:
            self.up, self.down = powers(BASE, len(data) + 1), powers(BASE_INVERSE, len(data) + 1)
        space = IS_SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
        first, last = edge[0::2], edge[1::2]
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(BYTE[data] * self.up[:len(data)])])
        words = mixed((total[last] - total[first]) * self.down[first])
        own = np.searchsorted(first, starts)  # first word of each text
        grams = np.zeros(max(0, len(words) - self.n + 1), dtype=np.uint64)
        for k in range(self.n):
            grams = grams * JOIN + words[k:k + len(grams)]
        grams = mixed(grams)
        out = []
        for a, b in zip(own[:-1].tolist(), own[1:].tolist()):
            if b - a >= self.n:
                out.append(np.unique(grams[a:b - self.n + 1]))
            elif b > a:
                short = b - a  # all words as one n-gram
                for w in words[a:b].tolist():
                    short = (short * int(JOIN) + w) % (1 << 64)
                out.append(mixed(np.array([short], dtype=np.uint64)))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
        return out


def class_of(row: np.ndarray) -> int:
    """One number for equal rows."""
    if not len(row):
        return 0
    value = mixed(np.array([np.add.reduce(mixed(row + np.uint64(0x51ED270B))) + np.uint64(len(row))], dtype=np.uint64))
    return int(value.view(np.int64)[0])


def similar(overlap, a, b):
    """Whether sets of sizes a and b with this overlap are linked."""
    return WHOLE * overlap >= PART * (a + b - overlap)


def first_part(n: int) -> int:
    return n - -(-PART * n // WHOLE) + 1


def _array(rows: DataFrame, size: int, values: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """`size` bytes: values(n) at the places of rows (at, n) and 0 elsewhere; a place comes once at most. They reach the driver as
    PARTS rows of bytes, however many places there are."""
    width = size // PARTS

    def packed_part(frame: pd.DataFrame) -> pd.DataFrame:
        part = np.zeros(width, dtype=np.uint8)
        part[frame["at"].to_numpy() % width] = values(frame["n"].to_numpy())
        return pd.DataFrame({"part": frame["part"].iloc[:1], "data": [part.tobytes()]})

    parts = rows.select((F.col("at") / width).cast("int").alias("part"), "at", "n").groupBy("part").applyInPandas(packed_part, "part int, data binary")
    out = np.zeros((PARTS, width), dtype=np.uint8)
    for part, data in parts.collect():
        out[part] = np.frombuffer(data, dtype=np.uint8)
    return out.ravel()


def _hash_pass(docs: DataFrame) -> DataFrame:
    """(doc_id, n, cid) of every row, and with kind 1 the frequent buckets of each step: (cid: bucket, n: count)."""
    data = docs.select("doc_id", docs["text"].alias("_text"))
    kind = data.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        hasher, held, size, seen = Hasher(), [], 0, set()

        def frequent() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= OFTEN
            buckets = (values[often] % np.uint64(SKETCH)).astype(np.int64)
            return rows([None] * len(buckets), counts[often], buckets, 1)

        def rows(ids, n, cids, what: int) -> pa.RecordBatch:
            ids = pa.nulls(len(n), id_type) if what else ids
            return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(cids, pa.int64()), pa.array(np.full(len(n), what), pa.int32())],
                                              ["doc_id", "n", "cid", "kind"])

        for batch in in_chunks(batches, "_text", HASH_BYTES):
            id_type = batch.column("doc_id").type
            own = hasher.rows(batch.column("_text").to_pylist())
            cids = [class_of(r) for r in own]
            yield rows(batch.column("doc_id"), [len(r) for r in own], cids, 0)
            for r, c in zip(own, cids):
                if len(r) and c not in seen:
                    seen.add(c)
                    held.append(r)
                    size += len(r)
            if size >= COUNTED:
                yield frequent()
                held, size = [], 0
                seen.clear()
        if held:
            yield frequent()

    return data.mapInArrow(run, f"doc_id {kind.simpleString()}, n long, cid long, kind int")


def _pieces(key: np.ndarray, level: np.ndarray, long_rows: int) -> np.ndarray:
    """Pieces of each column, 0 for one that is not long. A level stands for less than twice its power of two."""
    over = level[(key % np.uint64(SKETCH)).astype(np.int64)].astype(np.int64) - (long_rows.bit_length() - 1)
    return np.where(over >= 0, np.int64(2) << np.maximum(over, 0), 0)


def _first(cid: int, row: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, ...]:
    """The first part of a row as (key, cid, n, left)."""
    n = len(row)
    part = first_part(n)
    own = level[(row % np.uint64(SKETCH)).astype(np.int64)]
    key = row[np.lexsort((row, own))[:part]]
    return key, np.full(part, cid, dtype=np.int64), np.full(part, n, dtype=np.int32), np.arange(n, n - part, -1, dtype=np.int32)


def _batch(key: np.ndarray, cid: np.ndarray, n: np.ndarray, left: np.ndarray, piece: np.ndarray, blocks: int, *more: np.ndarray) -> pa.RecordBatch:
    """Postings by block and piece; piece -1 is all of the block's columns that are not long."""
    block = (mixed(key) % np.uint64(blocks)).astype(np.int64)
    order = np.lexsort((piece, block))
    block, piece = block[order].astype(np.int32), piece[order].astype(np.int32)
    bounds = np.flatnonzero(np.diff(block, prepend=-1) | np.diff(piece, prepend=-2))
    ends = [*bounds[1:].tolist(), len(block)]
    cut = lambda x: [x[order][a:b].tobytes() for a, b in zip(bounds.tolist(), ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(block[bounds]), pa.array(piece[bounds]), *(pa.array(cut(x), pa.binary()) for x in (key, cid, n, left, *more))],
        ["block", "piece", "key", "cid", "n", "left", "comp"][:6 + len(more)])


def _dealt(firsts: Iterator[tuple[np.ndarray, ...]], level: np.ndarray, blocks: int, long_rows: int) -> Iterator[pa.RecordBatch]:
    """First parts of rows (key, cid, n, left, ...), dealt by column into blocks, and of long columns by class into pieces."""
    held, size = [], 0

    def out() -> pa.RecordBatch:
        key, cid, n, left, *more = (np.concatenate(x) for x in zip(*held))
        pieces = _pieces(key, level, long_rows)
        dealt = (mixed(cid.view(np.uint64)) % np.maximum(pieces, 1).astype(np.uint64)).astype(np.int64)
        return _batch(key, cid, n, left, np.where(pieces > 0, dealt, -1), blocks, *more)

    for first in firsts:
        held.append(first)
        size += len(first[0])
        if size >= 1 << 20:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def _postings(rows: Iterator[tuple[int, np.ndarray]], level: np.ndarray, blocks: int, long_rows: int) -> Iterator[pa.RecordBatch]:
    return _dealt((_first(cid, row, level) for cid, row in rows), level, blocks, long_rows)


def _kept_firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, cid, n, left, comp) of stored first parts (cid, n, first, comp)."""
    for batch in batches:
        for cid, n, first, comp in zip(*(batch.column(c).to_pylist() for c in ("cid", "n", "first", "comp"))):
            key = np.frombuffer(first, dtype=np.uint64)
            yield (key, np.full(len(key), cid, dtype=np.int64), np.full(len(key), n, dtype=np.int32),
                   np.arange(n, n - len(key), -1, dtype=np.int32), np.full(len(key), comp, dtype=np.int64))


def _doubt_postings(batches: Iterator[pa.RecordBatch], level: np.ndarray, blocks: int, long_rows: int) -> Iterator[pa.RecordBatch]:
    return _dealt(_kept_firsts(batches), level, blocks, long_rows)


def _doubt_ends(batches: Iterator[pa.RecordBatch], level: np.ndarray, long_rows: int) -> Iterator[pa.RecordBatch]:
    """Postings of long columns that have the smallest class or the smallest or largest component among some rows."""
    held, size = [], 0

    def out() -> pa.RecordBatch:
        columns = [np.concatenate(x) for x in zip(*held)]
        key, cid, comp = columns[0], columns[1], columns[4]
        ends = []
        for order in (np.lexsort((cid, key)), np.lexsort((comp, key)), np.lexsort((-comp, key))):
            ends.append(order[np.diff(key[order], prepend=~key[order][:1]) != 0])
        at = np.unique(np.concatenate(ends))
        return pa.RecordBatch.from_arrays([pa.array(x[at]) for x in (key.view(np.int64), *columns[1:])], ["key", "cid", "n", "left", "comp"])

    for first in _kept_firsts(batches):
        of_long = _pieces(first[0], level, long_rows) > 0
        if of_long.any():
            held.append(tuple(x[of_long] for x in first))
            size += len(held[-1][0])
        if size >= 1 << 20:
            yield out()
            held, size = [], 0
    if held:
        yield out()


POSTING = "block int, piece int, key binary, cid binary, n binary, left binary"
DOUBT_POSTING = POSTING + ", comp binary"


def _smallest(rows: Iterator[tuple[int, np.ndarray]], level: np.ndarray, long_rows: int) -> Iterator[pa.RecordBatch]:
    """The smallest class of each long column among some rows, several times if there are many."""
    held, size = [], 0

    def out() -> pa.RecordBatch:
        key, cid, n, left = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((cid, key))
        order = order[np.diff(key[order], prepend=~key[order][:1]) != 0]
        return pa.RecordBatch.from_arrays([pa.array(x[order]) for x in (key.view(np.int64), cid, n, left)], ["key", "cid", "n", "left"])

    for cid, row in rows:
        first = _first(cid, row, level)
        of_long = _pieces(first[0], level, long_rows) > 0
        if of_long.any():
            held.append(tuple(x[of_long] for x in first))
            size += len(held[-1][0])
        if size >= 1 << 20:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def _to_pieces(batches: Iterator[pa.RecordBatch], level: np.ndarray, blocks: int, long_rows: int) -> Iterator[pa.RecordBatch]:
    """The smallest classes of long columns as postings of each of their pieces."""
    for batch in batches:
        for part in (batch.slice(at, 4_096) for at in range(0, len(batch), 4_096)):
            key, cid, n, left, *more = (part.column(c).to_numpy() for c in part.schema.names)
            pieces = _pieces(key.view(np.uint64), level, long_rows)
            starts = np.cumsum(pieces) - pieces
            piece = np.arange(pieces.sum()) - starts.repeat(pieces)
            yield _batch(*(x.repeat(pieces) for x in (key.view(np.uint64), cid, n, left)), piece, blocks, *(x.repeat(pieces) for x in more))


def _columns(frame: pd.DataFrame, *more: tuple[str, str]) -> tuple[np.ndarray, ...]:
    """(key, cid, n, left, ...) of the postings of a group, each once, by key and class."""
    kinds = (("key", "<u8"), ("cid", "<i8"), ("n", "<i4"), ("left", "<i4"), *more)
    key, cid, *rest = (np.frombuffer(b"".join(frame[c]), dtype=t) for c, t in kinds)
    order = np.lexsort((cid, key))
    key, cid = key[order], cid[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (cid[1:] != cid[:-1])
    return (key[new], cid[new], *(x[order][new].astype(np.int64) for x in rest))


def _pairs(frame: pd.DataFrame) -> pd.DataFrame:
    """Pairs of classes (a, b) that share columns of this block of which a is the smallest class; ok: in how many of them the
    bounds allow a link, many: whether in one of them they allow one of b with another class than a."""
    key, cid, n, left = _columns(frame)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    count = np.diff(np.append(first, len(key)))
    split = len(frame) > 0 and int(frame["piece"].iloc[0]) >= 0
    a, b = np.repeat(first, count), np.arange(len(key))
    allowed = lambda a, b: similar(np.minimum(left[a], left[b]), n[a], n[b])
    ok, many = allowed(a, b), (count.repeat(count) > ASSUMED_OPEN) | split
    for f, c in zip(first.tolist(), count.tolist()):
        if 2 < c <= ASSUMED_OPEN and not split:
            own = np.arange(f + 1, f + c)
            both = allowed(own[:, None], own[None, :])
            np.fill_diagonal(both, False)
            many[own] = both.any(axis=1)
    keep = (a != b) & (ok | many)
    a, b, ok, many = a[keep], b[keep], ok[keep], many[keep]
    pairs = pd.DataFrame({"a": cid[a], "b": cid[b], "ok": ok.astype(np.int32), "many": many.astype(np.int32)})
    return pairs.groupby(["a", "b"], as_index=False).agg({"ok": "sum", "many": "max"})


def _in_doubt(frame: pd.DataFrame) -> pd.DataFrame:
    """(a, cid) of the columns of this block whose rows lie in several components: their smallest class, and each row with
    one of another component and a size that may link. A piece of long columns is given rows of two components, if the whole column has
    them, and all its rows are taken."""
    key, cid, n, left, comp = _columns(frame, ("comp", "<i8"))
    if not len(key):
        return pd.DataFrame({"a": cid, "cid": cid})
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.append(first, len(key)))
    column = np.repeat(np.arange(len(first)), count)
    several = (np.minimum.reduceat(comp, first) != np.maximum.reduceat(comp, first))[column]
    keep = np.flatnonzero(several)
    a = cid[first][column]
    if int(frame["piece"].iloc[0]) < 0:
        keep = keep[np.lexsort((n[keep], column[keep]))]
        own, size = column[keep] << 32, n[keep]
        changes = np.cumsum(np.concatenate([[0], (comp[keep][1:] != comp[keep][:-1]) | (own[1:] != own[:-1])])) if len(keep) else own
        low = np.searchsorted(own + size, own - (-PART * size // WHOLE))
        high = np.searchsorted(own + size, own + WHOLE * size // PART, side="right") - 1
        keep = keep[changes[high] > changes[low]]
        # Short columns are held against all bounds.
        own = np.sort(keep)
        edges = np.append(np.flatnonzero(np.diff(column[own], prepend=-1)), len(own)).tolist()
        kept = np.ones(len(own), dtype=bool)
        for f, t in zip(edges[:-1], edges[1:]):
            if t - f <= ASSUMED_OPEN:
                x, y = own[f:t, None], own[None, f:t]
                kept[f:t] = (similar(np.minimum(left[x], left[y]), n[x], n[y]) & (comp[x] != comp[y])).any(axis=1)
        keep = own[kept]
    return pd.DataFrame({"a": a[keep], "cid": cid[keep]}).drop_duplicates()


def sketch_of(row: np.ndarray) -> bytes:
    """Parities of the row's hashes in a number of buckets that is a power of two."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (4 * len(row) - 1).bit_length()))
    odd = np.bincount((row % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(x: np.ndarray) -> np.ndarray:
    """Sketches of half as many buckets."""
    return x[..., :x.shape[-1] // 2] ^ x[..., x.shape[-1] // 2:]


def may_link(x: np.ndarray, y: np.ndarray, a, b):
    """Whether sketches x and y of sets of sizes a and b, of one length or twice it, leave a link possible."""
    while x.shape[-1] > y.shape[-1]:
        x = folded(x)
    while y.shape[-1] > x.shape[-1]:
        y = folded(y)
    differ = np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)
    return similar((a + b - differ) // 2, a, b) & similar(np.minimum(a, b), a, b)


def _comparisons(frame: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(r, to, differ): for each row of a group, sorted by (at, n, cid), the later rows around the same class `at` whose size and sketch allow
    a link, whose component differs and, of two different pieces, whose piece does; and by how many bits their sketches differ."""
    i, j = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
    around, comp, n, piece = (frame[c].to_numpy().astype(np.int64) for c in ("at", "comp", "n", "piece"))
    sketch = frame["sketch"].tolist()
    width = np.array([len(x) // 8 for x in sketch])
    # Runs of one class and one width; the rows of twice the width follow them, since sizes that may link differ by less.
    edges = np.append(np.flatnonzero(np.diff(around, prepend=~around[:1]) | np.diff(width, prepend=~width[:1])), len(around)).tolist()
    for at, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        w, end = int(width[a]), b
        x = np.frombuffer(b"".join(sketch[a:b]), dtype="<u8").reshape(-1, w)
        if b < len(around) and around[b] == around[a] and width[b] == 2 * w:
            end = edges[at + 2]
            x = np.vstack([x, folded(np.frombuffer(b"".join(sketch[b:end]), dtype="<u8").reshape(-1, 2 * w))])
        last = np.searchsorted(n[a:end], n[a:b] * WHOLE // PART, side="right").tolist()
        for r in range(a, b):
            to = np.arange(r + 1, max(r + 1, a + last[r - a]))
            keep = comp[to] != comp[r]
            if i != j:
                keep &= piece[to] != piece[r]
            to = to[keep]
            if len(to):
                differ = np.bitwise_count(x[to - a] ^ x[r - a]).sum(axis=-1, dtype=np.int64)
                may = similar((n[to] + n[r] - differ) // 2, n[to], n[r])
                if may.any():
                    yield r, to[may], differ[may]


def _near(frame: pd.DataFrame) -> pd.DataFrame:
    """(at, cid) of the rows that the sketches leave a possible link to another component."""
    frame = frame.sort_values(["at", "n", "cid"])
    near = np.zeros(len(frame), dtype=bool)
    for r, to, _ in _comparisons(frame):
        near[r] = near[to] = True
    return frame.loc[near, ["at", "cid"]]


def _around(frame: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) that connect the components of the rows around one class, as a forest; each is verified on whole rows."""
    frame = frame.sort_values(["at", "n", "cid"])
    cid, n, rows = frame["cid"].to_numpy(), frame["n"].to_numpy(), frame["row"].tolist()
    # Components by class `at`; joined ones get one number.
    _, joined = np.unique(frame[["at", "comp"]].to_numpy(), axis=0, return_inverse=True)
    joined, found = joined.ravel(), []
    for r, to, differ in _comparisons(frame):
        own = None
        for s in to[np.argsort(differ, kind="stable")].tolist():
            if joined[s] == joined[r]:
                continue
            own = unpacked(rows[r]) if own is None else own
            if similar(len(np.intersect1d(own, unpacked(rows[s]), assume_unique=True)), n[r], n[s]):
                found.append((int(cid[r]), int(cid[s])))
                joined[joined == joined[s]] = joined[r]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def packed(row: np.ndarray) -> bytes:
    """The low 48 bits of each hash."""
    return row.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(data: bytes | pa.Buffer) -> np.ndarray:
    part = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    out = np.zeros((len(part), 8), dtype=np.uint8)
    out[:, :6] = part
    return out.view("<u8").ravel()


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole rows are similar."""
    left = pairs.select("a", "b").join(sets.select(F.col("cid").alias("a"), F.col("row").alias("_ra")), "a")
    both = left.join(sets.select(F.col("cid").alias("b"), F.col("row").alias("_rb")), "b").select("a", "b", "_ra", "_rb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("_ra"), batch.column("_rb")):
                x, y = unpacked(x.as_buffer()), unpacked(y.as_buffer())
                keep.append(similar(len(np.intersect1d(x, y)), len(x), len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _possible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) that the sketches leave possible."""
    left = pairs.select("a", "b").join(sketches.select(F.col("cid").alias("a"), F.col("n").alias("_na"), F.col("sketch").alias("_sa")), "a")
    both = left.join(sketches.select(F.col("cid").alias("b"), F.col("n").alias("_nb"), F.col("sketch").alias("_sb")), "b").select(
        "a", "b", "_na", "_nb", "_sa", "_sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [bool(may_link(np.frombuffer(x.as_buffer(), dtype="<u8"), np.frombuffer(y.as_buffer(), dtype="<u8"), a, b)) for x, y, a, b in zip(
                batch.column("_sa"), batch.column("_sb"), batch.column("_na").to_pylist(), batch.column("_nb").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(cid, comp): the smallest class that links (a, b) reach, for every class that has one. Alternating large and small
    stars; each round is written, so its lineage is short."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, before = materialize(edges, "ngram-edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("x"), "m", "u")
        small = small.select(F.col("x").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").distinct(), "ngram-edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("cid"), F.col("v").alias("comp")).unionByName(
        edges.select(F.col("v").alias("cid"), F.col("v").alias("comp")).distinct())


def join(docs: DataFrame, long_rows: int = LONG_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs(doc_id, text)."""
    spark = docs.sparkSession
    hashed = materialize(_hash_pass(docs), "ngram-rows")
    members = hashed.where("kind = 0").drop("kind")
    often = hashed.where("kind = 1").groupBy(F.col("cid").alias("at")).agg(F.sum("n").alias("n"))  # at most SKETCH rows
    level = _array(often, SKETCH, lambda n: np.log2(n.astype(np.float64)).astype(np.uint8))
    classes = members.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("low"), F.first("n").alias("n"))
    total = classes.agg(F.sum("n")).first()[0] or 0
    blocks = max(8, total // 4 // BLOCK_ROWS)
    sketch = spark.sparkContext.broadcast(level)  # SKETCH bytes

    text = docs.select(docs["text"].alias("_text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        hasher, seen = Hasher(), set()
        for batch in in_chunks(batches, "_text", HASH_BYTES):
            for row in hasher.rows(batch.column("_text").to_pylist()):
                cid = class_of(row)
                if len(row) and cid not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(cid)
                    yield cid, row

    postings = text.mapInArrow(lambda batches: _postings(rows(batches), sketch.value, blocks, long_rows), POSTING)
    long_columns = bool((level >= long_rows.bit_length() - 1).any())
    if long_columns:
        least = text.mapInArrow(lambda batches: _smallest(rows(batches), sketch.value, long_rows), "key long, cid long, n int, left int")
        least = least.groupBy("key").agg(F.min(F.struct("cid", "n", "left")).alias("c")).select("key", "c.*")
        postings = postings.unionByName(least.mapInArrow(lambda batches: _to_pieces(batches, sketch.value, blocks, long_rows), POSTING))

    stars = postings.groupBy("block", "piece").applyInPandas(_pairs, "a long, b long, ok int, many int")
    stars = materialize(stars.groupBy("a", "b").agg(F.sum("ok").alias("ok"), F.max("many").alias("many")), "ngram-stars")

    def of_classes(pairs: DataFrame, name: str, values: dict[str, Callable[[int, np.ndarray], bytes]]) -> DataFrame:
        """(cid, n, values of the row) of the classes in pairs; a bitmap of fixed size spares most others."""
        both = pairs.select(F.col("a").alias("cid")).union(pairs.select("b"))
        places = both.select(F.pmod("cid", F.lit(MARKS)).alias("at")).distinct().withColumn("n", F.lit(1))
        marked = spark.sparkContext.broadcast(_array(places, MARKS, lambda n: n).astype(bool))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget()
            hasher, seen, wanted = Hasher(), set(), marked.value
            for batch in in_chunks(batches, "_text", HASH_BYTES):
                own = []
                for row in hasher.rows(batch.column("_text").to_pylist()):
                    cid = class_of(row)
                    if len(row) and cid not in seen and wanted[cid % MARKS]:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(cid)
                        own.append((cid, len(row), *(f(cid, row) for f in values.values())))
                kinds = (pa.int64(), pa.int64(), *(pa.binary() for _ in values))
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in own], t) for k, t in enumerate(kinds)], ["cid", "n", *values])

        found = text.mapInArrow(run, ", ".join(["cid long, n long", *(f"{k} binary" for k in values)])).groupBy("cid").agg(
            F.first("n").alias("n"), *(F.first(k).alias(k) for k in values))
        return materialize(found, name)

    def sets_of(pairs: DataFrame) -> DataFrame:
        return of_classes(pairs, "ngram-sets", {"row": lambda _, row: packed(row)})

    # Each class with two others first; most groups are connected by that.
    kept = of_classes(stars, "ngram-sketches", {
        "sketch": lambda _, row: sketch_of(row), "first": lambda cid, row: _first(cid, row, sketch.value)[0].tobytes()})
    best = stars.where("ok > 0").groupBy("b").agg(F.min("a").alias("_low"), F.max(F.struct("ok", "a")).alias("_most"))
    tried = best.select("b", F.explode(F.array_distinct(F.array("_low", "_most.a"))).alias("a")).select("a", "b")
    tried = materialize(_possible(tried, kept), "ngram-tried")
    links = materialize(_linked(tried, sets_of(tried)), "ngram-links")
    comps = materialize(components(links), "ngram-components")

    # Rows around the smallest class of columns that lie in several components yet.
    def placed_rows(*columns: str) -> DataFrame:
        return kept.select("cid", "n", *columns).join(comps, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))

    dealt = placed_rows("first").mapInArrow(lambda batches: _doubt_postings(batches, sketch.value, blocks, long_rows), DOUBT_POSTING)
    if long_columns:
        ends = placed_rows("first").mapInArrow(lambda batches: _doubt_ends(batches, sketch.value, long_rows), "key long, cid long, n int, left int, comp long")
        ends = ends.groupBy("key").agg(*(F.min(F.struct(*x, "cid", "n", "left", "comp")).alias(f"e{k}") for k, x in enumerate(
            ([], [F.col("comp").alias("o")], [(-F.col("comp")).alias("o")]))))
        ends = ends.select("key", F.explode(F.array(*(F.struct(*(F.col(f"e{k}.{c}").alias(c) for c in ("cid", "n", "left", "comp"))) for k in range(3)))).alias("e"))
        dealt = dealt.unionByName(ends.select("key", "e.*").mapInArrow(lambda batches: _to_pieces(batches, sketch.value, blocks, long_rows), DOUBT_POSTING))
    around = dealt.groupBy("block", "piece").applyInPandas(_in_doubt, "a long, cid long").distinct()
    around = materialize(around, "ngram-around")

    def in_pieces(rows: DataFrame, size: Column, across: bool | None, *more: DataFrame):
        """Rows (a, cid) around classes with several components yet, grouped by two pieces each: of one with itself, with others if
        `across`, with both if it is None. `more` brings further columns by class."""
        at = rows.join(placed_rows(size.alias("bytes")), "cid").select("a", "comp", "bytes")
        pieces = F.greatest(F.ceil(F.sum("bytes") / PIECE_BYTES), F.ceil(F.count("*") / PIECE_ROWS)).cast("int")
        doubt = at.groupBy("a").agg(pieces.alias("pieces"), F.min("comp").alias("_low"), F.max("comp").alias("_high"), F.count("*").alias("rows"))
        doubt = materialize(doubt.where("_low <> _high" + (" AND pieces > 1" if across else "")), "ngram-doubt")
        in_all, of_them = doubt.agg(F.sum("rows"), F.count("*")).first()
        if not in_all:
            return None
        # Small ones share a task's step; a bucket has about as many rows as a piece.
        buckets = max(8, in_all // PIECE_ROWS)
        if of_them <= BROADCAST_ROWS:
            own = rows.join(F.broadcast(doubt.select("a", "pieces")), "a")
        else:
            # Spark would judge these by the size of what is stored, and broadcast SALTS times that.
            salted = doubt.select("a", "pieces", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")).hint("merge")
            own = rows.withColumn("salt", F.pmod(F.xxhash64("cid"), F.lit(SALTS)).cast("int")).join(salted, ["a", "salt"]).drop("salt")
        own = own.join(placed_rows("sketch"), "cid").withColumn("piece", F.pmod(F.xxhash64("cid", F.lit("piece")), "pieces").cast("int"))
        for frame in more:
            own = own.join(frame, "cid")
        every = F.sequence(F.lit(0), F.col("pieces") - 1)
        other = F.array("piece") if across is False else every if across is None else F.filter(every, lambda k: k != F.col("piece"))
        own = own.withColumn("_other", F.explode(other)).withColumn("bucket", F.pmod(F.xxhash64("a"), F.lit(buckets)))
        own = own.withColumns({"i": F.least("piece", "_other"), "j": F.greatest("piece", "_other")}).withColumnRenamed("a", "at")
        return own.drop("_other", "pieces").groupBy("bucket", "i", "j")

    # Rows that may link to another component, by sketches; whole rows of these; links, within pieces and then between them.
    groups = in_pieces(around, F.octet_length("sketch"), None)
    if groups is not None:
        near = groups.applyInPandas(_near, "at long, cid long").distinct()
        near = materialize(near.select(F.col("at").alias("a"), "cid"), "ngram-near")
        whole = sets_of(near.select("a", F.col("cid").alias("b"))).select("cid", "row")
        for across in (False, True):
            groups = in_pieces(near, F.octet_length("sketch") + 6 * F.col("n"), across, whole)
            if groups is not None:
                links = links.unionByName(materialize(groups.applyInPandas(_around, "a long, b long").distinct(), "ngram-links"))
                comps = materialize(components(links), "ngram-components")

    placed = classes.join(comps, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    lowest = placed.groupBy("comp").agg(F.min("low").alias("component_id"))
    placed = materialize(placed.join(lowest, "comp").select("cid", "component_id"), "ngram-placed")
    return members.join(placed, "cid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
