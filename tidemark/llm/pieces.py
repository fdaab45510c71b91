"""SentencePiece encoding and decoding with a BPE model, by a table over prefixes.

The pieces form an automaton. For each prefix of a word the table holds the last piece of the prefix's encoding, which is
unique: of the pieces that the automaton finds at that end, longest first, it is the one that may follow the last piece of
the prefix before it. Two pieces may follow each other if undoing their merges, latest first, never shows a pair that
would have been merged earlier. The ids are read backwards from the last prefix.

Words can be encoded apart where no piece holds both characters at a boundary. What words gave is kept in two halves of a number of
bytes: when one is full the other is dropped, but for the words that came again. All is dropped at the end of a task.
Characters without a piece become byte pieces. Runs of spaces, whose pieces all have one score,
take the longest pieces from the left, as the library does.

Defined cases: a null text is empty; an empty text has the end id only and decodes to an empty text; an empty table gives
an empty result; repeated rows and further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import in_chunks, release, resident, table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Letters, or anything else, each with the spaces before it.
UNITS = regex.compile(r" *[\p{L}\p{M}]+| *[^\p{L}\p{M} ]+| +")
WORDS = regex.compile(" *[^ ]+| +")
LETTER = regex.compile(r"[\p{L}\p{M}]")
#: About how many bytes the words that a task keeps take, the longest of them, and the pairs of pieces that it keeps.
CACHE_BYTES, CACHED_CHARS, PAIRS = 24 << 20, 48, 100_000


class Pieces:
    """One model: encode and decode as the sentencepiece library does, without sampling."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.end = model.eos_id()
        self.byte = {model.piece_to_id(f"<0x{b:02X}>"): b for b in range(256)}
        self.of_byte = {b: i for i, b in self.byte.items()}
        self.unknown = model.unk_id()
        self.control = {i for i in ids if model.is_control(i)}
        self.text = [model.id_to_piece(i) for i in ids]
        normal = [i for i in ids if i not in self.byte and i not in self.control and i != self.unknown]
        self.id = {self.text[i]: i for i in normal}
        self.runs = {len(self.text[i]): i for i in normal if not self.text[i].strip(SPACE)}
        merged = sorted((i for i in normal if len(self.text[i]) > 1 and self.text[i].strip(SPACE)), key=model.get_score, reverse=True)
        if len({model.get_score(i) for i in merged}) < len(merged) or any(SPACE in self.text[i][1:] for i in merged):
            raise ValueError("pieces with equal scores or with a space inside are not supported")
        self.rank = [-1] * len(self.text)  # single characters come before all merges
        for n, i in enumerate(merged):
            self.rank[i] = n
        self.pair: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.follows: dict[int, bool] = {}
        self.name = [str(i) for i in ids]
        self.special = {*self.byte, *self.control, self.unknown}
        reached = [i for i in normal if len(self.text[i]) == 1]
        for i in merged:
            if split := self._split(i):
                self.pair[split] = self.rank[i]
                self.parts[i] = split
                self.follows.clear()
                reached.append(i)
        self.unreached = len(merged) + sum(len(self.text[i]) == 1 for i in normal) - len(reached)
        self.find = ahocorasick.Automaton()
        for i in reached:
            self.find.add_word(self.text[i], (i, len(self.text[i])))
        self.find.make_automaton()
        mixed = any(a != SPACE and bool(LETTER.match(a)) != bool(LETTER.match(b))
                    for i in merged for a, b in zip(self.text[i], self.text[i][1:]))
        self.units = WORDS if mixed else UNITS
        self.clear()

    def clear(self) -> None:
        """Drops what was kept of the texts so far."""
        self.cache: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.odd: dict[str, str] = {}
        self.held = 0
        self.follows.clear()

    def _split(self, i: int) -> tuple[int, int] | None:
        """The pair whose merge makes piece i, both parts being made before it."""
        text = self.text[i]
        for k in range(1, len(text)):
            a, b = self.id.get(text[:k]), self.id.get(text[k:])
            if a is None or b is None or max(self.rank[a], self.rank[b]) >= self.rank[i]:
                continue
            if all(len(self.text[x]) == 1 or x in self.parts for x in (a, b)) and self.may_follow(a, b):
                return a, b
        return None

    def may_follow(self, a: int, b: int) -> bool:
        """Whether a and b stay two pieces when their texts are encoded together."""
        key = a << 20 | b
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) >= PAIRS:
                self.follows.clear()
            known = self.follows[key] = self._stay(a, b)
        return known

    def _stay(self, a: int, b: int) -> bool:
        rank, parts = self.rank, self.parts
        limit = len(rank)
        while True:
            made = self.pair.get((a, b))
            if made is not None and made < limit:
                return False
            # Undo the later of the two merges; on the left the pair merges first at equal rank.
            if rank[a] > rank[b] or b not in parts:
                if a not in parts:
                    return True
                limit = rank[a]
                a = parts[a][1]
            else:
                limit = rank[b] + 1
                b = parts[b][0]

    def word(self, text: str) -> list[int]:
        """Ids of a text without runs of spaces."""
        last = [-1] * (len(text) + 1)
        done, follows = 0, self.follows
        for at, (i, n) in self.find.iter(text):
            end = at + 1
            if end != done:
                before = last[end - n]
                stays = before < 0 or follows.get(before << 20 | i)
                if stays is None:
                    stays = self.may_follow(before, i)
                if stays:
                    last[end] = i
                    done = end
        ids: list[int] = []
        end = len(text)
        while end:
            i = last[end]
            if i < 0:  # no piece ends here: a character without a piece
                ids += [self.of_byte[b] for b in reversed(text[end - 1].encode())]
                end -= 1
            else:
                ids.append(i)
                end -= len(self.text[i])
        return ids[::-1]

    def spaces(self, n: int) -> list[int]:
        """Ids of n spaces, the longest piece first."""
        ids = []
        for size in sorted(self.runs, reverse=True):
            count, n = divmod(n, size)
            ids += [self.runs[size]] * count
        return ids

    def unit(self, unit: str) -> list[int]:
        word = unit.lstrip(" ")
        n = len(unit) - len(word)
        if not word:
            return self.spaces(n)
        if not n:
            return self.word(word)
        ids = self.word(SPACE + word)
        if n == 1:
            return ids
        if self.text[ids[0]] == SPACE:
            return self.spaces(n) + ids[1:]
        return self.spaces(n - 1) + ids

    def apart(self, text: str | None) -> list[str]:
        """The units of a text, with plain spaces; those of most texts take a byte a character."""
        return self.units.findall(" " + text.replace(SPACE, " ")) if text else []

    def encode(self, text: str | None) -> list[int]:
        """Ids without the end id."""
        return [i for u in self.apart(text) for i in self.unit(u)]

    def surface(self, ids: list[int]) -> str:
        """Text of ids, spaces kept."""
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            if i in self.byte:
                raw.append(self.byte[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(" ⁇ " if i == self.unknown else "" if i in self.control else self.text[i].replace(SPACE, " "))
        return "".join(out) + raw.decode("utf-8", "replace")

    def decode(self, ids: list[int]) -> str:
        text = self.surface(ids)
        return text[1:] if text[:1] == " " else text

    def named(self, unit: str) -> str:
        """The ids of a unit in decimal. Keeps them, and in `odd` what the unit decodes to where that is not itself."""
        names = self.older.get(unit)
        if names is None:
            ids = self.unit(unit)
            names = " ".join([self.name[i] for i in ids])
            # Pieces alone are the unit's own characters.
            if not self.special.isdisjoint(ids) and (back := self.surface(ids)) != unit:
                self.odd[unit] = back
        if len(unit) <= CACHED_CHARS and self.held < CACHE_BYTES // 2:
            self.held += 180 + 2 * len(unit) + len(names)
            self.cache[unit] = names
        return names

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids with the end id, sha256 of the ids in decimal, sha256 of the text decoded from them."""
        if len(self.odd) >= PAIRS:
            self.clear()
        elif self.held >= CACHE_BYTES // 2:
            self.older, self.cache, self.held = self.cache, {}, 0
        get, units = self.cache.get, self.apart(text)
        names = " ".join([get(u) or self.named(u) for u in units] + [str(self.end)])
        if self.odd and not self.odd.keys().isdisjoint(units):
            units = [self.odd.get(u, u) for u in units]
        back = "".join(units)
        return (names.count(" ") + 1, hashlib.sha256(names.encode()).hexdigest(),
                hashlib.sha256((back[1:] if back[:1] == " " else back).encode()).hexdigest())


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of docs(doc_id, text)."""
    data = docs.select("doc_id", docs["text"].alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = resident(("pieces", path), lambda: Pieces(path))
        try:
            for batch in in_chunks(batches, "_text"):
                rows = [model.digest(t) for t in batch.column("_text").to_pylist()]
                n, ids, back = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        finally:
            model.clear()
            release()

    kind = data.schema["doc_id"].dataType.simpleString()
    return data.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
