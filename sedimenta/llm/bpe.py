"""Byte-level BPE by prefix dynamic programming.

A sequence of tokens is the BPE encoding of its bytes exactly if every two neighbours are the
encoding of their own bytes. So every prefix of a piece has one valid last token, and it suffices to store
that token per prefix: the last token that ends at byte i is the one token t for which the token stored at i - len(t)
and t may stand side by side. Appended bytes extend the table; an edit recomputes it from the edit until it
agrees with the old one again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED_PIECES = 300_000  # bound of the piece cache of a Python worker
CACHED_PAIRS = 1_000_000
CACHED_LENGTH = 64  # longer pieces are not cached


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file: base64 token and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class PrefixEncoder:
    """BPE over the ranks of a vocabulary in which every token can be reached by merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = dict(map(reversed, ranks.items()))
        self.longest = max(map(len, ranks))
        self.ends = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.ends.add_word(token.decode("latin-1"), (len(token), rank))
        self.ends.make_automaton()
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}

    def split(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes a token; None for a single byte."""
        if rank not in self.parts:
            token = self.tokens[rank]
            self.parts[rank] = next(
                (
                    (left, right)
                    for left, right in (
                        (self.ranks.get(token[:i], rank), self.ranks.get(token[i:], rank))
                        for i in range(1, len(token))
                    )
                    if left < rank and right < rank and self._adjacent(left, right, rank)
                ),
                None,
            )
        return self.parts[rank]

    def compatible(self, left: int, right: int) -> bool:
        """May the two tokens stand side by side in an encoding?"""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._adjacent(left, right, len(self.ranks) + 1)
        return known

    def _adjacent(self, left: int, right: int, before: int) -> bool:
        """Would merges of a rank below `before` leave the border between the tokens alone?

        The merges that made the tokens are undone, the latest first. A border is crossed if at
        some moment a merge over it came earlier than the next one on its left or right side;
        of two merges of one rank the left one comes first.
        """
        while True:
            over = self.ranks.get(self.tokens[left] + self.tokens[right])
            if over is not None and over < before:
                return False
            if left > right:  # the left token is the later merge: before it, its right half met the border
                halves = self.split(left)
                if halves:
                    before, left = left, halves[1]
                    continue
                halves = self.split(right)
                if not halves:
                    return True
                before, right = right + 1, halves[0]
            else:
                halves = self.split(right)
                if halves:
                    before, right = right + 1, halves[0]
                    continue
                halves = self.split(left)
                if not halves:
                    return True
                before, left = left, halves[1]

    def extend(self, last: list[int], piece: bytes, start: int, until=None) -> None:
        """Fill `last` from byte `start` on: last[i] is the token that ends the encoding of piece[: i + 1].

        `until(i)` may stop the scan after byte i."""
        base = max(0, start - self.longest + 1)
        compatible, n, done = self.compatible, start, False
        del last[start:]
        for end, (size, rank) in self.ends.iter(piece[base:].decode("latin-1")):
            end += base
            if end < n:  # settled, or before the start
                continue
            begin = end - size
            if begin < -1:
                continue
            if begin == -1 or compatible(last[begin], rank):
                last.append(rank)
                n = end + 1
                if until is not None and until(end):
                    done = True
                    break
        if not done and n != len(piece):
            raise ValueError("the vocabulary lacks single bytes")

    def prefixes(self, piece: bytes) -> list[int]:
        last: list[int] = []
        self.extend(last, piece, 0)
        return last

    def walk(self, last: list[int]) -> list[int]:
        """The tokens that a table of last tokens stands for."""
        out, end = [], len(last)
        while end:
            rank = last[end - 1]
            out.append(rank)
            end -= len(self.tokens[rank])
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        rank = self.ranks.get(piece)
        return [rank] if rank is not None else self.walk(self.prefixes(piece))


@dataclass
class Piece:
    """One match of the pattern, with the last token of every prefix."""

    text: str
    last: list[int] = field(default_factory=list)


class EncodedText:
    """A text that can be appended to and edited, always holding its exact encoding.

    Where a match of the pattern ends depends on at most two characters behind it, so matches that
    end `AHEAD` characters or more before a change stay. Behind the change, matches are taken
    over as soon as a new match starts where an old one did.
    """

    AHEAD = 3

    def __init__(self, encoder: PrefixEncoder, pattern: str, text: str = ""):
        self.encoder, self.pattern = encoder, regex.compile(pattern)
        self.pieces = [self._piece(m.group()) for m in self.pattern.finditer(text)]
        self.matched = 0  # pieces that the last change computed

    def _piece(self, text: str) -> Piece:
        return Piece(text, self.encoder.prefixes(text.encode("utf-8", "surrogatepass")))

    @property
    def text(self) -> str:
        return "".join(p.text for p in self.pieces)

    def ids(self) -> list[int]:
        return [i for p in self.pieces for i in self.encoder.walk(p.last)]

    def append(self, more: str) -> None:
        size = sum(len(p.text) for p in self.pieces)
        self.replace(size, size, more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Replace the characters [start, end) by `new`."""
        first, at = 0, 0
        while first < len(self.pieces) and at + len(self.pieces[first].text) <= start - self.AHEAD:
            at += len(self.pieces[first].text)
            first += 1
        rest = "".join(p.text for p in self.pieces[first:])
        changed = rest[: start - at] + new + rest[end - at :]
        shift = len(new) - (end - start)
        borders, where = {}, at
        for i in range(first, len(self.pieces)):
            if where >= end:
                borders[where + shift - at] = i
            where += len(self.pieces[i].text)
        fresh: list[Piece] = []
        old = self.pieces[first].last if first < len(self.pieces) else []
        old_bytes = self.pieces[first].text.encode("utf-8", "surrogatepass") if old else b""
        tail: list[Piece] = []
        for m in self.pattern.finditer(changed):
            if m.start() in borders:
                tail = self.pieces[borders[m.start()] :]
                break
            fresh.append(self._near(m.group(), old_bytes, old) if not fresh else self._piece(m.group()))
        self.matched = len(fresh)
        self.pieces = self.pieces[:first] + fresh + tail

    def _near(self, text: str, old_bytes: bytes, old: list[int]) -> Piece:
        """The table of a piece that shares its beginning, and perhaps its end, with an old one."""
        new = text.encode("utf-8", "surrogatepass")
        same = 0
        limit = min(len(new), len(old_bytes))
        while same < limit and new[same] == old_bytes[same]:
            same += 1
        tail = 0
        while tail < limit - same and new[-1 - tail] == old_bytes[-1 - tail]:
            tail += 1
        last = old[:same]
        shift = len(old_bytes) - len(new)
        agreed = 0

        def settled(i: int) -> bool:
            # Once as many prefixes as the longest token has bytes agree inside the common end, all do.
            nonlocal agreed
            agreed = agreed + 1 if i >= len(new) - tail and last[i] == old[i + shift] else 0
            return agreed >= self.encoder.longest

        if len(new) > same:
            self.encoder.extend(last, new, same, settled)
            last.extend(old[len(last) + shift :])
        return Piece(text, last)


class _Cache(dict):
    """Piece of text -> its ids as little-endian bytes, filled on first use and bounded."""

    def __init__(self, encoder: PrefixEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.encoder.encode(piece.encode("utf-8", "surrogatepass")), "<u4").tobytes()
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


_encoders: dict[tuple[str, str], tuple[_Cache, regex.Pattern]] = {}


def _encoder(path: str, pattern: str) -> tuple[_Cache, regex.Pattern]:
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = _Cache(PrefixEncoder(load_ranks(path))), regex.compile(pattern)
    return _encoders[path, pattern]


def encode_texts(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """`docs` without its text, plus `out`: the ids of the whole text as little-endian unsigned 32-bit integers.

    Every match of `pattern` is encoded by itself, without special tokens; null counts as empty
    and has no ids. Nothing is shuffled, other columns pass through untouched. A column that is
    already called `out` is replaced.
    """
    keep = [c for c in docs.columns if c not in (text_col, out)]
    rows = docs.select(*keep, F.col(text_col).alias(out))
    schema = rows.withColumn(out, F.col(out).cast("binary")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, matches = _encoder(vocabulary, pattern)
        ids_of = cache.__getitem__
        for batch in batches:
            ids = [b"".join(map(ids_of, matches.findall(t.as_py() or ""))) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(ids, pa.binary())], names=batch.schema.names
            )

    return rows.mapInArrow(run, schema)


def decode_ids(rows: DataFrame, vocabulary: str, ids_col: str = "ids", out: str = "bytes") -> DataFrame:
    """`rows` plus `out`: the bytes that the ids stand for (null and no ids: no bytes)."""
    keep = [c for c in rows.columns if c != out]
    source = rows.select(*keep)
    schema = source.withColumn(out, F.lit(None).cast("binary")).schema
    at = keep.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: t for t, rank in load_ranks(vocabulary).items()}.__getitem__
        for batch in batches:
            found = [
                b"".join(map(token, np.frombuffer(x.as_py() or b"", "<u4").tolist())) for x in batch.column(at)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.binary())], names=[*batch.schema.names, out]
            )

    return source.mapInArrow(run, schema)


def append_texts(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", more_col: str = "more"
) -> DataFrame:
    """doc_id, ids of text + more, and the number of pieces that the append had to encode."""
    pairs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(more_col).alias("more"))
    kind = pairs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, pattern)[0].encoder
        for batch in batches:
            ids, matched = [], []
            for text, more in zip(batch.column(1), batch.column(2)):
                held = EncodedText(encoder, pattern, text.as_py() or "")
                held.append(more.as_py() or "")
                ids.append(np.array(held.ids(), "<u4").tobytes())
                matched.append(held.matched)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array(matched, pa.int64())],
                names=["doc_id", "ids", "encoded_pieces"],
            )

    return pairs.mapInArrow(run, f"doc_id {kind}, ids binary, encoded_pieces long")
