"""Bounded-space online packing of token streams into sequences of fixed length."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.common import materialise, ship

WIDTH = 4  # bytes of a token id
_ENTRY = 200  # bytes of a kept entry besides its letters and ids
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_STORED = f"{_PIECES}, ids binary, closed boolean, home long"
_SPACE = re.compile(r"(?<=\S) (?=\S)")
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
_PLAIN = re.compile(rf"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([{re.escape(_MARKS)}]*)")
_encoders: dict[str, ChunkEncoder] = {}


class _Known(dict):
    """Values computed when first asked for, kept in two generations of half of `budget` bytes each.

    A full young generation becomes the old one; what is asked for again moves up. Keys of over `longest` characters are not kept.
    """

    def __init__(self, compute: Callable[[str], bytes], budget: int, longest: int = 64):
        super().__init__()
        self.compute, self.half, self.longest = compute, budget // 2, longest
        self.old: dict[str, bytes] = {}
        self.held = 0

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            size = _ENTRY + 2 * len(key) + len(value)
            self.held += size
            if self.held > self.half:
                self.old = dict(self)
                self.clear()
                self.held = size
            self[key] = value
        return value


class _Blank(Exception):
    """A chunk that starts or ends in white space, where cutting at single spaces is wrong."""


class ChunkEncoder:
    """Token ids of whole texts, with the ids of frequent parts kept.

    The vocabulary's split pattern always starts a new piece at a single space between two visible characters, so a
    text is cut there and the ids of its chunks are joined. Letters, marks after them and single line ends are pieces
    of their own too; a chunk of those is made from its pieces, which only the merges see. Any other chunk is left to
    the tokenizer as a whole. Added tokens, such as the end of a text, are cut out first and keep their own ids, as the
    tokenizer has it. A word behind a space is kept once, as a chunk, and serves chunks that end in marks too.
    `budget` bounds the bytes of the kept chunks; kept pieces, words without a space and marks, have a fifth as much again.
    """

    def __init__(self, path: str, budget: int = 250_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content: i.to_bytes(WIDTH, "little") for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added, self.marks = added, re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.chunks, self.pieces = _Known(self._spaced, budget), _Known(self._piece, budget // 5)
        self.letters, self.tokenize = str.maketrans(_byte_letters()), self.tokenizer.model.tokenize
        self.space = " ".translate(self.letters)

    def _piece(self, piece: str) -> bytes:
        return self._merged(piece.encode().decode("latin-1").translate(self.letters))

    def _merged(self, spelled: str) -> bytes:
        return b"".join([t.id.to_bytes(WIDTH, "little") for t in self.tokenize(spelled)])

    def _spaced(self, chunk: str) -> bytes:
        if chunk.isalpha() and chunk.isascii():  # such letters stand for themselves
            return self._merged(self.space + chunk)
        if plain := _PLAIN.fullmatch(chunk):
            word, marks = plain.groups()
            return self.chunks[word] + self.pieces[marks] if marks else self._piece(f" {word}")
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Blank
        return self._chunk(f" {chunk}")

    def _chunk(self, chunk: str) -> bytes:
        parts = []
        for line in chunk.split("\n"):
            if not _PLAIN.fullmatch(line, 0 if parts else chunk.startswith(" ")):
                return self._whole(chunk)
            word = line.rstrip(_MARKS)
            parts += ["\n", word, line[len(word) :]]
        return b"".join([self.chunks[p[1:]] if p[0] == " " else self.pieces[p] for p in parts[1:] if p])

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join(i.to_bytes(WIDTH, "little") for i in ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if any(mark in text for mark in self.added):
            return b"".join(self.added.get(part) or self._plain(part) for part in self.marks.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        first, *rest = text.split(" ")
        try:
            if not first or first[-1].isspace():
                raise _Blank
            return self._chunk(first) + b"".join(map(self.chunks.__getitem__, rest))
        except _Blank:
            first, *rest = _SPACE.split(text)
            return self._chunk(first) + b"".join([self._chunk(f" {c}") for c in rest])


def _byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary: itself, or the next one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def encoder(path: str) -> ChunkEncoder:
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


class Packer:
    """Open windows of one task. Pieces go to the fullest window that has room; rows come out as windows close."""

    def __init__(self, size: int, windows: int, min_cut: int, home: int, first_id: int):
        self.size, self.windows, self.min_cut, self.home, self.next_id = size, windows, min_cut, home, first_id
        self.open: list[tuple[int, int, list]] = []  # (room, number, pieces), least room first
        self.made, self.rows = 0, []

    def close(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            length = len(ids) // WIDTH
            self.rows.append((doc, start, length, zlib.crc32(ids), total, self.next_id, offset, None, True, self.home))
            offset += length
        self.next_id += 1

    def _put(self, room: int, number: int, pieces: list, piece: tuple) -> None:
        pieces.append(piece)
        room -= len(piece[2]) // WIDTH
        if room:
            insort(self.open, (room, number, pieces), key=lambda w: w[:2])
        else:
            self.close(pieces)

    def add(self, doc, start: int, ids: bytes, total: int) -> None:
        """Place a piece of at most `size` tokens."""
        while length := len(ids) // WIDTH:
            if length == self.size:
                return self.close([(doc, start, ids, total)])
            at = bisect_left(self.open, length, key=lambda w: w[0])
            if at < len(self.open):
                return self._put(*self.open.pop(at), (doc, start, ids, total))
            if len(self.open) < self.windows:
                self.made += 1
                return self._put(self.size, self.made, [], (doc, start, ids, total))
            room, number, pieces = self.open.pop(0)  # none fits: the fullest leaves
            if room < self.min_cut:
                self.close(pieces)
            else:
                head, ids = ids[: room * WIDTH], ids[room * WIDTH :]
                self._put(room, number, pieces, (doc, start, head, total))
                start += room
        return None

    def document(self, doc, ids: bytes) -> None:
        total, step = len(ids) // WIDTH, self.size * WIDTH
        for at in range(0, len(ids), step):
            self.add(doc, at // WIDTH, ids[at : at + step], total)

    def squeeze(self) -> None:
        """Close all windows; their pieces are cut so that only the last sequence has room left."""
        rest = [piece for _, _, pieces in self.open for piece in pieces]
        self.open, room, pieces = [], self.size, []
        for doc, start, ids, total in rest:
            while ids:
                head, ids = ids[: room * WIDTH], ids[room * WIDTH :]
                pieces.append((doc, start, head, total))
                start, room = start + len(head) // WIDTH, room - len(head) // WIDTH
                if not room:
                    self.close(pieces)
                    room, pieces = self.size, []
        if pieces:
            self.close(pieces)

    def leave(self) -> None:
        """Hand open windows on as rows that carry their ids."""
        for _, number, pieces in self.open:
            for place, (doc, start, ids, total) in enumerate(pieces):
                self.rows.append((doc, start, len(ids) // WIDTH, None, total, number, place, ids, False, self.home))
        self.open = []

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("ids", pa.binary()), ("closed", pa.bool_()), ("home", pa.int64())]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


def _first_id(level: int, home: int) -> int:
    """Sequence ids: 5 bits of level, 27 of task, 31 of running number."""
    return (level << 58) | (home << 31)


def pack(
    docs: DataFrame, vocabulary: str, size: int = 1024, windows: int = 64, min_cut: int = 8, end_id: int = 0, fan_in: int = 64
) -> DataFrame:
    """Pieces of `docs` (doc_id, text) in sequences of `size` tokens.

    Each partition streams its rows in their order through at most `windows` open windows: a piece goes to the window
    with the least sufficient room; when none has room, the fullest is filled with the head of the piece and leaves
    (or leaves as it is when its room is under `min_cut`). Windows left open at the end of a partition are packed
    again, `fan_in` tasks into one, level by level, so no task meets more than fan_in × windows of them; what is
    left at the top is cut densely, so that a single sequence of the whole corpus ends early.

    Null or empty text gives the one token `end_id`. A row is a document: repeated ids or rows are packed each.
    An empty table gives no rows. Other columns are ignored. Null doc_id is kept as null.
    """
    spark = docs.sparkSession
    ship(spark)
    end = end_id.to_bytes(WIDTH, "little")

    def first(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = TaskContext.get().partitionId()
        packer, encode = Packer(size, windows, min_cut, home, _first_id(0, home)), encoder(vocabulary).encode
        for batch in stream:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.document(doc, encode(text.as_py() or "") + end)
                if len(packer.rows) > 20_000:
                    yield _batch(packer.take())
        packer.leave()
        if rows := packer.take():
            yield _batch(rows)

    def merged(level: int, top: bool):
        def task(group: pd.DataFrame) -> pd.DataFrame:
            home = int(group["home"].iloc[0]) // fan_in
            packer = Packer(size, windows, min_cut, home, _first_id(level, home))
            group = group.sort_values(["home", "sequence_id", "offset"], kind="stable")
            for doc, start, ids, total in zip(group["doc_id"], group["start"], group["ids"], group["doc_tokens"], strict=True):
                packer.add(None if pd.isna(doc) else int(doc), int(start), bytes(ids), int(total))
            packer.squeeze() if top else packer.leave()
            rows = packer.take()
            return pa.Table.from_batches([_batch(rows)] if rows else [], schema=_ARROW).to_pandas(types_mapper=_nullable)

        return task

    stored = materialise(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(first, _STORED), "packed")
    parts, level = [stored.filter("closed")], 0
    rest = stored.filter("NOT closed")
    last = rest.agg(F.max("home")).first()[0]
    while last is not None:
        level, last = level + 1, last // fan_in
        again = rest.groupBy(F.expr(f"home div {fan_in}")).applyInPandas(merged(level, last == 0), _STORED)
        stored = materialise(again, f"packed-{level}")
        parts.append(stored.filter("closed"))
        rest = stored.filter("NOT closed")
        last = None if last == 0 else last
    return reduce(DataFrame.unionByName, parts).select(*[c.split()[0] for c in _PIECES.split(", ")])


def _nullable(kind: pa.DataType):
    return pd.Int64Dtype() if kind == pa.int64() else None
