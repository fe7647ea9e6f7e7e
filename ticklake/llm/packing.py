"""Packing tokenised documents into fixed windows, online and in bounded space.

A task tokenises its documents and keeps at most `OPEN` unfinished windows. A
document's full windows leave at once; its remainder goes to the open window
it fits best. When it fits none, the fullest window is emitted; room of
`MIN_CUT` or more tokens in it is first filled with the head of the remainder
(cuts are free). The windows still open at the end of the tasks are merged:
groups of neighbouring tasks pack theirs again in the same way, and the last
ones are cut to lengths that are powers of two, which need no padding.

Edges: null text is an empty text (its end id alone); an empty table gives no
pieces; repeated rows are packed as often as they occur.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, saved, text_or_empty

WINDOW = 2048
OPEN = 64
MIN_CUT = 24
MERGE = 8             # tasks whose leftovers are merged together
END_ID = 1
ROWS = 500             # documents encoded at a time
TOKENIZER = "byte_bpe_50k"
PIECE = "doc_id long, start long, length long, doc_tokens long, ids binary, task long, window long, offset long, open boolean"
#: Texts of these characters alone are split alike by both libraries' patterns.
_PLAIN = re.compile("[^\\t\\n\\r\\x20-\\x7e\\u00a1-\\u024f]")


class Encoder:
    """Ids of the byte-level BPE file by `tokenizers`, as the file defines them: the string of one of its special
    tokens is that token, wherever it stands. Plain texts without such a string take the same vocabulary
    through tiktoken, which gives equal ids in a quarter of the time."""

    def __init__(self, name: str = TOKENIZER) -> None:
        import base64
        import json

        import public_tokenizers as P
        import tiktoken
        self.file, self.exact = P.path(f"{name}.json"), None
        with open(P.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(self.file, encoding="utf-8") as f:
            special = [t["content"] for t in json.load(f)["added_tokens"]]
        self.odd = re.compile("|".join([_PLAIN.pattern, *map(re.escape, special)]))
        self.fast = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.odd.search(text):
            if self.exact is None:
                from tokenizers import Tokenizer
                self.exact = Tokenizer.from_file(self.file)
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)


class OpenWindows:
    """At most `count` unfinished windows; `add` and `close` return finished ones as lists of pieces."""

    def __init__(self, size: int = WINDOW, count: int = OPEN, min_cut: int = MIN_CUT) -> None:
        self.size, self.count, self.min_cut = size, count, min_cut
        self.fill: list[int] = []
        self.parts: list[list] = []

    def _pop(self, i: int) -> list:
        self.fill.pop(i)
        return self.parts.pop(i)

    def add(self, piece) -> Iterator[list]:
        """A piece is (length, cut): cut(a, b) is its part from a up to b."""
        length, cut = piece
        at = 0
        while length - at >= self.size:
            yield [(self.size, cut(at, at + self.size))]
            at += self.size
        while at < length:
            need = length - at
            fits = [(self.size - f, i) for i, f in enumerate(self.fill) if self.size - f >= need]
            if fits:
                _, i = min(fits)
                self.parts[i].append((need, cut(at, length)))
                self.fill[i] += need
                if self.fill[i] == self.size:
                    yield self._pop(i)
                return
            if len(self.fill) < self.count:
                self.fill.append(need)
                self.parts.append([(need, cut(at, length))])
                return
            i = max(range(len(self.fill)), key=self.fill.__getitem__)
            room = self.size - self.fill[i]
            if room >= self.min_cut:
                self.parts[i].append((room, cut(at, at + room)))
                at += room
            yield self._pop(i)

    def close(self) -> Iterator[list]:
        while self.fill:
            yield self._pop(0)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary()] + [pa.int64()] * 3 + [pa.bool_()]
    names = [c.split()[0] for c in PIECE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 9, kinds)], names)


def _rows(parts: list, task: int, window: int, open_: bool) -> list[tuple]:
    out, at = [], 0
    for length, (doc, start, total, ids) in parts:
        out.append((doc, start, length, total, ids, task, window, at, open_))
        at += length
    return out


def _encode(encoder=Encoder):
    """Batches of (doc_id, text) to batches of (doc_id, ids), a few hundred documents at a time."""
    def run(batches):
        enc = encoder()
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                ids = [np.append(enc(t), np.uint32(END_ID)).astype("<u4").tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])
    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def tokenised(docs: DataFrame, encoder=Encoder) -> DataFrame:
    """doc_id and the document's ids with the end id, as little-endian unsigned 32-bit binary."""
    return _texts(docs).mapInArrow(_encode(encoder), "doc_id long, ids binary")


def pack_documents(docs: DataFrame, encoder=Encoder, **options) -> DataFrame:
    """`pack(tokenised(docs))`, both in one pass of one Python worker a task."""
    return pack(_texts(docs), before=_encode(encoder), **options)


def pack(tokens: DataFrame, size: int = WINDOW, count: int = OPEN, min_cut: int = MIN_CUT, before=None) -> DataFrame:
    """Pieces of the documents in `tokens` (doc_id, ids; or what `before` makes these batches of): doc_id, start, length,
    doc_tokens, ids (of the piece), sequence_id, offset. Every id lies in exactly one piece."""
    def first(batches):
        from pyspark import TaskContext
        task, windows, n = TaskContext.get().partitionId(), OpenWindows(size, count, min_cut), 0
        for batch in before(batches) if before else batches:
            rows = []
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total = len(raw) // 4
                for parts in windows.add((total, lambda a, b: (doc, a, total, raw[4 * a:4 * b]))):
                    rows += _rows(parts, task, n, False)
                    n += 1
            yield _batch(rows)
        rows = []
        for parts in windows.close():
            rows += _rows(parts, task, n, True)
            n += 1
        yield _batch(rows)

    def merge(batches):
        """Rows come by group, task, window and offset; a group's windows pack again, its last ones by powers of two."""
        for group, rows in _groups(batches):
            windows, n, out = OpenWindows(size, count, min_cut), 0, []
            for item in rows:
                doc, start, length, total, ids = item[:5]
                for parts in windows.add((length, lambda a, b: (doc, start + a, total, ids[4 * a:4 * b]))):
                    out += _rows(parts, group, n, False)
                    n += 1
            rest = [p for parts in windows.close() for p in parts]
            for parts in _powers(rest, size):
                out += _rows(parts, group, n, False)
                n += 1
            yield _batch(out)

    source = tokens if before else tokens.select("doc_id", "ids")
    tail = saved(source.mapInArrow(first, PIECE), "packed")
    left = tail.where("open").withColumn("grp", F.expr(f"task div {MERGE}"))
    n = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = (left.repartition(n, "grp").sortWithinPartitions("grp", "task", "window", "offset")
              .select("doc_id", "start", "length", "doc_tokens", "ids", "grp").mapInArrow(merge, PIECE))
    done = ["doc_id", "start", "length", "doc_tokens", "ids"]
    seq = F.shiftleft("task", 33) + F.col("window") * 2
    return (tail.where("NOT open").select(*done, seq.alias("sequence_id"), "offset")
            .unionByName(merged.select(*done, (seq + 1).alias("sequence_id"), "offset")))


def _groups(batches):
    """(group, iterator over its rows) of sorted batches whose sixth column is the group."""
    import itertools
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    return itertools.groupby(rows, key=lambda r: r[5])


def _powers(parts: list, size: int) -> Iterator[list]:
    """Cut the parts, laid end to end, into sequences of `size` and then of falling powers of two."""
    left, cur, fill = sum(p[0] for p in parts), [], 0
    goal = size if left >= size else 1 << max(0, left.bit_length() - 1)
    for length, (doc, start, total, ids) in parts:
        at = 0
        while at < length:
            take = min(length - at, goal - fill)
            cur.append((take, (doc, start + at, total, ids[4 * at:4 * (at + take)])))
            at, fill, left = at + take, fill + take, left - take
            if fill == goal:
                yield cur
                cur, fill = [], 0
                goal = size if left >= size else 1 << max(0, left.bit_length() - 1)


def digest(pieces: DataFrame) -> DataFrame:
    """The columns of the contract; ids_crc32 over the piece's ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7(spark, sf_dir: str) -> DataFrame:
    """All documents, packed."""
    return digest(pack_documents(read(spark, sf_dir, "documents")))
