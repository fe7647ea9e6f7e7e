"""Line dedup: fuzzy duplicates of lines across all documents, one line kept of each component.

A line is a text between newlines. Its set are the distinct shingles of
`SHINGLE` characters of the line, A-Z lowered (a shorter line is one shingle).
`BANDS` bands of `ROWS` minimum hashes give candidates: at a similarity of 0.8
a pair meets with probability 0.995, at 0.9 with 0.99998. Every candidate link
is verified by its exact Jaccard similarity, and links join by distributed
union-find. Equal lines share a hash and are one node from the start, so a
line that stands in a third of the documents is one row a task at most.

Of a component the first line stays, by doc_id (nulls last), hash of the text
and position. Edges: blank lines are never duplicates and stay; null and empty
texts are one blank line; rows that repeat doc_id and text count as one
document and keep the same lines; an empty table gives no rows.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .candidates import PAIR_ROWS, Evidence, connect, with_payload
from .common import _U, _powers, chunks, few, hash_functions, minima, mix, read, saved, text_or_empty

SHINGLE = 9
ROWS, BANDS = 4, 10
NUM, DEN = 8, 10
LINE_CHUNK = 1 << 17     # bytes of text that are cut and signed at a time
WIDE = 1 << 14           # distinct shingles of a group that are counted at a time
PAIRS = 512              # pairs of lines that are Python strings at a time
RECENT = 200_000         # lines a task remembers to have signed
_HASHES = hash_functions(ROWS * BANDS, 21)
_CHAR = _U(0xD6E8FEB86659FD93)


def _codes(buf: np.ndarray) -> np.ndarray:
    """Code points of UTF-8 bytes, A-Z lowered; bytes that aren't UTF-8 stand for themselves."""
    try:
        c = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).copy()
    except UnicodeDecodeError:
        return buf.astype(np.uint32)
    c[(c >= 65) & (c <= 90)] += 32
    return c


_KNOWN = mix(np.arange(1 << 13, dtype=_U) * _CHAR)  # of the code points of most texts


def _line_table(buf: np.ndarray, off: np.ndarray):
    """Row, start and end (in code points) of every line, the code points, and their prefix sums."""
    codes = _codes(buf)
    at = off if len(codes) == len(buf) else np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))[off]
    breaks = np.flatnonzero(codes == 10)
    start = np.concatenate((at[:-1], breaks + 1))
    end = np.concatenate((at[1:], breaks))
    row = np.concatenate((np.arange(len(at) - 1), np.searchsorted(at, breaks, "right") - 1))
    order = np.lexsort((end, row))
    end = end[order]
    order = np.lexsort((start, row))
    start, row = start[order], row[order]
    c = np.zeros(len(codes) + 1, _U)
    chars = _KNOWN[codes] if not len(codes) or codes.max() < len(_KNOWN) else mix(codes.astype(_U) * _CHAR)
    np.cumsum(chars * _powers(len(codes) + 1)[0][:-1], out=c[1:])
    return row, start, end, codes, c


def _hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((c[end] - c[start]) * _powers(len(c))[1][start] + (end - start).astype(_U))


def _blank(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    solid = np.concatenate(([0], np.cumsum((codes != 32) & ((codes < 9) | (codes > 13)))))
    return solid[end] == solid[start]


def _shingles(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of the given lines, laid end to end, and where each line's begin."""
    count = np.maximum(end - start - SHINGLE + 1, 1)
    at = np.concatenate(([0], np.cumsum(count)))
    pos = np.arange(at[-1]) - np.repeat(at[:-1] - start, count)
    last = len(c) - 1 - SHINGLE
    if last < 0:
        return _hash(c, start, end), at  # every line is shorter than a shingle
    whole = mix((c[SHINGLE:] - c[:last + 1]) * _powers(len(c))[1][:last + 1] + _U(SHINGLE))
    x = whole[np.minimum(pos, last)]
    short = end - start < SHINGLE
    x[at[:-1][short]] = _hash(c, start[short], end[short])
    return x, at


def _band_keys(sig: np.ndarray) -> np.ndarray:
    """A key for each band of minimum hashes: lines by bands."""
    h = np.repeat(np.arange(1, BANDS + 1, dtype=_U)[None, :], len(sig), 0)
    for r in range(ROWS):
        h = mix(h * _U(31) + sig[:, r:ROWS * BANDS:ROWS])
    return h.view(np.int64)


def _signed(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    short = (x >> _U(32)).astype(np.uint32)
    room = np.empty_like(short)
    return _band_keys(np.stack([minima(short, at[:-1], *f, room) for f in _HASHES], 1))


LINES = "doc_id long, text_hash long, line_no int, line long, keys array<long>, text string"


def cut_lines(docs: DataFrame) -> DataFrame:
    """A row for every line (see LINES): line is its hash (null: blank); keys (of the bands) and text
    stand where a task meets the line for the first time, as far as it remembers, so each text is
    cut once and each distinct line is signed about once a task."""
    def run(batches):
        recent: dict[int, None] = {}
        for batch in batches:
            for i, j, buf, off in chunks(batch.column(2), LINE_CHUNK):
                row, start, end, codes, c = _line_table(buf, off)
                pos = np.arange(len(row)) - np.searchsorted(row, np.arange(j - i))[row]
                line, blank = _hash(c, start, end), _blank(codes, start, end)
                solid = np.flatnonzero(~blank)
                _, one = np.unique(line[solid], return_index=True)
                pick = np.sort(solid[one])
                pick = pick[[h not in recent for h in line[pick].tolist()]] if len(pick) else pick
                if len(recent) > RECENT:
                    recent.clear()
                recent |= dict.fromkeys(line[pick].tolist())
                new = np.zeros(len(row), bool)
                new[pick] = True
                if len(pick):
                    key = _signed(*_shingles(c, start[pick], end[pick])).ravel()
                else:
                    key = np.zeros(0, np.int64)
                text = codes.tobytes().decode("utf-32-le", "replace")
                # lists and texts of the new lines, nothing for the others
                ends = np.concatenate(([0], np.cumsum(new))).astype(np.int32)
                mask = pa.array(~new)
                keys = pa.ListArray.from_arrays(pa.array(ends * BANDS), pa.array(key), mask=mask)
                texts = pa.array([text[a:b] if n else None for n, a, b in zip(new.tolist(), start.tolist(), end.tolist())], pa.string())
                take = pa.array(row + i)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(take), batch.column(1).take(take), pa.array(pos.astype(np.int32)),
                    pa.array(line.view(np.int64), mask=blank), keys, texts], [f.split()[0] for f in LINES.split(", ")])
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_hash"), text_or_empty().alias("text"))
    return d.mapInArrow(run, LINES)


def jaccard(a: str, b: str) -> tuple[int, int]:
    """Sizes of the intersection and the union of two (lowered) lines' shingles."""
    x, y = ({t[i:i + SHINGLE] for i in range(max(1, len(t) - SHINGLE + 1))} for t in (a, b))
    k = len(x & y)
    return k, len(x) + len(y) - k


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return x[new]


def overlaps(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """`jaccard` of many pairs of lines, by 48-bit hashes of their shingles."""
    sides = []
    for texts in (left, right):
        buf = np.frombuffer("\n".join(texts).encode("utf-8", "replace"), np.uint8)
        _, start, end, _, c = _line_table(buf, np.array([0, len(buf)]))
        x, at = _shingles(c, start, end)
        pair = np.repeat(np.arange(len(texts), dtype=_U), np.diff(at))
        sides.append(_distinct((pair << _U(48)) | (x >> _U(16))))
    both = np.sort(np.concatenate(sides))
    size = sum(np.bincount((s >> _U(48)).astype(np.int64), minlength=len(left)) for s in sides)
    inter = np.bincount((both[1:][both[1:] == both[:-1]] >> _U(48)).astype(np.int64), minlength=len(left))
    return inter, size - inter


def _pack(payloads: list[str], key: int | None):
    """Band keys before the group's, and the lines' distinct shingles, numbered within the group and laid end to end."""
    buf = np.frombuffer("\n".join(payloads).encode("utf-8", "replace"), np.uint8)
    _, start, end, _, c = _line_table(buf, np.array([0, len(buf)]))
    x, at = _shingles(c, start, end)
    if key is None:
        earlier = np.zeros((len(payloads), 0), np.int64)
    else:
        keys = _signed(x, at)
        earlier = keys[:, :int((keys[0] == key).argmax())]
    order = np.argsort(x)
    new = np.ones(len(x), bool)
    new[1:] = x[order][1:] != x[order][:-1]
    number = np.empty(len(x), np.int64)
    number[order] = np.cumsum(new) - 1
    known = int(new.sum())
    once = _distinct(np.repeat(np.arange(len(at) - 1), np.diff(at)) * known + number)
    begin = np.searchsorted(once, np.arange(len(at)) * known)
    return earlier, once % known, begin, np.zeros(known, bool)


def _matches(packed, a: int, others: np.ndarray, apart):
    earlier, shingle, begin, mark = packed
    others = others[~(earlier[others] == earlier[a]).any(1)]
    size, own = np.diff(begin), shingle[begin[a]:begin[a + 1]]
    mark[own] = True
    both = np.add.reduceat(mark[shingle], begin[:-1], dtype=np.int64)[others]
    mark[own] = False
    similar = DEN * both >= NUM * (size[a] + size[others] - both)
    for b in others[similar][np.argsort(-both[similar], kind="stable")].tolist():
        if apart(b):
            yield b


def _linked(payloads: list[str], begin: np.ndarray) -> tuple[list[int], list[int]]:
    """The links within groups of lines, each the payloads from one of `begin` to the next."""
    buf = np.frombuffer("\n".join(payloads).encode("utf-8", "replace"), np.uint8)
    _, start, end, _, c = _line_table(buf, np.array([0, len(buf)]))
    x, at = _shingles(c, start, end)
    left, right = [], []
    for lo, hi in itertools.pairwise(begin.tolist()):
        n, s = hi - lo, x[at[lo]:at[hi]]
        order = np.argsort(s)
        s, line = s[order], np.repeat(np.arange(n), np.diff(at[lo:hi + 1]))[order]
        number = np.zeros(len(s), np.int64)
        np.cumsum(s[1:] != s[:-1], out=number[1:])
        inter = np.zeros((n, n))
        for first in range(0, int(number[-1]) + 1, WIDE):
            part = slice(*np.searchsorted(number, (first, first + WIDE)).tolist())
            has = np.zeros((n, min(WIDE, int(number[-1]) + 1 - first)), np.float32)
            has[line[part], number[part] - first] = 1
            inter += has @ has.T
        size = inter.diagonal()
        for i, j in np.argwhere(np.triu((DEN + NUM) * inter >= NUM * (size[:, None] + size), 1)).tolist():
            left.append(lo + i)
            right.append(lo + j)
    return left, right


def _confirm(batches):
    """Pairs that are links: by hashes, and by the strings themselves where two equal hashes could decide."""
    for batch in batches:
        lo = 0
        while lo < batch.num_rows:
            a, b, x, y = (c.to_pylist() for c in batch.slice(lo, PAIRS).columns)
            n, total = 0, 0  # pairs of about LINE_CHUNK characters
            while n < len(x) and (not n or total < LINE_CHUNK):
                total += len(x[n]) + len(y[n])
                n += 1
            inter, union = overlaps(x[:n], y[:n])
            gap = DEN * inter - NUM * union
            ok = gap >= 0
            for k in np.flatnonzero(np.abs(gap) <= 4 * DEN).tolist():
                i, u = jaccard(x[k], y[k])
                ok[k] = DEN * i >= NUM * u
            yield pa.RecordBatch.from_arrays([pa.array([v for v, good in zip(c, ok.tolist()) if good], pa.int64()) for c in (a[:n], b[:n])], ["a", "b"])
            lo += n


def _pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Keys and lines of rows of (line, keys)."""
    return batch.column(1).flatten().to_numpy(), np.repeat(batch.column(0).to_numpy(), BANDS)


def fuzzy_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, line_no, line, component (null: no other line like it), first_doc,
    first_text, first_line (the line kept of its component), kept - for every line of every document."""
    return _fuzzy_lines(saved(cut_lines(docs), "lines", "zstd"))


def _fuzzy_lines(cut: DataFrame) -> DataFrame:
    """`fuzzy_lines` of the lines that `cut_lines` made, written."""
    total = cut.count()
    seen = cut.select("doc_id", "text_hash", "line_no", "line")

    def prepare(items: DataFrame):
        met = cut.where("text IS NOT NULL").select("line", "text").join(items.select(F.col("item").alias("line")).hint("shuffle_hash"), "line", "left_semi")
        texts = saved(few(met.groupBy("line").agg(F.min("text").alias("text")), total).select(F.col("line").alias("item"), F.col("text").alias("payload")),
                      "lines-texts", "zstd")

        def verify(pairs: DataFrame, rows: int) -> DataFrame:
            both = few(with_payload(few(with_payload(pairs, texts, "b", "t_b"), rows), texts, "a", "t_a"), rows, PAIR_ROWS)
            return both.select("a", "b", "t_a", "t_b").mapInArrow(_confirm, "a long, b long")
        weight = texts.select("item", F.octet_length("payload").alias("weight"))
        return Evidence(verify, texts, _pack, _matches, weight, linked=_linked)

    comp = connect(cut.where("keys IS NOT NULL").select("line", "keys"), _pairs, BANDS, prepare, "lines")
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash", "line_no")
    by_line = seen.where("line IS NOT NULL").groupBy("line").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    by_line = few(by_line.join(comp, F.col("line") == F.col("node"), "left"), total).withColumn("component", F.coalesce("component", "line"))
    by_line = saved(by_line.where("n > 1 OR node IS NOT NULL").select("line", "component", "first"), "lines-firsts")
    firsts = few(by_line.groupBy("component").agg(F.min("first").alias("first")), total)
    nodes = few(by_line.select("line", "component").join(firsts, "component"), total).select(F.col("line").alias("_line"), "component", "first")
    out = few(seen.join(nodes, F.col("line") == F.col("_line"), "left"), total)
    kept = F.col("first").isNull() | F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash", "line_no").eqNullSafe(F.col("first"))
    return out.select("doc_id", "text_hash", "line_no", "line", "component", F.col("first.doc_id").alias("first_doc"),
                      F.col("first.text_hash").alias("first_text"), F.col("first.line_no").alias("first_line"), kept.alias("kept"))


def drop_duplicate_lines(docs: DataFrame) -> DataFrame:
    """The documents without their duplicate lines, all columns kept. A document that loses every
    line that isn't blank is dropped; one that loses none stays as it is."""
    cut = saved(cut_lines(docs), "lines", "zstd")
    total = cut.count()
    gone = saved(few(_fuzzy_lines(cut).where("NOT kept").select("doc_id", "text_hash", "line_no").distinct()
                     .groupBy(F.col("doc_id").alias("__llm_id"), F.col("text_hash").alias("__llm_hash")).agg(F.collect_list("line_no").alias("__llm_gone")), total), "lines-gone")
    d = docs.withColumn("__llm_h", F.xxhash64(text_or_empty()))
    d = few(d.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col("__llm_id")) & (F.col("__llm_h") == F.col("__llm_hash")), "left"), total)
    # the stretches between the lines that go
    d = d.withColumn("__llm_at", F.concat(F.array(F.lit(-1)), F.sort_array("__llm_gone"), F.array(F.size(F.split("text", "\n", -1)))))
    d = d.withColumn("__llm_lines", F.when(F.col("__llm_gone").isNotNull(), F.split("text", "\n", -1)))
    left = F.expr("flatten(transform(sequence(1, size(__llm_at) - 1), k -> slice(__llm_lines, __llm_at[k - 1] + 2, __llm_at[k] - __llm_at[k - 1] - 1)))")
    text = F.when(F.col("__llm_gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    full = F.col("__llm_gone").isNull() | F.exists(left, lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    d = d.where(full).withColumn("text", text)
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.when(F.col("__llm_gone").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return d.select(*docs.columns)


def op1(spark, sf_dir: str) -> DataFrame:
    """Every line of all documents with its component."""
    return fuzzy_lines(read(spark, sf_dir, "documents")).select("doc_id", "line_no", "component", "first_doc", "first_line", "kept")
