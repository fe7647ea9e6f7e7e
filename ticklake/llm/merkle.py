"""Document fingerprints: Merkle trees over sections, paragraphs and the passages in them.

A text is split at newlines into paragraphs; a section is a run of paragraphs
that ends at an empty one or at one whose digest says so, so that an edit
moves no boundary far from itself. A paragraph is cut into passages at
sentence ends and at words chosen by their hash. A paragraph's digest is taken
over its bytes, a section's over its paragraphs' digests, the root over the
sections', so roots are equal for equal texts and only for them (128 bits).

A fingerprint is `root|section:paragraph-passages.paragraph-passages/section:...`
in hex. `compare` walks two of them from the root and returns the sections and
paragraphs that differ; `likeness` is 1 for equal roots, else the Dice
coefficient of their passages.

Edges: null text is an empty text, whose fingerprint is a root alone; it is
like another empty text (1.0) and nothing else (0.0). In the order of
documents a null doc_id comes last; rows that repeat a doc_id follow each
other by hash and bytes of their texts. An empty table gives no rows; a single
document is its own next one.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, chunks, prefix, read, span_hash, text_or_empty, word_spans

PASSAGE = 6           # words between chosen ends, about
SECTION = 4           # paragraphs between chosen ends, about
_NULL_ID = -(1 << 63)
RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _digest(*parts: bytes) -> bytes:
    h = hashlib.blake2b(digest_size=16)
    for p in parts:
        h.update(p)
    return h.digest()


def trees(texts: list[str]) -> list[tuple[str, np.ndarray]]:
    """Of each text: its fingerprint and its passages' hashes, ascending."""
    out = []
    arr = pa.array(texts, pa.large_string())
    for i, j, buf, off in chunks(arr):
        start, end, _ = word_spans(buf, off)
        c = prefix(buf)
        word = span_hash(c, start, end)
        last = np.isin(buf[end - 1], np.frombuffer(b".!?", np.uint8)) if len(end) else np.zeros(0, bool)
        line = np.concatenate(([0], np.cumsum(buf == 10)))
        if len(end):
            follows = np.ones(len(end), bool)  # the word that ends a line or a text ends a passage
            follows[:-1] = line[start[1:]] != line[end[:-1]]
            follows[:-1] |= np.searchsorted(off, start[1:], "right") != np.searchsorted(off, start[:-1], "right")
            stop = np.flatnonzero(last | follows | (word % np.uint64(PASSAGE) == 0))
            first = np.concatenate(([0], stop[:-1] + 1))
            p_start, p_hash = start[first], span_hash(c, start[first], end[stop])
        else:
            p_start, p_hash = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        hexed = (p_hash & np.uint64(0xFFFFFF)).astype(">u4").tobytes().hex()
        raw = buf.tobytes()
        breaks = np.flatnonzero(buf == 10)
        for r in range(j - i):
            a, b = int(off[r]), int(off[r + 1])
            cut = breaks[np.searchsorted(breaks, a):np.searchsorted(breaks, b)].tolist()
            begin, finish = [a, *[x + 1 for x in cut]], [*cut, b]
            at = np.searchsorted(p_start, [*begin, b]).tolist()
            sections, paras, digests, tops = [], [], [], []
            for k, (s, e) in enumerate(zip(begin, finish)):
                d = _digest(raw[s:e])
                leaves = "".join(hexed[8 * q + 2:8 * q + 8] for q in range(at[k], at[k + 1]))
                paras.append(f"{d.hex()[:8]}-{leaves}")
                digests.append(d)
                if s == e or d[0] % SECTION == 0 or k == len(begin) - 1:
                    top = _digest(b"section", *digests)
                    sections.append(f"{top.hex()[:8]}:" + ".".join(paras))
                    tops.append(top)
                    paras, digests = [], []
            root = _digest(b"root", *tops).hex()
            out.append((root + "|" + "/".join(sections) if a < b else root,
                        np.sort(p_hash[at[0]:at[-1]] & np.uint64(0xFFFFFF))))
    return out


def fingerprint(text: str | None) -> str:
    return trees([text or ""])[0][0]


def _overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Dice coefficient of two ascending multisets."""
    if not len(a) or not len(b):
        return 0.0
    va, na = np.unique(a, return_counts=True)
    vb, nb = np.unique(b, return_counts=True)
    _, x, y = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    return 2 * float(np.minimum(na[x], nb[y]).sum()) / (len(a) + len(b))


def _near(a: tuple[str, np.ndarray], b: tuple[str, np.ndarray]) -> float:
    if a[0][:32] == b[0][:32]:
        return 1.0
    return min(_overlap(a[1], b[1]), 1 - 1e-9)  # 1 is for equal texts alone


def _passages(print_: str) -> np.ndarray:
    leaves = "".join(p.partition("-")[2] for s in print_[33:].split("/") if s for p in s.partition(":")[2].split("."))
    return np.sort(np.array([int(leaves[i:i + 6], 16) for i in range(0, len(leaves), 6)], np.uint64))


def likeness(a: str, b: str) -> float:
    """Of two fingerprints, 0 to 1."""
    return _near((a, _passages(a)), (b, _passages(b)))


def compare(a: str, b: str) -> dict[str, list]:
    """Where two texts differ: positions of the sections and (section, paragraph) pairs of each that the other hasn't got."""
    if a[:32] == b[:32]:
        return {"a_sections": [], "b_sections": [], "a_paragraphs": [], "b_paragraphs": []}
    def parse(f):
        return [(s[:8], [p[:8] for p in s[9:].split(".")]) for s in f[33:].split("/") if s]
    ta, tb, out = parse(a), parse(b), {}
    for name, mine, other in (("a", ta, tb), ("b", tb, ta)):
        have = Counter(s for s, _ in other)
        changed = []
        for k, (s, _) in enumerate(mine):
            have[s] -= 1
            if have[s] < 0:
                changed.append(k)
        there = Counter(p for s, ps in other for p in ps)
        there.subtract(p for k, (s, ps) in enumerate(mine) if k not in changed for p in ps)
        paras = []
        for k in changed:  # only differing branches are entered
            for q, p in enumerate(mine[k][1]):
                there[p] -= 1
                if there[p] < 0:
                    paras.append((k, q))
        out |= {f"{name}_sections": changed, f"{name}_paragraphs": paras}
    return out


def neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, text, bucket, tail: documents dealt into ranges of doc_id, each range sorted
    downwards and followed by the first document of the next range (tail). Texts
    move once. The ranges' bounds and their first ids, one each, are all that the driver sees."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    key = F.coalesce("doc_id", F.lit(_NULL_ID))
    bounds = np.unique(np.array(d.select(F.col("doc_id").cast("double").alias("x")).approxQuantile("x", [k / n for k in range(1, n)], 0.2 / n)
                                or [0.0]).astype(np.int64))

    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        return pd.Series((len(bounds) - np.searchsorted(bounds, ids.to_numpy(), "left")).astype("int32"))  # downwards

    ids = d.select(key.alias("key")).withColumn("bucket", bucket("key"))
    tops = sorted((r["bucket"], r["top"]) for r in ids.groupBy("bucket").agg(F.max("key").alias("top")).collect())
    own = d.withColumns({"key": key, "bucket": bucket(key), "tail": F.lit(False)})
    goes = {top: tops[i - 1][0] for i, (_, top) in enumerate(tops)}  # the first range's top goes to the last: the ring closes
    if goes:
        tail = own.where(F.col("key").isin(list(goes)))
        dest = F.create_map(*[F.lit(x) for kv in goes.items() for x in kv])
        own = own.unionByName(tail.withColumns({"bucket": dest[F.col("key")], "tail": F.lit(True)}))
    return (own.repartitionById(len(bounds) + 1, "bucket")
            .sortWithinPartitions("bucket", "tail", F.desc("key"), F.xxhash64("text"), "text")
            .select("doc_id", "text", "bucket", "tail"))


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (doc_id, text, next text)."""
    edited = [t[:len(t) - len(t) // 3] + n[:len(t) // 3] for _, t, n in rows]
    # consecutive rows share texts: each row's next text is the following row's own
    texts, place = [], []
    for _, t, n in rows:
        if not texts or texts[-1] is not t:
            texts.append(t)
        place.append(len(texts) - 1)
        texts.append(n)
    made = trees(texts + edited)
    own = [made[p] for p in place]
    after = [made[p + 1] for p in place]
    new = made[len(texts):]
    return pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[1]) for r in rows], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]), pa.array([x[0] for x in own]), pa.array([x[0] for x in new]),
        pa.array([_near(a, b) for a, b in zip(own, new)], pa.float64()), pa.array([_near(a, b) for a, b in zip(own, after)], pa.float64()),
    ], [c.split()[0] for c in RESULT.split(", ")])


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text (see RESULT)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, done, size = None, [], 0
        for batch in batches:
            for doc, text, bucket, tail in zip(*(c.to_pylist() for c in batch.columns)):
                if before is not None and before[2] == bucket:
                    done.append((before[0], before[1], text))
                    size += 2 * len(before[1])
                    if size >= CHUNK_BYTES:
                        yield _emit(done)
                        done, size = [], 0
                # of several tail rows (a repeated id) the first is the neighbour
                before = None if tail else (doc, text, bucket)
        if done:
            yield _emit(done)

    return neighbours(docs).mapInArrow(run, RESULT)


def op9(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents."""
    return fingerprint_edits(read(spark, sf_dir, "documents"))
