"""MinHash near-dedup of documents with tensored banding.

Two collections of `HALVES` half-keys, `HALF` minimum hashes each, give
HALVES x HALVES table keys by pairing one of either collection: 2 x HALVES x
HALF minimum hashes serve as many tables as HALVES^2 x 2 x HALF would by plain
banding. At a similarity of 0.8 a pair meets in a table with probability
(1 - (1 - 0.8^3)^10)^2 = 0.9985, at 0.85 with 0.9998. Every link is confirmed on
the full sets of shingles.

Documents of equal sets form one class. Candidate classes are compared with
pivots of their tables (see `candidates`), and links join by distributed
union-find.

Edges: null, empty and blank texts have no shingles and link with nothing; a
text of fewer than `k` words is one shingle; a null doc_id links with nothing
(component null, kept); rows that repeat a doc_id are one node; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .candidates import PAIR_ROWS, Evidence, connect, with_payload
from .common import _U, chunks, few, lower_ascii, minhashes, mix, read, saved, shingle_hashes, text_or_empty, word_hashes

HALVES, HALF = 10, 3
COUNT = 2 * HALVES * HALF
NUM, DEN = 80, 100       # a link: DEN * |A and B| >= NUM * |A or B|
ESTIMATE = 0.55          # of the minimum hashes that must agree before sets are fetched: 4 standard deviations below 0.8


def shingle_sets(arr: pa.Array, k: int) -> list[np.ndarray]:
    """Of each text the distinct hashes of its k-word shingles, ascending."""
    out = []
    for _, _, buf, off in chunks(arr):
        out += shingle_hashes(*word_hashes(lower_ascii(buf), off), k)
    return out


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, h1 and h2 (an identity of the set), sig (minimum hashes)."""
    def sign(batches):
        for batch in batches:
            sets = shingle_sets(batch.column(1), k)
            sig = minhashes(sets, COUNT)
            h1 = np.array([s.sum(dtype=_U) for s in sets], _U).view(np.int64) if sets else np.zeros(0, np.int64)
            h2 = np.array([np.bitwise_xor.reduce(mix(s + _U(77))) if len(s) else 0 for s in sets], _U).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(h1), pa.array(h2),
                                              pa.array([r.tobytes() for r in sig], pa.binary())], ["doc_id", "n_shingles", "h1", "h2", "sig"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        sign, "doc_id long, n_shingles long, h1 long, h2 long, sig binary")


def _halves(sigs: list[bytes]) -> np.ndarray:
    """Half-keys of signatures: rows, two collections, HALVES."""
    sig = np.frombuffer(b"".join(sigs), np.uint32).reshape(-1, 2, HALVES, HALF).astype(_U)
    half = np.zeros(sig.shape[:3], _U)
    for r in range(HALF):
        half = mix(half * _U(31) + sig[..., r])
    return mix(half + np.arange(1, 2 * HALVES + 1, dtype=_U).reshape(2, HALVES))  # no two tables share keys


def table_pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Keys and classes of rows of (cls, sig): HALVES^2 keys for each class, one for each pair of half-keys."""
    h = _halves(batch.column(1).to_pylist())
    key = mix(h[:, 0, :, None] * _U(31) + h[:, 1, None, :]).reshape(len(h), -1)
    return key.ravel(), np.repeat(batch.column(0).to_numpy(), key.shape[1])


def half_keys(classes: DataFrame) -> DataFrame:
    """(key, item) by the first collection alone: what shares a table key shares one of these."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                key = np.ascontiguousarray(_halves(part.column(1).to_pylist())[:, 0])
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)),
                                                  pa.array(np.repeat(part.column(0).to_numpy(), HALVES))], ["key", "item"])
    return classes.select("cls", "sig").mapInArrow(run, "key long, item long")


def _pack(payloads: list[bytes], key: int):
    sigs = [p[:4 * COUNT] for p in payloads]
    halves = _halves(sigs)[:, 0].view(np.int64)
    sig = np.frombuffer(b"".join(sigs), np.uint32).reshape(len(payloads), COUNT)
    return sig, halves[:, :int((halves[0] == key).argmax())], [np.frombuffer(p, np.uint32, offset=4 * COUNT) for p in payloads]


def _matches(packed, a: int, others: np.ndarray, apart):
    """Positions that reach the similarity on 32-bit shingle hashes, which never count too little; best estimate first."""
    sig, earlier, sets = packed
    estimate = (sig[others] == sig[a]).mean(1)
    able = (estimate >= ESTIMATE) & ~(earlier[others] == earlier[a]).any(1)
    others, estimate = others[able], estimate[able]
    x = sets[a]
    for b in others[np.argsort(-estimate, kind="stable")].tolist():
        y = sets[b]
        if DEN * min(len(x), len(y)) >= NUM * max(len(x), len(y)) and apart(b):
            both = np.concatenate((x, y))
            both.sort()
            inter = int((both[1:] == both[:-1]).sum())
            if DEN * inter >= NUM * (len(x) + len(y) - inter):
                yield b


def _ready(payload: bytes):
    return np.frombuffer(payload, np.uint32, COUNT), np.frombuffer(payload, np.uint32, offset=4 * COUNT)


def _similar(a, b) -> bool:
    (s, x), (t, y) = a, b
    if DEN * min(len(x), len(y)) < NUM * max(len(x), len(y)) or (s == t).mean() < ESTIMATE:
        return False
    both = np.concatenate((x, y))
    both.sort()
    inter = int((both[1:] == both[:-1]).sum())
    return DEN * inter >= NUM * (len(x) + len(y) - inter)


def _agree(batches):
    """Pairs whose estimated similarity leaves the threshold possible."""
    for b in batches:
        if b.num_rows:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(b.num_rows, -1) for c in (2, 3))
            yield b.filter(pa.array((x == y).mean(1) >= ESTIMATE)).select(["a", "b"])


def _confirm(batches):
    for b in batches:
        a, c = ([np.frombuffer(s, _U) for s in b.column(k).to_pylist()] for k in (2, 3))
        ok = []
        for x, y in zip(a, c):
            inter = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(DEN * inter >= NUM * (len(x) + len(y) - inter))
        yield b.filter(pa.array(ok, pa.bool_())).select(["a", "b"])


def near_duplicates(docs: DataFrame, k: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row."""
    signed = saved(signatures(docs, k), "minhash-signatures")
    n = signed.count()
    classes = saved(few(signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("h1", "h2", "n_shingles")
                        .agg(F.min("doc_id").alias("cls"), F.first("sig").alias("sig")), n), "minhash-classes")

    def prepare(items: DataFrame):
        """Full sets of the classes that share a table key with another; texts are read again for them alone."""
        def expand(batches):
            for batch in batches:
                s = shingle_sets(batch.column(1), k)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in s], pa.binary())], ["cls", "shingles"])
        d = docs.select(F.col("doc_id").cast("long").alias("cls"), text_or_empty().alias("text"))
        items = items.select(F.col("item").alias("cls"))
        sets = saved(few(d.join(items, "cls", "left_semi"), n, PAIR_ROWS).mapInArrow(expand, "cls long, shingles binary"), "minhash-sets")
        met = saved(few(classes.select("cls", "sig", "n_shingles").join(items, "cls", "left_semi"), n), "minhash-met")

        def verify(pairs: DataFrame, rows: int) -> DataFrame:
            short = met.select(F.col("cls").alias("item"), F.struct("sig", "n_shingles").alias("payload"))
            near = few(with_payload(few(with_payload(pairs, short, "b", "y"), rows), short, "a", "x"), rows)
            near = near.where(f"{DEN} * least(x.n_shingles, y.n_shingles) >= {NUM} * greatest(x.n_shingles, y.n_shingles)")
            near = near.select("a", "b", F.col("x.sig").alias("sig_a"), F.col("y.sig").alias("sig_b")).mapInArrow(_agree, "a long, b long")
            full = sets.select(F.col("cls").alias("item"), F.col("shingles").alias("payload"))
            both = few(with_payload(few(with_payload(near, full, "b", "s_b"), rows, PAIR_ROWS), full, "a", "s_a"), rows, PAIR_ROWS)
            return both.select("a", "b", "s_a", "s_b").mapInArrow(_confirm, "a long, b long")

        def shorten(batches):
            """Signature and 32-bit hashes; a document's own hashes that fall together are told apart by nothing, so a
            set may only seem smaller and an intersection larger, never a link be missed."""
            for b in batches:
                out = [g + (np.frombuffer(x, _U) >> _U(32)).astype(np.uint32).tobytes() for g, x in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["item", "payload"])
        payload = few(met.select("cls", "sig").join(sets, "cls"), n, PAIR_ROWS).mapInArrow(shorten, "item long, payload binary")
        weight = met.select(F.col("cls").alias("item"), (4 * F.col("n_shingles")).alias("weight"))

        def groups(active: DataFrame) -> DataFrame:
            return half_keys(few(met.join(active.select(F.col("item").alias("cls")), "cls", "left_semi"), n))
        return Evidence(verify, payload, _pack, _matches, weight, _ready, _similar, groups=groups)

    comp = connect(classes.select("cls", "sig"), table_pairs, HALVES * HALVES, prepare, "minhash")
    linked = few(classes.join(comp, F.col("cls") == F.col("node"), "left"), n).select(
        "h1", "h2", F.col("n_shingles").alias("n"), F.coalesce("component", "cls").alias("component"))
    out = few(signed.join(linked, (signed.h1 == linked.h1) & (signed.h2 == linked.h2) & (F.col("n_shingles") == F.col("n"))
                          & F.col("doc_id").isNotNull(), "left"), n)
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op10(spark, sf_dir: str) -> DataFrame:
    """All documents on two-word shingles."""
    return near_duplicates(read(spark, sf_dir, "documents"), k=2)
