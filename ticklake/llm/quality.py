"""Quality classifier: a factorisation machine over hashed words, statistics of the text and numeric metadata.

The score is w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j, with the pair
sum taken in linear time as half of (square of sum - sum of squares) in each
of `RANK` dimensions, then a logistic function. Features are computed and
scored where the documents are; only a bounded sample of labelled rows
(`SAMPLE` at most, in a seeded order) goes to the driver, which fits the model.

Edges: null text is an empty text and gets a score; labels that are null are
ignored, rows that repeat a label agree by their mean; without labels of both
kinds every score is the share of label 1 (1.0 when there is none, so nothing
is rejected); an empty table gives no rows. Metadata (`META`) that is null, not
finite or whose column is missing counts as unknown, an input of its own. Of
rows that repeat a labelled doc_id the first text in order is learnt from; a
null doc_id is never learnt from and so counts as held out. A text is held
with about 60 bytes a character beside it while it is read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, few, lower_ascii, mix, read, text_or_empty, word_hashes, word_spans

BUCKETS = 2048        # hashed words
RANK = 8
SAMPLE = 6_000        # labelled rows the model is fitted on, at most
FOLDS = 5             # fold 0 by crc32 of the id is held out
THRESHOLD = 0.3
EPOCHS, BATCH, RATE, DECAY = 8, 64, 0.02, 1e-4
STATS = ("chars", "words", "mean_word", "longest_word", "letters", "upper", "digits", "marks", "space", "lines",
         "wide", "distinct", "commonest", "short_lines", "word_marks", "stops", "pipes", "repeat_bytes")

META = ("n_chars",)   # numeric columns beside the text

_KIND = np.zeros(256, np.int64)  # 0 other, 1 lower, 2 upper, 3 digit, 4 mark, 5 space, 6 beyond ASCII
_KIND[33:127] = 4
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 6
_KIND[[9, 10, 11, 12, 13, 32]] = 5


def features(arr: pa.Array, meta: list[pa.Array]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Of each text: hashed words (bucket, weight; unit length), and the statistics and metadata as one row."""
    bags, stats = text_features(arr)
    extra = []
    for column in meta:
        x = column.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
        known = np.isfinite(x)
        x = np.where(known, x, 0.0)
        extra += [np.sign(x) * np.log1p(np.abs(x)), known.astype(float)]
    return bags, np.column_stack([stats, *extra]) if extra else stats


def text_features(arr: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    bags, stats = [], []
    for i, j, buf, off in chunks(arr):
        low = lower_ascii(buf)
        h, at = word_hashes(low, off)
        start, end, _ = word_spans(buf, off)
        bucket = (mix(h) >> np.uint64(40)).astype(np.int64) % BUCKETS
        kind, width = _KIND[buf], end - start
        last_mark = (kind[end - 1] == 4) if len(end) else np.zeros(0, bool)
        wide_mark = last_mark & np.concatenate(([False], kind[end[1:] - 2] == 4)) if len(end) else last_mark
        for r in range(j - i):
            a, b, u, v = off[r], off[r + 1], at[r], at[r + 1]
            n, m = b - a, v - u
            count = np.bincount(kind[a:b], minlength=7)
            lines = np.flatnonzero(buf[a:b] == 10)
            bounds = np.diff(np.concatenate(([-1], lines, [n])))
            if m:
                ids, k = np.unique(bucket[u:v], return_counts=True)
                w = np.log1p(k)
                bags.append((ids.astype(np.uint16), (w / np.sqrt((w * w).sum())).astype(np.float32)))
                _, words = np.unique(h[u:v], return_counts=True)
                shape = (width[u:v].mean(), width[u:v].max(), len(words) / m, words.max() / m, wide_mark[u:v].mean(),
                         last_mark[u:v].mean())
            else:
                bags.append((np.zeros(0, np.uint16), np.zeros(0, np.float32)))
                shape = (0.0,) * 6
            d = max(n, 1)
            stats.append((np.log1p(n), np.log1p(m), shape[0], np.log1p(shape[1]), (count[1] + count[2] + count[6]) / d, count[2] / d,
                          count[3] / d, count[4] / d, count[5] / d, np.log1p(len(lines)), count[6] / d, shape[2], shape[3],
                          (bounds < 30).mean(), shape[4], shape[5], (buf[a:b] == 124).sum() / d,
                          (buf[a + 1:b] == buf[a:b - 1]).sum() / d if n > 1 else 0.0))
    return bags, np.array(stats, np.float64).reshape(-1, len(STATS))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    bias: float
    linear: np.ndarray   # BUCKETS words, then the statistics
    factors: np.ndarray  # the same by RANK

    def score(self, bags: list, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -4, 4)
        w, v, out = self.linear, self.factors, np.zeros(len(bags))
        for r, (ids, x) in enumerate(bags):
            vx = v[ids] * x[:, None]
            vz = v[BUCKETS:] * z[r][:, None]
            s = vx.sum(0) + vz.sum(0)
            q = (vx * vx).sum(0) + (vz * vz).sum(0)
            out[r] = self.bias + w[ids] @ x + w[BUCKETS:] @ z[r] + 0.5 * (s * s - q).sum()
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit(bags: list, stats: np.ndarray, labels: np.ndarray, seed: int = 5) -> Model:
    """Logistic loss, mini-batches, Adam."""
    n, rng = len(labels), np.random.default_rng(seed)
    mean = stats.mean(0) if n else np.zeros(stats.shape[1])
    scale = stats.std(0) + 1e-6 if n else np.ones(stats.shape[1])
    share = labels.mean() if n else 1.0
    width = BUCKETS + stats.shape[1]
    bias = float(np.log((share + 1e-9) / (1 - share + 1e-9)))
    w, v = np.zeros(width), rng.normal(0, 0.02, (width, RANK))
    if not n or share in (0.0, 1.0):
        return Model(mean, scale, bias, w, v * 0)
    z = np.clip((stats - mean) / scale, -4, 4)
    par = [np.array([bias]), w, v]
    m1, m2, t = [p * 0 for p in par], [p * 0 for p in par], 0
    for epoch in range(EPOCHS):
        order = rng.permutation(n)
        for lo in range(0, n, BATCH):
            rows = order[lo:lo + BATCH]
            x = np.zeros((len(rows), width))
            for k, r in enumerate(rows):
                x[k, bags[r][0]] = bags[r][1]
            x[:, BUCKETS:] = z[rows]
            s, x2 = x @ par[2], x * x
            y = par[0][0] + x @ par[1] + 0.5 * (s * s - x2 @ (par[2] ** 2)).sum(1)
            g = (1 / (1 + np.exp(-np.clip(y, -30, 30))) - labels[rows]) / len(rows)
            grad = [np.array([g.sum()]), x.T @ g + DECAY * par[1],
                    x.T @ (g[:, None] * s) - (x2.T @ g)[:, None] * par[2] + DECAY * par[2]]
            t += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k in range(3):
                m1[k] = 0.9 * m1[k] + 0.1 * grad[k]
                m2[k] = 0.999 * m2[k] + 0.001 * grad[k] ** 2
                par[k] = par[k] - rate * (m1[k] / (1 - 0.9 ** t)) / (np.sqrt(m2[k] / (1 - 0.999 ** t)) + 1e-8)
    return Model(mean, scale, float(par[0][0]), par[1], par[2])


def fold(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most `sample` labelled documents outside fold 0, in the order of a hash of their ids."""
    y = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(fold() != 0)
         .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("y"))
         .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # broadcast: `sample` rows at most; a row of each id goes to the driver
    picked = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), *_meta(docs))
              .join(F.broadcast(y), "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct("text", *_names())).alias("d")).select("doc_id", "y", "d.*"))

    def extract(batches):
        for batch in batches:
            bags, stats = features(batch.column(2), batch.columns[3:])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([b.tobytes() for b, _ in bags], pa.binary()),
                 pa.array([x.tobytes() for _, x in bags], pa.binary()), pa.array([s.tobytes() for s in stats], pa.binary())],
                ["doc_id", "y", "ids", "weights", "stats"])

    rows = few(picked, sample, 500).mapInArrow(extract, "doc_id long, y double, ids binary, weights binary, stats binary").collect()
    rows.sort(key=lambda r: r["doc_id"])
    bags = [(np.frombuffer(r["ids"], np.uint16), np.frombuffer(r["weights"], np.float32)) for r in rows]
    stats = np.array([np.frombuffer(r["stats"]) for r in rows]).reshape(-1, len(STATS) + 2 * len(META))
    return fit(bags, stats, np.array([float(r["y"] >= 0.5) for r in rows]))


def _names() -> list[str]:
    return [f"_meta_{c}" for c in META]


def _meta(docs: DataFrame) -> list:
    """The metadata columns as doubles; one that the table lacks is unknown."""
    return [(F.col(c).cast("double") if c in docs.columns else F.lit(None).cast("double")).alias(name) for c, name in zip(META, _names())]


def score_texts(docs: DataFrame, model: Model, keep: tuple = ()) -> DataFrame:
    """doc_id, score, and the columns named in `keep` (as keep_<name>)."""
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("_text"), *_meta(docs),
                       *[F.col(c).alias(f"keep_{c}") for c in keep])
    kinds = ", ".join(f"`keep_{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    first = 2 + len(META)

    def run(batches):
        for batch in batches:
            s = model.score(*features(batch.column(1), batch.columns[2:first]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), *batch.columns[first:]],
                                             ["doc_id", "score", *[f"keep_{c}" for c in keep]])

    return cols.mapInArrow(run, "doc_id long, score double" + (", " + kinds if kinds else ""))


def op8(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    docs = read(spark, sf_dir, "documents")
    model = train(docs, read(spark, sf_dir, "labels"))
    return score_texts(docs, model).select("doc_id", F.coalesce(fold() == 0, F.lit(True)).alias("held_out"), "score",
                                           (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
