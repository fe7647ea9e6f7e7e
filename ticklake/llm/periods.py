"""Periodic runs of words: block convolutions at dyadic scales, their distances extended to maximal runs.

A run is a maximal stretch of words of smallest period q and a length of
max(12, 2q) at least. For scale B = 1, 2, 4, ... the words are cut into blocks
of B. A run of period q in [2B - 1, 4B - 2] holds a whole block among its first
q words, and that block occurs again q words on. So each block is compared with
the 2B windows at these distances: the sums of squared differences of word
numbers come from a number-theoretic transform of length 4B, exactly (modulo a
prime, under which no true zero is lost), and where a sum is zero the distance
is a seed. Seeds are extended to both sides by comparing words, which also
refuses zeros that only the modulus made. Scales and distances ascend, so a
multiple of the period of a run that is known already is recognised.

A block is not transformed if one of its words doesn't occur within the window
of distances (then no sum can be zero) or if it lies with its whole window in a
run of period B or less (then all zeros are multiples of that period). Texts of
about `SEQUENCE_BYTES` share one sequence, with word numbers of their own, so no
match crosses a text; a longer text is a chunk of its own. Work is of order
n log^2 n for the n words that are transformed. Memory is about 60 bytes a word
beside the text and its distinct words, and at the largest scales as much again
for a transform; the prime allows texts of up to 2^28 words.

Edges: null, empty and blank texts have no runs and collapse to nothing; words
are compared by their bytes; each row is a text of its own, also where it
repeats a doc_id or has none; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, chunks, read, text_or_empty

LEAST = 12               # words of a run
PRIME = 15 * 2**27 + 1   # 31 generates its units
ROOT = 31
ROOM = 1 << 18           # numbers of a batch of transforms
SEQUENCE_BYTES = 1 << 21  # of texts that are searched as one sequence
PIECE = 1 << 20          # bytes that are split into words at a time
FEW = 16                 # words that seeds are extended by together
RUNS = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _mod(x: np.ndarray) -> np.ndarray:
    return x - x // np.uint64(PRIME) * np.uint64(PRIME)


@cache
def _twiddles(n: int, inverse: bool) -> np.ndarray:
    """Powers 0 .. n/2 - 1 of a root of unity of order n, as a column."""
    w = pow(ROOT, (PRIME - 1) // n, PRIME)
    w = pow(w, -1, PRIME) if inverse else w
    out = np.ones(1, np.uint64)
    while len(out) < n // 2:
        out = np.concatenate((out, _mod(out * np.uint64(pow(w, len(out), PRIME)))))
    return out[:max(1, n // 2), None]


def ntt(a: np.ndarray) -> np.ndarray:
    """Transform of each column (a power of two of rows, below PRIME), in bit-reversed order; overwrites a."""
    n, cols = a.shape
    size = n
    while size > 1:
        x = a.reshape(n // size, size, cols)
        u, v = x[:, :size // 2], x[:, size // 2:]
        apart = _mod((u + np.uint64(PRIME) - v) * _twiddles(size, False))
        u += v
        u -= np.where(u >= PRIME, np.uint64(PRIME), np.uint64(0))
        v[...] = apart
        size //= 2
    return a


def inverse_ntt(a: np.ndarray) -> np.ndarray:
    """From bit-reversed order back; overwrites a."""
    n, cols = a.shape
    size = 2
    while size <= n:
        x = a.reshape(n // size, size, cols)
        u, v = x[:, :size // 2], x[:, size // 2:]
        w = _mod(v * _twiddles(size, True))
        v[...] = u + np.uint64(PRIME) - w
        v -= np.where(v >= PRIME, np.uint64(PRIME), np.uint64(0))
        u += w
        u -= np.where(u >= PRIME, np.uint64(PRIME), np.uint64(0))
        size *= 2
    return _mod(a * np.uint64(pow(n, -1, PRIME)))


def zero_mismatches(words: np.ndarray, blocks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) for distances 2 size - 1 .. 4 size - 2 at which the sum of squared differences is zero
    modulo the prime. `words`: numbers below the last one, which stands behind the end and equals none."""
    end, low = len(words) - 1, 2 * size - 1
    at = np.arange(3 * size - 1)[:, None]
    found = []
    per = max(1, ROOM // (4 * size))
    for lo in range(0, len(blocks), per):
        b = blocks[lo:lo + per]
        p, w = np.zeros((4 * size, len(b)), np.uint64), np.zeros((4 * size, len(b)), np.uint64)
        p[:size] = words[b[None, :] + np.arange(size - 1, -1, -1)[:, None]]  # reversed
        w[:3 * size - 1] = words[np.minimum(b[None, :] + low + at, end)]
        square = np.zeros((3 * size, len(b)), np.uint64)
        np.cumsum(_mod(w[:3 * size - 1] ** 2), 0, out=square[1:])
        own = _mod(p[:size] ** 2).sum(0)
        cross = inverse_ntt(_mod(ntt(p) * ntt(w)))[size - 1:3 * size - 1]
        total = _mod(square[size:] - square[:2 * size] + own) + np.uint64(2 * PRIME) - np.uint64(2) * cross
        d, k = np.nonzero(_mod(total) == 0)
        found.append((b[k], d + low))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _covered(places: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which of the ascending places lie in one of the closed intervals."""
    ok = first <= last
    diff = np.zeros(len(places) + 1, np.int64)
    np.add.at(diff, np.searchsorted(places, first[ok]), 1)
    np.add.at(diff, np.searchsorted(places, last[ok], "right"), -1)
    return np.cumsum(diff)[:-1] > 0


def _recur(words: np.ndarray, keys: np.ndarray, wide: int, gap: np.ndarray, blocks: np.ndarray, size: int) -> np.ndarray:
    """The blocks all of whose words occur again at one of the scale's distances, each at any."""
    low, high, t = 2 * size - 1, 4 * size - 2, 0
    while t < size and len(blocks):
        at = blocks[:, None] + np.arange(t, max(1, min(size, 2 * t)))
        ok = gap[at] <= high
        near = np.flatnonzero(ok.all(1))
        blocks, at = blocks[near], at[near]
        r, c = np.nonzero(gap[at] < low)  # the next occurrence is too near, a later one may not be
        key = words[at[r, c]] * wide + at[r, c]
        hit = np.searchsorted(keys, key + low)
        hit = (hit < len(keys)) & (keys[np.minimum(hit, len(keys) - 1)] <= key + high)
        gone = np.zeros(len(blocks), bool)
        gone[r[~hit]] = True
        blocks = blocks[~gone]
        t = max(1, 2 * t)
    return blocks


def _same(words: np.ndarray, i: int, j: int, way: int) -> int:
    """How many words from i and from j > i on, in one direction, are equal."""
    n, k, size = len(words), 0, 64
    while True:
        m = min(size, n - j - k if way > 0 else i + 1 - k)
        if m <= 0:
            return k
        x = words[i + k:i + k + m] != words[j + k:j + k + m] if way > 0 else (words[i - k - m + 1:i - k + 1] != words[j - k - m + 1:j - k + 1])[::-1]
        if x.any():
            return k + int(x.argmax())
        k, size = k + m, 2 * size


def _hopeful(words: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Seeds whose equal words don't end, within `FEW` words on both sides, before they could be a run."""
    n, total, open_ = len(words), np.zeros(len(b), np.int64), np.zeros(len(b), bool)
    for way in (1, -1):
        live = np.arange(len(b))
        for t in range(FEW):
            i = b[live] + (t if way > 0 else -1 - t)
            j = i + d[live]
            ok = (i >= 0) & (j < n)
            ok[ok] = words[i[ok]] == words[j[ok]]
            live = live[ok]
            total[live] += 1
        open_[live] = True
    return open_ | (total >= np.maximum(d, LEAST - d))


def find_runs(words: np.ndarray, longest: int) -> np.ndarray:
    """Runs (start, length, period) of a sequence of numbers 0 .. len - 1, ascending; no period exceeds longest / 2."""
    n = len(words)
    runs = np.zeros((0, 3), np.int64)
    if longest < LEAST:
        return runs
    order = np.argsort(words, kind="stable")
    wide = 8 * n + 8
    keys = words[order] * wide + order
    gap = np.full(n, 8 * n)
    again = words[order[1:]] == words[order[:-1]]
    gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
    ended = np.append(words, n)  # a number that no word has
    size = 1
    while 2 * size - 1 <= longest // 2:
        blocks = np.arange(0, max(0, n - 3 * size + 2), size)
        known = runs[runs[:, 2] <= size]
        blocks = blocks[~_covered(blocks, known[:, 0], known[:, 0] + known[:, 1] - (5 * size - 2))]
        blocks = _recur(words, keys, wide, gap, blocks, size)
        b, d = zero_mismatches(ended, blocks, size)
        good = _hopeful(words, b, d)
        b, d = b[good], d[good]
        order = np.lexsort((b, d))
        b, d = b[order], d[order]
        cuts = np.append(np.flatnonzero(np.diff(d, prepend=-1)), len(d)).tolist()
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            period, at = int(d[lo]), b[lo:hi]
            part = runs[period % runs[:, 2] == 0]
            at = at[~_covered(at, part[:, 0], part[:, 0] + part[:, 1] - period)]
            k, new = 0, []
            while k < len(at):
                i = int(at[k])
                right = _same(words, i, i + period, 1)
                if right < size:
                    k += 1
                    continue
                left = _same(words, i - 1, i - 1 + period, -1) if i else 0
                if left + right + period >= max(LEAST, 2 * period):
                    new.append((i - left, left + right + period, period))
                k = int(np.searchsorted(at, i + right))
            if new:
                runs = np.concatenate((runs, np.array(new, np.int64)))
        size *= 2
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def encode(raw: bytes) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of a text's words, and the distinct words."""
    known: dict[bytes, int] = {}
    ids, lo = array("q"), 0
    while lo < len(raw):
        cut = _BLANK.search(raw, lo + PIECE)
        hi = cut.start() if cut else len(raw)
        ids.extend([known.setdefault(w, len(known)) for w in raw[lo:hi].split()])
        lo = hi
    return np.array(ids, np.int64), list(known)


def _collapse(batches):
    for batch in batches:
        for i, j, buf, off in chunks(batch.column(1), SEQUENCE_BYTES):
            texts = [encode(buf[a:b].tobytes()) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            size = np.array([len(ids) for ids, _ in texts])
            at = np.concatenate(([0], np.cumsum(size)))
            base = np.concatenate(([0], np.cumsum([len(known) for _, known in texts])))
            words = np.concatenate([ids + lo for (ids, _), lo in zip(texts, base.tolist())])
            runs = find_runs(words, int(size.max()))
            drop = np.zeros(len(words) + 1, np.int64)
            np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
            np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
            keep = np.cumsum(drop)[:-1] == 0
            row = np.searchsorted(at, runs[:, 0], "right") - 1
            spans = pa.StructArray.from_arrays([pa.array(runs[:, 0] - at[row]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(j - i + 1)), pa.int32()), spans)
            left = [b" ".join(map(known.__getitem__, ids[keep[a:b]].tolist())) for (ids, known), a, b in zip(texts, at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lists, pa.array(left, pa.large_binary() if sum(map(len, left)) >> 31 else pa.binary())],
                                             ["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (ascending by start, then period; words are numbered from 0), and collapsed: the words that no run
    holds after its first period, joined by one space. A row for each row."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    out = d.mapInArrow(_collapse, RUNS.replace("collapsed string", "collapsed binary"))
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))


def repeated(docs: DataFrame) -> DataFrame:
    """doc_id, text: every tenth text, by a hash of its id, repeats a stretch of its words from some word on to its end.
    A null id leaves its text as it is."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.expr(f"regexp_extract_all(text, '({WORD})', 1)".replace("\\", "\\\\"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    d = d.withColumn("w", F.when(F.coalesce(h % 10 == 0, F.lit(False)), words))
    d = d.withColumn("n", F.size("w")).withColumn("a", F.expr("CASE WHEN n > 0 THEN (crc32(cast(doc_id AS string)) div 10) % n END"))
    d = d.withColumn("p", F.expr("1 + (n - a) div (3 + (crc32(cast(doc_id AS string)) div 10) % 8)"))
    again = F.expr("array_join(transform(sequence(0, n - 1), i -> w[cast(if(i < a, i, a + (i - a) % p) AS int)]), ' ')")
    return d.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


def op11(spark, sf_dir: str) -> DataFrame:
    """Runs of all documents, every tenth of them made periodic."""
    r = periodic_runs(repeated(read(spark, sf_dir, "documents")))
    r = r.withColumn("top", F.array_max(F.transform("runs", lambda x: F.struct(x["length"], -x["start"], -x["period"]))))
    r = r.select("doc_id", "runs", "collapsed", (-F.col("top.col2")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.col3")).alias("period"))
    lines = F.array_join(F.transform("runs", lambda x: F.concat(x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","),
                                                               x["period"].cast("string"), F.lit("\n"))), "")
    return r.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period",
                    F.expr("1000 * length div period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256"))
