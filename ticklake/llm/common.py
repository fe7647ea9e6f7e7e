"""Helpers shared by the operators: tables, written cuts of lineage, and vectorised hashing of UTF-8 columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.session import work_path

WORD = "[^\\x20\\x09-\\x0D]+"  # a word, in Java, Python and RE2 syntax alike
CHUNK_BYTES = 1 << 18          # texts are hashed in chunks of about this size, whose arrays stay in the cache


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write the frame to the shared work folder and read it back: later steps
    restart from these files, not from lineage, when executors are lost."""
    path = work_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


TASK_ROWS = 20_000  # of narrow rows; what a task does with them takes longer than to start it


def few(df: DataFrame, rows: int, each: int = TASK_ROWS) -> DataFrame:
    """The frame, known to have (or come of) about `rows` rows, in a task for each `each` of them and at least one for
    every core, where shuffles would deal it to more: a small step costs little more than to start its tasks and
    write their files. A large frame stays as it is."""
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows // each))
    return df.coalesce(tasks) if tasks < int(spark.conf.get("spark.sql.shuffle.partitions")) else df


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


# ---- hashing ---------------------------------------------------------------

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C55)
_BYTE = np.random.default_rng(0x5EED).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_pow = [np.ones(1, _U), np.ones(1, _U)]  # powers of the base and of its inverse, grown on demand


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow[0]) < n:
        inv = _U(pow(int(_BASE), -1, 2**64))
        size = max(n, CHUNK_BYTES + 1)
        for k, b in enumerate((_BASE, inv)):
            p = np.full(size, b, _U)
            p[0] = 1
            _pow[k] = np.multiply.accumulate(p)
    return _pow[0][:n], _pow[1][:n]


def prefix(buf: np.ndarray) -> np.ndarray:
    """Prefix sums from which `span_hash` gets the hash of any byte range."""
    c = np.zeros(len(buf) + 1, _U)
    np.cumsum(_BYTE[buf] * _powers(len(buf) + 1)[0][:-1], out=c[1:])
    return c


def span_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges [start, end): equal bytes hash equal wherever they stand."""
    inv = _powers(len(c))[1]
    return mix((c[end] - c[start]) * inv[start] + (end - start).astype(_U))


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and the n + 1 offsets of its rows."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if pa.types.is_null(arr.type):
        arr = arr.cast(pa.string())
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off, data = arr.buffers()
    if len(arr) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    off = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def chunks(arr: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole rows of about `limit` bytes."""
    buf, off = utf8(arr)
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, buf[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def word_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and the first word of each row (n + 1 entries)."""
    solid = ~_SPACE[buf]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = off[(off > 0) & (off < len(buf))]
    first[inner] = solid[inner]                       # a row's first byte starts a word of its own
    last = solid.copy()
    last[:-1] &= ~solid[1:] | first[1:]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, off)


def word_hashes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and the first word of each row (n + 1 entries)."""
    s, e, at = word_spans(buf, off)
    return span_hash(prefix(buf), s, e), at


def shingle_hashes(words: np.ndarray, at: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row the distinct hashes of its k-word shingles, ascending; a row of
    fewer words has its whole sequence as the one shingle, a row without words none."""
    g = words[:max(0, len(words) - k + 1)]
    for j in range(1, k):
        g = mix(g * _U(31) + words[j:j + len(g)])
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= k:
            s = np.sort(g[a:b - k + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            h = words[a:a + 1]
            for w in range(a + 1, b):
                h = mix(h * _U(31) + words[w:w + 1])
            out.append(mix(h + _U(b - a)))
        else:
            out.append(np.zeros(0, _U))
    return out


def minima(x: np.ndarray, starts: np.ndarray, flip: np.uint32, mult: np.uint32, room: np.ndarray) -> np.ndarray:
    """The minimum of one hash function over each run of `x` (uint32, well mixed); `room` is scratch of its size."""
    np.bitwise_xor(x, flip, out=room)
    np.multiply(room, mult, out=room)
    return np.minimum.reduceat(room, starts)


def hash_functions(count: int, seed: int) -> np.ndarray:
    """Pairs (flip, odd multiplier) of 32 bits."""
    return np.random.default_rng(seed).integers(0, 2**32, (count, 2), dtype=np.uint32) | np.array([0, 1], np.uint32)


def minhashes(sets: list[np.ndarray], count: int, seed: int = 7) -> np.ndarray:
    """`count` minimum hashes of each non-empty set, as uint32 columns (rows: sets)."""
    size = np.array([len(s) for s in sets])
    out = np.zeros((len(sets), count), np.uint32)
    full = np.flatnonzero(size)
    if len(full):
        x = (np.concatenate([sets[i] for i in full]) >> _U(32)).astype(np.uint32)
        at = np.concatenate(([0], np.cumsum(size[full])[:-1]))
        room = np.empty_like(x)
        for p, (flip, mult) in enumerate(hash_functions(count, seed)):
            out[full, p] = minima(x, at, flip, mult, room)
    return out
