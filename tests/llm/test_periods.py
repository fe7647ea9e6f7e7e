"""Periodic runs against their definition."""
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from helpers import WORD, awkward, documents, nothing, sha

from ticklake.llm import periods
from ticklake.llm.common import read


def plain_runs(words):
    """(start, length, period) by comparing every word with every later one."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            size = i - s + q
            if size >= max(12, 2 * q):
                x = words[s:s + size]
                if not any(x[p:] == x[:-p] for p in range(1, q)):
                    out.append((s, size, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def plain_row(doc, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0 and n:
        g = zlib.crc32(str(doc).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (doc, len(runs), *top, None if not runs else 1000 * top[1] // top[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(plain_collapse(words, runs)))


def test_transform_is_exact():
    rng = np.random.default_rng(0)
    for size in (1, 2, 8, 64):
        a = rng.integers(0, periods.PRIME, (size, 5)).astype(np.uint64)
        b = rng.integers(0, periods.PRIME, (size, 5)).astype(np.uint64)
        assert (periods.inverse_ntt(periods.ntt(a.copy())) == a).all()
        got = periods.inverse_ntt(periods._mod(periods.ntt(a.copy()) * periods.ntt(b.copy())))
        for c in range(5):
            x, y = a[:, c].tolist(), b[:, c].tolist()
            assert got[:, c].tolist() == [sum(x[i] * y[k - i] for i in range(size)) % periods.PRIME for k in range(size)]


@pytest.mark.parametrize("room", [periods.ROOM, 8])
def test_runs_equal_brute_force(monkeypatch, room):
    """Random sequences of few and of many symbols, several to a chunk, half of them made periodic."""
    monkeypatch.setattr(periods, "ROOM", room)
    rng = np.random.default_rng(1)
    total = 0
    for _ in range(120):
        seq, want, symbols, off, longest = [], [], 0, 0, 0
        for _ in range(int(rng.integers(1, 5))):
            n = int(rng.integers(0, 100))
            x = rng.integers(0, int(rng.choice([1, 2, 3, 5, 50])), n)
            if rng.random() < 0.6 and n:
                a = int(rng.integers(0, n))
                x = x[np.where(np.arange(n) < a, np.arange(n), a + (np.arange(n) - a) % (1 + (n - a) // int(rng.integers(2, 9))))]
            known, x = np.unique(x, return_inverse=True)
            want += [(s + off, size, q) for s, size, q in plain_runs(x.tolist())]
            seq.append(x + symbols)
            symbols, off, longest = symbols + len(known), off + n, max(longest, n)
        assert [tuple(r) for r in periods.find_runs(np.concatenate(seq).astype(np.int64), longest).tolist()] == want
        total += len(want)
    assert total > 100


def test_many_nested_runs():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    for x in (b, [0] * 300, [0, 0, 1] * 90 + [2] + [0, 0, 1] * 90):
        assert [tuple(r) for r in periods.find_runs(np.array(x), len(x)).tolist()] == plain_runs(x)


def test_long_periodic_text():
    """A period of thousands of words, and a text without one."""
    rng = np.random.default_rng(2)
    x = np.concatenate((rng.integers(0, 20_000, 5_003), np.tile(rng.integers(0, 20_000, 7_001), 5), rng.integers(0, 20_000, 900)))
    x = np.unique(x, return_inverse=True)[1]
    runs = [r for r in periods.find_runs(x, len(x)).tolist() if r[2] > 100]
    assert len(runs) == 1 and runs[0][2] == 7_001 and 35_005 <= runs[0][1] <= 35_020


def test_op11_on_the_table(spark):
    want = {plain_row(r["doc_id"], r["text"]) for r in read(spark, SF_SMALL, "documents").collect()}
    got = periods.op11(spark, SF_SMALL).collect()
    assert {tuple(r) for r in got} == want and len(got) == 200
    assert got[0].asDict().keys() == {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"}
    assert sum(r[1] > 0 for r in want) > 10


def test_period_edges(spark):
    got = {(r["doc_id"], r["collapsed"]): r["runs"] for r in periods.periodic_runs(awkward(spark)).collect()}
    assert len(got) == 10  # the repeated row of id 4 gives the same twice
    assert got[2, ""] == [] and got[3, ""] == [] and got[6, ""] == [] and got[5, "one"] == []
    long = " ".join(f"word{i}" for i in range(977))
    assert got[4, long] == [(0, 20_000, 977)]
    assert got[7, "é\u2028ü 漢字 😀 x"] == [] and got[None, "a b c d e f g h. i j k l m n o q"] == []
    assert periods.periodic_runs(nothing(spark)).count() == 0 and periods.repeated(nothing(spark)).count() == 0
    texts = [(i, t, "s") for i, t in enumerate(["a " * 11, "a " * 12, "\x0ba\x0cb" * 6, "x a b a b a b a b a b a b y", "A a " * 6, "  " * 12, "a b " * 12])]
    d = documents(spark, texts)
    for r in periods.periodic_runs(d).collect():
        words = WORD.findall(texts[r["doc_id"]][1])
        assert [tuple(x) for x in r["runs"]] == plain_runs(words) and r["collapsed"] == plain_collapse(words, plain_runs(words))


def test_words_in_pieces(monkeypatch):
    monkeypatch.setattr(periods, "PIECE", 7)
    raw = " a bb ccc\n\ndddd eeeeeeeeeeeeeeeeee f  ".encode()
    ids, known = periods.encode(raw)
    assert [known[i] for i in ids] == raw.split()
    assert periods.encode(b"")[0].tolist() == []


def test_texts_of_one_chunk_stay_apart():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(["a b c " * 3, "a b c " * 3, "a b c " * 4])], ["doc_id", "text"])
    out = next(periods._collapse([batch])).to_pylist()
    assert [len(r["runs"]) for r in out] == [0, 0, 1] and out[2]["collapsed"] == b"a b c"
