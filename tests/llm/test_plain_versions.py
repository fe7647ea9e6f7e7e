"""The pipeline's stages on their predecessors' rows, the mix's flow and the classifier's inputs, against plain Python."""
import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from helpers import WORD, awkward, documents, nothing, roots, shingles

import corpus_pipeline as P
from ticklake.llm import mixing, packing, quality
from ticklake.llm.common import read, saved


def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def blank(line):
    return not re.search("[^\\x20\\x09-\\x0D]", line)


def similar_pairs(sets, num, den):
    """Index pairs of non-empty sets with a Jaccard similarity of num / den at least."""
    order = sorted((k for k in range(len(sets)) if sets[k]), key=lambda k: len(sets[k]))
    out = []
    for x, a in enumerate(order):
        for b in order[x + 1:]:
            if num * len(sets[b]) > den * len(sets[a]):
                break
            k = len(sets[a] & sets[b])
            if den * k >= num * (len(sets[a]) + len(sets[b]) - k):
                out.append((a, b))
    return out


def plain_line_dedup(docs):
    """{doc_id: text} after fuzzy line dedup: 9-character shingles at 0.8, the first line of a component stays."""
    distinct = sorted({lowered(x) for t in docs.values() for x in t.split("\n") if not blank(x)})
    sets = [{t[i:i + 9] for i in range(max(1, len(t) - 8))} for t in distinct]
    root = roots(range(len(distinct)), similar_pairs(sets, 8, 10))
    place = {t: root[k] for k, t in enumerate(distinct)}
    seen, out = set(), {}
    for i in sorted(docs):
        left = []
        for x in docs[i].split("\n"):
            c = None if blank(x) else place[lowered(x)]
            if c is None or c not in seen:
                left.append(x)
            if c is not None:
                seen.add(c)
        if left == docs[i].split("\n") or any(not blank(x) for x in left):
            out[i] = "\n".join(left)
    return out


def plain_targets(sizes, weights, total):
    """Every source gets weight times one level, at most twice its size: the level by bisection."""
    lo, hi = 0.0, 1e12
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(2 * s, w * mid) for s, w in zip(sizes, weights)) < total else (lo, mid)
    return [min(2 * s, w * lo) for s, w in zip(sizes, weights)]


@pytest.fixture(scope="module")
def stages(spark):
    """The table and what each stage makes of its predecessor's rows."""
    out = [read(spark, SF_SMALL, "documents")]
    for name, stage in P.STAGES:
        out.append(saved(stage(spark, out[-1], SF_SMALL), f"test-{name}"))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] or "" for r in df.collect()}


def test_quality_stage(spark, stages):
    """The model is fitted once more; scores come from the pair sums written out."""
    docs, kept = stages[0], stages[1]
    assert kept.columns == docs.columns
    m = quality.train(docs, read(spark, SF_SMALL, "labels"))
    rows = docs.collect()
    bags, stats = quality.features(pa.array([r["text"] for r in rows], pa.string()), [pa.array([r["n_chars"] for r in rows], pa.int64())])
    want = []
    for r, (ids, x), s in zip(rows, bags, stats):
        z = np.clip((s - m.mean) / m.scale, -4, 4)
        idx, val = np.concatenate((ids, quality.BUCKETS + np.arange(len(z)))), np.concatenate((x, z))
        v = m.factors[idx] * val[:, None]
        y = m.bias + m.linear[idx] @ val + (np.triu(v @ v.T, 1)).sum()
        if 1 / (1 + math.exp(-y)) >= 0.3:
            want.append(r["doc_id"])
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want) and 0 < len(want) < len(rows)


def test_line_stage(stages):
    want, got = plain_line_dedup(texts(stages[1])), texts(stages[2])
    assert stages[2].columns == stages[0].columns
    same = sum(got.get(i) == want.get(i) for i in {*got, *want})
    assert same >= 0.98 * len({*got, *want})  # a link may be missed, with the probability that the module states
    assert sum(map(len, want.values())) <= sum(map(len, got.values())) < sum(map(len, texts(stages[1]).values()))
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect() if r["text"] != texts(stages[1])[r["doc_id"]])


def test_near_duplicate_stage(stages):
    before, got = texts(stages[2]), texts(stages[3])
    ids = sorted(before)
    sets = [shingles(before[i], 5) for i in ids]
    root = roots(range(len(ids)), similar_pairs(sets, 8, 10))
    want = {ids[k] for k in set(root.values())}
    assert want <= set(got) and len(got) <= len(want) + 1
    assert all(got[i] == before[i] for i in got)


def test_mixture_stage(stages):
    before = {r["doc_id"]: r for r in stages[3].collect()}
    size = {i: len(WORD.findall(r["text"] or "")) for i, r in before.items()}
    names = sorted({r["source"] for r in before.values()}, key=lambda s: (s is None, s))
    total = {s: sum(size[i] for i, r in before.items() if r["source"] == s) for s in names}
    target = dict(zip(names, plain_targets([total[s] for s in names], [(5, 2, 1)[k % 3] for k in range(len(names))], 1.5 * sum(total.values()))))
    taken, copies = Counter(), Counter()
    for r in stages[4].collect():
        words = WORD.findall(r["text"] or "")
        own = WORD.findall(before[r["doc_id"]]["text"])
        assert words == own[:len(words)] and words  # a copy, or its first words
        taken[r["source"]] += len(words)
        copies[r["doc_id"]] += len(words)
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    assert all(copies[i] <= 2 * size[i] for i in size)


def test_packing_stage(stages):
    enc = packing.Encoder()
    want = Counter(tuple([*enc(r["text"] or "").tolist(), 1]) for r in stages[4].collect())
    pieces = {}
    for r in stages[5].collect():
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    # copies of a document may share an id: their pieces together hold each copy's ids once
    left = Counter()
    for w, n in want.items():
        left[len(w)] += n * len(w)
    got = Counter()
    for (_, total), parts in pieces.items():
        got[total] += sum(len(ids) for _, ids in parts)
        for start, ids in parts:
            assert any(len(w) == total and list(w[start:start + len(ids)]) == ids for w in want)
    assert got == left


def test_stages_on_awkward_and_empty_tables(spark):
    """Nulls, empty and long texts, repeated rows and clashing names pass every stage; an empty table stays empty."""
    for k, (name, stage) in enumerate(P.STAGES):
        for docs in (awkward(spark), nothing(spark)):
            out = stage(spark, docs, SF_SMALL)
            if k < len(P.STAGES) - 1:
                assert out.columns == docs.columns, name
            n = out.count()
            assert n == 0 if docs.isEmpty() else n > 0, name


def cost_of(capacity, flow, repeats):
    """Words sent, and the cost: the k-th time a pattern's words are used costs k a word."""
    total = cost = 0
    for p, cap in capacity.items():
        f = sum(v for (q, _), v in flow.items() if q == p)
        total += f
        for k in range(1, repeats + 1):
            used = min(max(f - (k - 1) * cap, 0), cap)
            cost += k * used
        assert f <= repeats * cap + 1e-9
    return total, cost


def test_flow_is_the_exhaustive_optimum():
    """All whole-number flows of small graphs: none sends more, and none sends as much for less."""
    rng = np.random.default_rng(3)
    for _ in range(60):
        sources = ["a", "b", "c"][:int(rng.integers(2, 4))]
        patterns = {tuple(sorted(rng.choice(sources, int(rng.integers(1, 3)), replace=False))) for _ in range(3)}
        capacity = {p: int(rng.integers(1, 4)) for p in patterns}
        quota = {s: int(rng.integers(0, 6)) for s in sources}
        arcs = [(p, s) for p in capacity for s in p]
        best = (0, 0)
        for values in itertools.product(*[range(min(2 * capacity[p], quota[s]) + 1) for p, s in arcs]):
            flow = dict(zip(arcs, values))
            if all(sum(v for (_, s), v in flow.items() if s == t) <= quota[t] for t in sources) and all(
                    sum(v for (q, _), v in flow.items() if q == p) <= 2 * capacity[p] for p in capacity):
                total, cost = cost_of(capacity, flow, 2)
                best = max(best, (total, -cost))
        got = mixing.min_cost_flow(capacity, quota, 2)
        total, cost = cost_of(capacity, got, 2)
        assert (round(total, 6), round(-cost, 6)) == best


def test_too_many_sources_fail_early(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 3)
    docs = documents(spark, [(i, "a b c", f"s{i}") for i in range(4)])
    with pytest.raises(ValueError, match="more than 3"):
        mixing.mix_sources(docs)
    assert mixing.mix_sources(docs.where("doc_id < 3")).count() == 3


def test_targets_by_bisection():
    rng = np.random.default_rng(4)
    for _ in range(50):
        sizes = rng.integers(0, 100, int(rng.integers(1, 8))).tolist()
        weights = [(5, 2, 1)[k % 3] for k in range(len(sizes))]
        total = 1.5 * sum(sizes)
        assert mixing.reshare(sizes, weights, total) == pytest.approx(plain_targets(sizes, weights, total), abs=1e-6)


def test_inputs_of_the_classifier():
    """Hashed words have unit length and the weights of their counts; each statistic as its name says."""
    lines = ["The quick fox, the lazy dog.", "", "AAA 123 | x!! é", "one two two three three three"]
    cases = [*lines, "\n".join(lines), None]
    bags, stats = quality.features(pa.array(cases, pa.string()), [pa.array([10, None, 3, float("inf"), -1, 0], pa.float64())])
    for t, (ids, w), row in zip(cases, bags, stats):
        s = dict(zip(quality.STATS, row))
        raw = (t or "").encode()
        words = [x.encode() for x in WORD.findall(lowered(t or ""))]
        count = Counter(words)
        n, m = max(len(raw), 1), len(words)
        assert s["chars"] == pytest.approx(math.log1p(len(raw))) and s["words"] == pytest.approx(math.log1p(m))
        assert s["digits"] == pytest.approx(sum(chr(b).isdigit() for b in raw) / n) and s["wide"] == pytest.approx(sum(b > 127 for b in raw) / n)
        assert s["upper"] == pytest.approx(sum(65 <= b <= 90 for b in raw) / n) and s["pipes"] == pytest.approx(raw.count(b"|") / n)
        assert s["lines"] == pytest.approx(math.log1p(raw.count(b"\n")))
        if m:
            assert s["distinct"] == pytest.approx(len(count) / m) and s["commonest"] == pytest.approx(max(count.values()) / m)
            assert s["mean_word"] == pytest.approx(sum(map(len, words)) / m) and s["longest_word"] == pytest.approx(math.log1p(max(map(len, words))))
            assert float((w.astype(float) ** 2).sum()) == pytest.approx(1, abs=1e-5) and len(ids) <= len(count)
            if len(ids) == len(count):
                weight = np.sort(np.log1p(sorted(count.values())))
                assert np.sort(w) == pytest.approx(weight / np.linalg.norm(weight), abs=1e-5)
        else:
            assert len(ids) == 0 and s["distinct"] == 0
    known = stats[:, -1].tolist()
    assert known == [1, 0, 1, 0, 1, 1] and stats[0, -2] == pytest.approx(math.log1p(10)) and stats[4, -2] == pytest.approx(-math.log1p(1))
