"""Graph search against brute force."""
import numpy as np
import pytest
from conftest import SF_CHECK
from helpers import unit
from pyspark.sql import functions as F

from ticklake.llm import ann
from ticklake.llm.common import read


def plain_nearest(ids, x, queries, k=5):
    """(query, rank) -> (id, score), ties to the smaller id; in Python's own sums."""
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in queries:
        s = u @ u[q]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:k]
        out |= {(int(ids[q]), r + 1): (int(ids[i]), float(s[i])) for r, i in enumerate(order)}
    return out


def answers(df):
    return {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in df.collect()}


def recall(got, want):
    ids = {q for q, _ in want}
    hit = sum(len({want[k][0] for k in want if k[0] == q} & {got[k][0] for k in got if k[0] == q}) for q in ids)
    return hit / len(want)


def vectors(spark, x, ids=None, kind="float"):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [None if e is None else float(e) for e in v], "a", 1) for i, v in zip(ids, x)],
                                 f"vec_id long, embedding array<{kind}>, shard string, ids int")


def test_op12_on_the_table(spark):
    rows = read(spark, SF_CHECK, "embeddings").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    want = plain_nearest(ids, x, np.flatnonzero(ids % 50 == 0))
    df = ann.op12(spark, SF_CHECK)
    assert [f"{n} {t}" for n, t in df.dtypes] == ["query_id bigint", "rank int", "vec_id bigint", "score double"]
    got = answers(df)
    assert got.keys() == want.keys() and recall(got, want) >= 0.99
    assert all(abs(got[k][1] - want[k][1]) < 1e-12 for k in want if got[k][0] == want[k][0])


@pytest.mark.parametrize("kind", ["random", "clusters"])
def test_recall_over_shards(spark, monkeypatch, kind):
    """Vectors without structure, the hardest for a graph, and tight clusters; several shards, narrow blocks."""
    monkeypatch.setattr(ann, "SHARD", (1_500, 1_500))
    monkeypatch.setattr(ann, "QUERY_BLOCK", 20)
    monkeypatch.setattr(ann, "TASK_BLOCKS", 2)
    rng = np.random.default_rng(5)
    x = unit(rng, 6_000, 48) if kind == "random" else np.repeat(unit(rng, 60, 48), 100, 0) + rng.normal(scale=0.02, size=(6_000, 48))
    x = x.astype("float32").astype(float)
    want = plain_nearest(np.arange(6_000), x, range(0, 6_000, 50))
    got = answers(ann.nearest(vectors(spark, x), queries=F.col("vec_id") % 50 == 0))
    assert got.keys() == want.keys()
    assert recall(got, want) >= 0.97


def test_every_node_is_reached():
    rng = np.random.default_rng(6)
    for x in (unit(rng, 900, 8), np.repeat(unit(rng, 3, 8), 300, 0), np.concatenate([unit(rng, 1, 64) + rng.normal(scale=1e-3, size=(200, 64)) for _ in range(5)])):
        x = ann.unit(x).astype(np.float32)
        graph, entry = ann.build_graph(x)
        assert ann._reached(graph, entry).all()


def test_pruning_keeps_diverse_edges():
    """Of two candidates in one direction the nearer stays; one in another direction stays though it is farther."""
    x = ann.unit(np.array([[1, 0, 0], [1, 0.1, 0], [1, 0.2, 0], [1, 0, 0.4]])).astype(np.float32)
    far = 1 - x[1:] @ x[0]
    assert [n for n in ann.prune(x, np.array([0]), np.array([[1, 2, 3]]), far[None, :])[0] if n >= 0] == [1, 3]


def test_copies_and_ties(spark):
    """A third of all rows are copies of one vector; answers go to their smallest ids, without the query's own."""
    rng = np.random.default_rng(7)
    x = unit(rng, 900, 16)
    x[::3] = x[0]
    ids = rng.permutation(900)
    got = answers(ann.nearest(vectors(spark, x, ids.tolist(), "double"), queries=F.col("vec_id") % 50 == 0))
    want = plain_nearest(ids, x, np.flatnonzero(ids % 50 == 0))
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}


def test_ann_edges(spark):
    nan, inf = float("nan"), float("inf")
    x = [[1, 0], [0, 1], [1, 1], None, [], [0, 0], [nan, 1], [inf, 1], [None, 1], [1, 0, 0], [1, 0, 0], [-1, 0], [1, 0], [2, 1], [0.0, -0.0]]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, None, 11, 12]
    got = answers(ann.nearest(vectors(spark, x, ids, "double"), k=3))
    assert {q for q, _ in got} == {0, 1, 2, 9, 10, 11}  # of id 11 the smaller vector counts
    assert [got[0, r][0] for r in (1, 2, 3)] == [2, 1, 11] and (0, 4) not in got
    assert got[9, 1] == (10, 1.0) and (9, 2) not in got
    assert got[11, 3][0] == 0 and got[11, 3][1] == -1.0
    huge = answers(ann.nearest(vectors(spark, [[1e200, 1e200], [1e200, 1.01e200], [1e-200, 1e-200], [3, 3]], kind="double"), k=3))
    assert [huge[0, r][0] for r in (1, 2, 3)] == [2, 3, 1] and abs(huge[0, 3][1] - 0.9999876) < 1e-6
    assert ann.nearest(vectors(spark, [[1.0, 2.0]])).count() == 0
    assert ann.nearest(vectors(spark, [[1.0]]).limit(0)).count() == 0


def plain_beam(x, graph, entry, q, width):
    """Expand the STEP nearest nodes of the beam that aren't yet, until none is left; one query, plain Python."""
    far = lambda n: max(0.0, float(np.float32(1) - np.einsum("ij,ij->i", x[n:n + 1], q[None])[0]))
    held, seen, expanded = [(far(entry), entry)], {entry}, set()
    while todo := [n for _, n in held if n not in expanded][:ann.STEP]:
        expanded |= set(todo)
        new = {int(n) for t in todo for n in graph[t] if n >= 0} - seen
        seen |= new
        held = sorted(held + [(far(n), n) for n in new])[:width]
    return [n for _, n in held]


def test_beams_of_sorted_numbers():
    """Many queries at once meet what one meets alone, also with fewer nodes than places; edges take 4 bytes each."""
    rng = np.random.default_rng(8)
    for n, width in ((700, 40), (30, 50)):
        x = ann.unit(rng.normal(size=(n, 16))).astype(np.float32)
        graph, entry = ann.build_graph(x)
        assert graph.dtype == np.int32
        q = np.concatenate([x[:5], ann.unit(rng.normal(size=(20, 16))).astype(np.float32)])
        ids, far = ann.beam(x, graph, entry, q, width)
        for i, row in enumerate(ids):
            assert row[row >= 0].tolist() == plain_beam(x, graph, entry, q[i], width)
        assert (ids < 0).sum() == (far == np.inf).sum() == (0 if n > width else len(q) * (width - n)) and (np.diff(far[:, :min(n, width)]) >= 0).all()
