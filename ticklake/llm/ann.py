"""Approximate nearest neighbours by cosine: a robust-pruned directed graph for each shard, searched by a beam.

Vectors are dealt to shards by a hash of their id. A shard's graph is grown in
batches: a greedy search of the graph so far proposes neighbours for each new
vector, the pruning keeps a candidate unless a kept neighbour is closer to it
by `ALPHA` (so edges point in diverse directions), and the reverse edges are
pruned again where they overflow. What the entry can't reach in the end gets
an edge from the nearest vector that it reaches. A query walks the graph of
every shard with a beam of `SEARCH` vectors (twice the root of the shard's size
where that is more, since a larger graph is searched less of); these are scored
again in double precision on the original vectors and the best of all shards
are the answer.

Every vector is indexed; nothing is sampled. A shard holds 16 sqrt(n) vectors,
2,048 at least and 65,536 at most (17 MB of 64 floats), so the work of all
searches grows with n^1.5 up to 16 million vectors and a task holds one shard
at a time. Queries travel in blocks of `QUERY_BLOCK`; a task searches one shard
for at most `TASK_BLOCKS` of them, streamed. Equal vectors are one node that
carries its k + 1 smallest ids - as many as an answer can need - so a large
group of copies can't fill a graph or a beam.

Edges: vectors that are null, empty, zero or hold null or non-finite
components take no part, neither do null ids; of rows that repeat an id the
smallest vector counts; vectors of different lengths never meet; a query with
fewer candidates than k gets them all, one without any no row; ties go to the
smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import read, saved

DEGREE = 32              # edges that pruning leaves
SLACK = 16               # reverse edges a node takes on before it is pruned again
BUILD, SEARCH = 64, 160  # beams of the build and, at least, of queries
ALPHA = 1.2
STEP = 4                 # nodes of a beam that are expanded at a time
BATCH = 256              # vectors inserted, or queries searched, at a time
SHARD = (2_048, 65_536)
QUERY_BLOCK = 1_024
TASK_BLOCKS = 64
NODE = (1 << 31) - 1
NO_NODE = int(np.float32(np.inf).view(np.int32)) << 32 | 1  # a place of a beam without a node


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaling by a power of two first can't change a digit or overflow."""
    x = x.astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def beam(x: np.ndarray, graph: np.ndarray, entry: int, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search for each query: ids of the `width` nearest nodes met (-1: none) and 1 - cosine, ascending.

    A place of a beam is one number, so that a plain sort keeps it in order: the bits of the distance (0 at least),
    the node, and whether it is expanded."""
    m, n = len(q), len(x)
    seen = np.zeros(m * n, bool)
    held = np.full((m, width), NO_NODE)
    held[:, 0] = _place(np.full(m, entry), 1 - q @ x[entry])
    seen[np.arange(m) * n + entry] = True
    live = np.arange(m)
    while True:
        here = held[live]
        take = here & 1 == 0
        rank = np.cumsum(take, 1, dtype=np.int32)
        some = rank[:, -1] > 0
        if not some.all():
            live, here, take, rank = live[some], here[some], take[some], rank[some]
        if not len(live):
            break
        take &= rank <= STEP
        r, c = np.nonzero(take)
        near = np.full((len(live), STEP, graph.shape[1]), -1, graph.dtype)
        near[r, rank[r, c] - 1] = graph[here[r, c] >> 1 & NODE]
        near = near.reshape(len(live), -1)
        near.sort(1)
        new = near >= 0
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        r, c = np.nonzero(new)
        node = near[r, c].astype(np.int64)
        at = live[r] * n + node
        new = ~seen[at]
        r, node = r[new], node[new]
        seen[at[new]] = True
        far = 1 - np.einsum("ij,ij->i", x.take(node, 0), q.take(live[r], 0))
        here |= take
        place = _place(node, far)
        new = place < here[r, -1]
        r, place = r[new], place[new]
        count = np.bincount(r, minlength=len(live))
        more = np.full((len(live), count.max()), NO_NODE)
        more[r, np.arange(len(r)) - np.repeat(np.cumsum(count) - count, count)] = place
        here = np.concatenate([here, more], 1)
        here.sort(1)
        held[live] = here[:, :width]
    ids, far = (held >> 1 & NODE).astype(int), (held >> 32).astype(np.int32).view(np.float32)
    ids[far == np.inf] = -1
    return ids, far


def _place(node: np.ndarray, far: np.ndarray) -> np.ndarray:
    return np.maximum(far, 0).astype(np.float32).view(np.int32).astype(np.int64) << 32 | node << 1


def prune(x: np.ndarray, p: np.ndarray, cand: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Up to DEGREE neighbours of each p from its candidates (ascending by distance, -1 at the end): a candidate
    goes if a neighbour kept before is ALPHA times closer to it than p is (distances as 1 - cosine, so ALPHA squared)."""
    v = x[cand]
    between = 1 - v @ v.transpose(0, 2, 1)
    alive = (cand >= 0) & (cand != p[:, None])
    keep, n = np.zeros_like(alive), np.zeros(len(p), int)
    for r in range(cand.shape[1]):
        keep[:, r] = alive[:, r] & (n < DEGREE)
        n += keep[:, r]
        alive[:, r + 1:] &= ~(keep[:, r, None] & (ALPHA * ALPHA * between[:, r, r + 1:] <= far[:, r + 1:]))
    out = np.full((len(p), DEGREE), -1)
    rows, cols = np.nonzero(keep)
    out[rows, (np.cumsum(keep, 1) - 1)[rows, cols]] = cand[rows, cols]
    return out


def _add_reverse(x: np.ndarray, graph: np.ndarray, size: np.ndarray, to: np.ndarray, source: np.ndarray) -> None:
    """Edges to -> source; a full node is pruned to make room."""
    room = graph.shape[1]
    while len(to):
        order = np.argsort(to, kind="stable")
        to, source = to[order], source[order]
        _, first, count = np.unique(to, return_index=True, return_counts=True)
        rank = np.arange(len(to)) - np.repeat(first, count)
        fits = rank < room - size[to]
        graph[to[fits], size[to[fits]] + rank[fits]] = source[fits]
        np.add.at(size, to[fits], 1)
        to, source = to[~fits], source[~fits]
        full = np.unique(to)
        if len(full):
            cand = graph[full]
            far = 1 - np.einsum("bcd,bd->bc", x[cand], x[full])
            far[cand < 0] = np.inf
            order = np.argsort(far, 1)
            kept = prune(x, full, np.take_along_axis(cand, order, 1), np.take_along_axis(far, order, 1))
            graph[full] = -1
            graph[full, :DEGREE] = kept
            size[full] = (kept >= 0).sum(1)


def _reached(graph: np.ndarray, entry: int) -> np.ndarray:
    got = np.zeros(len(graph), bool)
    front = np.array([entry])
    while len(front):
        got[front] = True
        front = np.unique(graph[front])
        front = front[front >= 0]
        front = front[~got[front]]
    return got


def build_graph(x: np.ndarray, seed: int = 0) -> tuple[np.ndarray, int]:
    """Neighbours of each unit vector (-1: none), and the node at which searches start."""
    n = len(x)
    graph, size = np.full((n, DEGREE + SLACK), -1, np.int32), np.zeros(n, int)
    order = np.random.default_rng(seed).permutation(n)
    entry, done = int(order[0]), 1
    while done < n:
        p = order[done:done + min(done, BATCH)]
        done += len(p)
        kept = prune(x, p, *beam(x, graph, entry, x[p], BUILD))
        graph[p, :DEGREE], size[p] = kept, (kept >= 0).sum(1)
        r, c = np.nonzero(kept >= 0)
        _add_reverse(x, graph, size, kept[r, c], p[r])
    lost = np.flatnonzero(~_reached(graph, entry))
    while len(lost):
        for lo in range(0, len(lost), BATCH):
            p = lost[lo:lo + BATCH]
            host = beam(x, graph, entry, x[p], BUILD)[0][:, 0]  # met by the search, so reachable
            size = (graph >= 0).sum(1)
            rank = pd.Series(host).groupby(host).cumcount().to_numpy()
            wide = int((size[host] + rank).max()) + 1
            if wide > graph.shape[1]:
                graph = np.concatenate([graph, np.full((n, wide - graph.shape[1]), -1, np.int32)], 1)
            graph[host, size[host] + rank] = p
        lost = np.flatnonzero(~_reached(graph, entry))
    return graph, entry


def search_graph(vecs: np.ndarray, x: np.ndarray, graph: np.ndarray, entry: int, ids: np.ndarray, q_ids: np.ndarray,
                 q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, id, score) of the k best of one shard; `ids` has the smallest ids of each node, filled up with its first."""
    out = []
    for lo in range(0, len(q), BATCH):
        part = unit(q[lo:lo + BATCH])
        node, _ = beam(x, graph, entry, part.astype(np.float32), min(max(SEARCH, int(2 * len(x) ** 0.5)), max(k + 1, len(x))))
        score = np.einsum("mwd,md->mw", unit(vecs[node.ravel()]).reshape(*node.shape, -1), part)
        score[node < 0] = -np.inf
        first = np.where(node >= 0, ids[node, 0], np.iinfo(np.int64).max)
        top = np.lexsort((first, -score))[:, :k + 1]  # the others hold k ids of their own that go before
        node, score = np.take_along_axis(node, top, 1), np.take_along_axis(score, top, 1)
        cand, score = ids[node].reshape(len(part), -1), np.repeat(score, ids.shape[1], 1)
        again = np.zeros_like(ids, bool)
        again[:, 1:] = ids[:, 1:] == ids[:, :1]
        score[again[node].reshape(len(part), -1) | (cand == q_ids[lo:lo + BATCH, None])] = -np.inf
        top = np.lexsort((cand, -score))[:, :k]
        cand, score = np.take_along_axis(cand, top, 1), np.take_along_axis(score, top, 1)
        r, c = np.nonzero(score > -np.inf)
        out.append((r + lo, cand[r, c], score[r, c]))
    return tuple(np.concatenate(t) for t in zip(*out))


def sound_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, vec: one row for each id with a vector of finite components that isn't zero."""
    floats = vectors.schema[vec_col].dataType.simpleString() in ("array<float>", "array<double>")
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), (F.col(vec_col) if floats else F.col(vec_col).cast("array<double>")).alias("vec"))
    sound = (F.forall("vec", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists("vec", lambda e: e != 0))
    v = v.where("vec_id IS NOT NULL AND vec IS NOT NULL").where(F.coalesce(sound, F.lit(False)))
    return v.groupBy("vec_id").agg(F.min(F.transform("vec", lambda e: F.when(e == 0, F.abs(e)).otherwise(e))).alias("vec"))


def _matrix(vecs) -> np.ndarray:
    return np.array([np.asarray(v) for v in vecs])


def _build(key, g: pd.DataFrame) -> pd.DataFrame:
    vecs, ids = _matrix(g["vec"]), [np.asarray(i, np.int64) for i in g["ids"]]
    wide = max(map(len, ids))
    ids = np.array([np.concatenate((i, np.full(wide - len(i), i[0]))) for i in ids])
    graph, entry = build_graph(unit(vecs).astype(np.float32), seed=int(key[1]))
    return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "entry": [entry], "degree": [graph.shape[1]], "wide": [wide],
                         "ids": [ids.tobytes()], "vecs": [vecs.tobytes()], "graph": [graph.astype(np.int32).tobytes()]})


INDEX = "dim int, shard int, entry int, degree int, wide int, ids binary, vecs binary, graph binary"


def build_index(sound: DataFrame, k: int) -> DataFrame:
    """One row for each shard (see INDEX), written to the work folder. Answers hold up to k neighbours."""
    least = Window.partitionBy("vec").orderBy("vec_id")
    classes = saved(sound.withColumn("_r", F.row_number().over(least)).where(F.col("_r") <= k + 1)
                    .groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-classes")
    n = classes.count()
    shards = max(1, round(n / np.clip(16 * n ** 0.5, *SHARD)))
    dealt = classes.select(F.size("vec").alias("dim"), F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).cast("int").alias("shard"), "vec", "ids")
    return saved(dealt.groupBy("dim", "shard").applyInPandas(_build, INDEX), "ann-index")


def _search(k: int):
    """Rows come sorted: a shard, then the query blocks that it is to answer."""
    def run(batches):
        shard = None
        for batch in batches:
            for row in batch.to_pylist():
                here = row["dim"], row["shard"], row["slice"]
                if row["block"] < 0:
                    ids = np.frombuffer(row["ids"], np.int64).reshape(-1, row["wide"])
                    vecs = np.frombuffer(row["vecs"], np.float32 if len(row["vecs"]) == 4 * len(ids) * row["dim"] else np.float64).reshape(-1, row["dim"])
                    shard = here, vecs, unit(vecs).astype(np.float32), np.frombuffer(row["graph"], np.int32).reshape(-1, row["degree"]), row["entry"], ids
                elif shard is not None and shard[0] == here:
                    q_ids = np.frombuffer(row["ids"], np.int64)
                    q = np.frombuffer(row["vecs"], np.float64).reshape(len(q_ids), -1)
                    at, found, score = search_graph(*shard[1:], q_ids, q, k)
                    yield pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])
    return run


def _block(key, g: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "ids": [g["vec_id"].to_numpy(np.int64).tobytes()],
                         "vecs": [_matrix(g["vec"]).astype(np.float64).tobytes()]})


def search_index(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for each row of `queries` (vec_id, vec) against all shards."""
    many, shards = queries.count(), index.agg(F.max("shard")).first()[0]
    blocks = max(1, -(-many // QUERY_BLOCK))
    dealt = queries.select(F.size("vec").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), "vec_id", "vec")
    asked = dealt.groupBy("dim", "block").applyInPandas(_block, "dim int, block int, ids binary, vecs binary")
    asked = asked.select("dim", F.explode(F.sequence(F.lit(0), F.lit(shards or 0))).alias("shard"), F.expr(f"block div {TASK_BLOCKS}").cast("int").alias("slice"),
                         "block", F.lit(0).alias("entry"), F.lit(0).alias("degree"), F.lit(0).alias("wide"), "ids", "vecs", F.lit(b"").alias("graph"))
    held = index.select("dim", "shard", F.explode(F.sequence(F.lit(0), F.lit((blocks - 1) // TASK_BLOCKS))).alias("slice"),
                        F.lit(-1).alias("block"), "entry", "degree", "wide", "ids", "vecs", "graph")
    found = (held.unionByName(asked).repartition("dim", "shard", "slice").sortWithinPartitions("dim", "shard", "slice", "block")
             .mapInArrow(_search(k), "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def nearest(vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", queries=None) -> DataFrame:
    """The k nearest other vectors of each query; `queries`: a condition on vec_id (all by default)."""
    sound = saved(sound_vectors(vectors, id_col, vec_col), "ann-vectors")
    asked = sound if queries is None else sound.where(queries)
    return search_index(build_index(sound, k), asked, k)


def op12(spark, sf_dir: str) -> DataFrame:
    """Of all embeddings those with an id divisible by 50, against all."""
    return nearest(read(spark, sf_dir, "embeddings"), queries=F.col("vec_id") % 50 == 0)
