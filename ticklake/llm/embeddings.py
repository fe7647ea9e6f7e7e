"""Near-duplicate vectors: spherical k-means cells, blocked cosine products between those that a link can join.

Equal vectors collapse to one class first. Cells are fitted on a bounded
sample (`SAMPLE` vectors, in the order of a hash); every vector is at home in
the cell of its nearest centre. No link is lost between cells: for unit vectors
x at home in A and y in B with x.y >= t, (x - y).(A - B) <= sqrt(2 - 2t) |A - B|,
and neither x.(A - B) nor y.(B - A) is negative, so one of the two is at most
half the bound. A vector visits each cell that it is so close to, and a cell's
members are compared with each other and with all visitors. The sample thus decides
about work only, never about results.

Cells are dealt to groups of a bounded size (a large cell to several) and each pair of
groups of which one visits the other is one task, so each pair of vectors
meets in one task only. Products are in double precision. Tasks send sums of
links per vector and a spanning forest of the links, never the pairs. Vectors
without close centres, as random ones of many dimensions, visit a large part
of the cells: the work then grows with the square of the table.

Edges: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and are kept; vectors of different lengths never
link; an empty table gives no rows; each row counts as a vector, also when it
repeats another (a null vec_id: no links, component null, kept).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, saved
from .components import components

THRESHOLD = 0.9
SAMPLE = 20_000
PER_CELL = 256        # sampled or counted vectors a cell is meant for
MAX_CELLS = 2048      # the centres that tasks hold
ROUNDS = 8
BLOCK = 512           # rows of a product
GROUP = 1 << 19       # components that a group of cells is meant for
GROUPS = 8            # groups of a table that has fewer components than so many groups hold
SLACK = 1e-9          # for rounding, on the side of more comparisons


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 3) -> np.ndarray:
    """k unit centres of unit vectors: each vector joins the centre of largest cosine, centres are normalised sums."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([(x[i:i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1)
        c = np.where(norm[:, None] > 0, total / np.maximum(norm, 1e-30)[:, None], c)
    return c


def _unit(vectors) -> np.ndarray:
    """Rows of length 1; scaling by a power of two first keeps squares from overflow and from vanishing, and changes no digit."""
    x = np.array(vectors, np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1]) if x.size else x
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_cells(classes: DataFrame, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Centres for each length of vector, from a bounded sample of the classes."""
    n = classes.count()
    rows = classes.select("cls", "vec").orderBy(F.xxhash64("cls"), "cls").limit(sample).collect()
    out = {}
    for d in sorted({len(r["vec"]) for r in rows}):
        x = _unit([r["vec"] for r in rows if len(r["vec"]) == d])
        k = int(np.clip(len(x) / max(1, len(rows)) * n / PER_CELL, 1, min(MAX_CELLS, max(1, len(x) // 8))))
        out[d] = spherical_kmeans(x, k)
    return out


def _homes(centres: dict[int, np.ndarray]):
    def assign(batches):
        for batch in batches:
            vecs = batch.column(2).to_pylist()
            home = np.zeros(len(vecs), np.int32)  # a length that the sample missed: one cell
            for d in {len(v) for v in vecs} & centres.keys():
                rows = [i for i, v in enumerate(vecs) if len(v) == d]
                home[rows] = (_unit([vecs[i] for i in rows]) @ centres[d].T).argmax(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(v) for v in vecs], pa.int32()), pa.array(home)],
                                             ["cls", "many", "vec", "dim", "cell"])
    return assign


def _visits(x: np.ndarray, home: np.ndarray, c: np.ndarray, cells: np.ndarray, threshold: float) -> np.ndarray:
    """Vectors by cells: whether the vector is at home in the cell or so close to it that it visits."""
    half = np.sqrt(max(0.0, 2 - 2 * (threshold - SLACK))) / 2
    out = np.empty((len(x), len(cells)), bool)
    for a in np.unique(home):
        rows = np.flatnonzero(home == a)
        apart = c[a] - c[cells]
        out[rows] = x[rows] @ apart.T <= half * np.linalg.norm(apart, axis=1) + SLACK
    return out


def _centres(centres: dict[int, np.ndarray], d: int) -> np.ndarray:
    return centres[d] if d in centres else np.zeros((1, d))


def _pack(centres: dict[int, np.ndarray], threshold: float):
    """A group as one row: its vectors and their classes as bytes, and the cells its vectors are at home in or visit."""
    def run(key, g: pd.DataFrame) -> pd.DataFrame:
        x, home, c = np.array(g["vec"].tolist(), np.float64), g["cell"].to_numpy(), _centres(centres, key[0])
        with np.errstate(over="ignore"):
            short = x.astype(np.float32)
        seen = _visits(_unit(x), home, c, np.arange(len(c)), threshold).any(0)
        return pd.DataFrame({"dim": [key[0]], "grp": [key[1]], "cls": [g["cls"].to_numpy(np.int64).tobytes()],
                             "many": [g["many"].to_numpy(np.int64).tobytes()], "home": [home.astype(np.int32).tobytes()],
                             "vecs": [(short if (short == x).all() else x).tobytes()],  # floats stay floats
                             "cells": [np.unique(home).tolist()], "visits": [np.flatnonzero(seen).tolist()]})
    return run


def _links(x, hx, y, hy, c, threshold: float, same: bool):
    """Links between x and y (the same vectors: each link once) as arrays of positions, a part at a time."""
    def products(u, hu, v, cells, visits):
        for k, cell in enumerate(cells):
            cols = np.flatnonzero(visits[:, k])
            near, members = v[cols].T, np.flatnonzero(hu == cell)
            for lo in range(0, len(members) if len(cols) else 0, BLOCK):
                rows = members[lo:lo + BLOCK]
                a, b = np.nonzero(u[rows] @ near >= threshold)
                yield rows[a], cols[b]

    cx, cy = np.unique(hx), np.unique(hy)
    to_x = _visits(y, hy, c, cx, threshold)
    for a, b in products(x, hx, y, cx, to_x):
        if same:  # both may visit: the pair counts in the first of their cells
            back = to_x[a, np.searchsorted(cx, hy[b])]
            once = np.where(hx[a] == hy[b], a < b, ~back | (hx[a] < hy[b]))
            a, b = a[once], b[once]
        yield a, b
    if not same:
        for b, a in products(y, hy, x, cy, _visits(x, hx, c, cy, threshold)):
            new = ~to_x[b, np.searchsorted(cx, hx[a])]
            yield a[new], b[new]


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position each position is connected to, links a-b added."""
    while True:
        u, v = root[a], root[b]
        apart = u != v
        if not apart.any():
            return root
        a, b, u, v = a[apart], b[apart], u[apart], v[apart]
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while (root[root] != root).any():
            root = root[root]


def _compare(centres: dict[int, np.ndarray], threshold: float):
    """Links between two groups, or inside one: per class how many vectors it links to, and a forest of the links."""
    def run(key, g: pd.DataFrame) -> pd.DataFrame:
        d = key[0]
        cls, many, home = (np.concatenate([np.frombuffer(v, t) for v in g[k]]) for k, t in (("cls", np.int64), ("many", np.int64), ("home", np.int32)))
        x = np.concatenate([np.frombuffer(v, np.float32 if len(v) == len(w) // 8 * d * 4 else np.float64).astype(np.float64).reshape(-1, d)
                            for v, w in zip(g["vecs"], g["cls"])])
        x = _unit(x)
        cut, same = len(g["cls"].iloc[0]) // 8, len(g) == 1
        second = 0 if same else cut
        count, root = np.zeros(len(cls), np.int64), np.arange(len(cls))
        for a, b in _links(x[:cut], home[:cut], x[second:], home[second:], _centres(centres, d), threshold, same):
            b = b + second
            count += np.bincount(a, many[b], len(cls)).astype(np.int64) + np.bincount(b, many[a], len(cls)).astype(np.int64)
            root = _join(root, a, b)
        hit = count > 0
        return pd.DataFrame({"cls": cls[hit], "links": count[hit], "root": cls[root[hit]]})
    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row."""
    spark: SparkSession = vectors.sparkSession
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    sound = (F.col("vec_id").isNotNull() & F.col("vec").isNotNull()
             & F.coalesce(F.forall("vec", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))), F.lit(False))
             & F.coalesce(F.exists("vec", lambda e: e != 0), F.lit(False)))
    v = v.withColumn("sound", F.coalesce(sound, F.lit(False)))
    # a class is a text of equal components; -0.0 is 0.0
    v = v.withColumn("vec", F.when(F.col("sound"), F.transform("vec", lambda e: e + 0.0)))
    classes = saved(v.where("sound").groupBy("vec").agg(F.min("vec_id").alias("cls"), F.count("*").alias("many")), "classes")
    centres = fit_cells(classes)
    placed = saved(classes.select("cls", "many", "vec").mapInArrow(
        _homes(centres), "cls long, many long, vec array<double>, dim int, cell int"), "cells")
    # cell sizes: one row for each cell, at most lengths x MAX_CELLS
    size = sorted((r["dim"], r["cell"], r["n"]) for r in placed.groupBy("dim", "cell").agg(F.count("*").alias("n")).collect())
    total, before, layout = {}, {}, []
    for d, _, n in size:
        total[d] = total.get(d, 0) + n
    for d, c, n in size:
        room = max(BLOCK, min(total[d] // GROUPS, GROUP // d))
        layout.append((d, c, n, -(-n // room), before.get(d, 0), room))
        before[d] = before.get(d, 0) + n
    layout = F.broadcast(spark.createDataFrame(layout, "dim int, cell int, n long, parts long, before long, room long"))
    part = F.pmod(F.xxhash64("cls"), F.col("parts"))
    dealt = placed.join(layout, ["dim", "cell"]).withColumn(
        "grp", F.floor((F.col("before") + (part + 0.5) * F.col("n") / F.col("parts")) / F.col("room")).cast("int"))
    groups = saved(dealt.select("dim", "grp", "cls", "many", "vec", "cell").groupBy("dim", "grp").applyInPandas(
        _pack(centres, threshold), "dim int, grp int, cls binary, many binary, home binary, vecs binary, cells array<int>, visits array<int>"),
        "vector-groups")
    at_home = groups.select("dim", F.col("grp").alias("host"), F.explode("cells").alias("cell"))
    meet = (groups.select("dim", "grp", F.explode("visits").alias("cell")).join(at_home, ["dim", "cell"])
            .select("dim", F.least("grp", "host").alias("i"), F.greatest("grp", "host").alias("j")).distinct())
    meet = meet.withColumn("grp", F.explode(F.array_distinct(F.array("i", "j"))))
    found = saved(groups.select("dim", "grp", "cls", "many", "home", "vecs").join(meet, ["dim", "grp"]).groupBy("dim", "i", "j")
                  .applyInPandas(_compare(centres, threshold), "cls long, links long, root long"), "vector-links")
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    comp = components(found, "cls", "root")
    per_class = (classes.join(counts, "cls", "left").join(comp.withColumnRenamed("node", "cls"), "cls", "left")
                 .select("vec", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"),
                         F.coalesce("component", "cls").alias("component_id")))
    linked = per_class.where("n_links > 0")
    out = v.join(linked, "vec", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id"),
                      (F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id"))).alias("kept"))


def op2(spark, sf_dir: str) -> DataFrame:
    """All embeddings."""
    return near_duplicates(read(spark, sf_dir, "embeddings"))
