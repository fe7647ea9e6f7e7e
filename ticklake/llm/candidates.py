"""From table keys to verified components, without the pairs of a group.

Items that share a key are candidates. Keys travel as blocks of numbers, dealt
to buckets by their leading bits, and what a task has of one key is combined
before: only its smallest item goes to the key's bucket, so a key of a third of
all items is a few numbers a task. The smallest item of a key is its pivot; items are verified against pivots, and links join them into components.
What then shares a key across components is compared exactly, in blocks: the
members of a group are split into blocks of about `BLOCK`, a task compares two
blocks and returns only the links that join components, each once. A link
inside a component changes nothing, so such pairs are never compared; no link
between components is lost, and no pair is a row.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, saved
from .components import UnionFind, nodes, stars

PAIR_ROWS = 2_000  # pairs or members with payloads that are worth a task
BLOCK = 512
BLOCK_BYTES = 1 << 20  # payloads of a block
SMALL = 48        # members of a group that is compared without preparing it as a whole
READY_BYTES = 1 << 18  # payloads a task keeps ready for further groups, or of small groups that it compares together
SLICE = 256       # rows of a batch that are Python objects at a time


@dataclass
class Evidence:
    """What it takes to compare items. `verify`: from pairs (a, b), and how many they are at most, to those that are links.
    `payload`: (item, payload) for comparisons within a task: `pack(payloads, key)` prepares the members
    of a group (with a key of None: earlier groups don't matter), `matches(packed, a, others, apart)` yields
    those of the positions `others` that may be links of position a, share no earlier group with it and are
    still `apart` from it. For groups of up to `SMALL` members `similar(x, y)` tells it of two payloads made
    ready by `prepare_one`; or `linked(payloads, begin)` gives the positions of all links within many such groups
    at once, whose members lie end to end. `weight`: (item, weight), a payload's bytes. `groups`: from items (item) to
    (key, item), fewer and coarser keys than those of the tables, if there are such."""
    verify: Callable[[DataFrame, int], DataFrame]
    payload: DataFrame
    pack: Callable
    matches: Callable
    weight: DataFrame
    prepare_one: Callable | None = None
    similar: Callable | None = None
    linked: Callable | None = None
    groups: Callable[[DataFrame], DataFrame] | None = None


def with_payload(pairs: DataFrame, payload: DataFrame, item: str, name: str) -> DataFrame:
    """Join (item, payload) to the pairs as `name`. Join b first: a pivot a may have many pairs, whose side of its
    sort-merge join AQE splits."""
    return pairs.join(payload.select(F.col("item").alias(item), F.col("payload").alias(name)), item)


def _labels(links: DataFrame, done: bool) -> DataFrame:
    """(node, component) by links from `stars`, where they aren't stars yet the smallest node that one points to: equal labels
    mean one component, and a component of several labels is only compared more than it need be."""
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")) if done else (
        links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")))


def _with_component(df: DataFrame, comp: DataFrame, item: str, name: str) -> DataFrame:
    """Add the component of `item`; an item without links is its own."""
    c = comp.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    return df.join(c, F.col(item) == F.col("_node"), "left").withColumn(name, F.coalesce("_component", item)).drop("_node", "_component")


def joining_links(ids: np.ndarray, comp: np.ndarray, left: np.ndarray, right: np.ndarray, matches: Callable) -> list[tuple[int, int]]:
    """Links that join components, between the positions `left` and `right`."""
    comp, out = comp.copy(), []
    inside = np.zeros(len(ids), bool)
    inside[right] = True
    # members of small components first: each of them looks for a link to the others
    size = dict(zip(*np.unique(comp, return_counts=True)))
    for a in sorted(left.tolist(), key=lambda i: size[comp[i]]):
        others = np.flatnonzero(inside & (comp != comp[a]))
        if not len(others):
            continue
        for b in matches(a, others, lambda b, a=a: comp[a] != comp[b]):
            out.append((int(ids[a]), int(ids[b])))
            comp[comp == comp[b]] = comp[a]
    return out


def _compare(by: Evidence) -> Callable:
    """The joining links of each group; rows come sorted by key, i and j."""
    pack, matches, prepare_one, similar, linked = by.pack, by.matches, by.prepare_one, by.similar, by.linked

    def small(rows: list[tuple], ready: dict) -> list[tuple[int, int]]:
        comp, out, x = [r[5] for r in rows], [], []
        for r in rows:
            if r[4] not in ready:
                ready[r[4]] = prepare_one(r[6])
            x.append(ready[r[4]])
        for a in range(len(rows)):
            for b in range(a):
                if comp[a] != comp[b] and similar(x[a], x[b]):
                    out.append((rows[a][4], rows[b][4]))
                    old, new = comp[b], comp[a]
                    comp = [new if c == old else c for c in comp]
        return out

    def together(groups: list[list[tuple]]) -> list[tuple[int, int]]:
        rows, joined, out = [r for g in groups for r in g], UnionFind(), []
        for a, b in zip(*linked([r[6] for r in rows], np.cumsum([0, *map(len, groups)]))):
            if joined.find(rows[a][5]) != joined.find(rows[b][5]):
                joined.union(rows[a][5], rows[b][5])
                out.append((rows[a][4], rows[b][4]))
        return out

    def run(batches):
        ready: dict = {}
        waiting: list[list[tuple]] = []
        held = 0
        stream = (r for batch in batches for lo in range(0, batch.num_rows, SLICE)
                  for r in zip(*(c.to_pylist() for c in batch.slice(lo, SLICE).columns)))
        found: list[tuple[int, int]] = []
        for (key, i, j), rows in itertools.groupby(stream, key=lambda r: r[:3]):
            rows = list(rows)
            if len(rows) <= SMALL and i == j and linked:
                waiting.append(rows)
                held += sum(len(r[6]) for r in rows)
                if held > READY_BYTES:
                    found += together(waiting)
                    waiting, held = [], 0
            elif len(rows) <= SMALL and i == j:
                held += sum(len(r[6]) for r in rows if r[4] not in ready)
                found += small(rows, ready)
                if held > READY_BYTES:
                    ready.clear()
                    held = 0
            else:
                block = np.array([r[3] for r in rows])
                packed = pack([r[6] for r in rows], key if len(rows) > SMALL else None)
                found += joining_links(np.array([r[4] for r in rows]), np.array([r[5] for r in rows]), np.flatnonzero(block == i),
                                       np.flatnonzero(block == j), lambda a, others, apart: matches(packed, a, others, apart))
            if len(found) >= 10_000:
                yield _links(found)
                found = []
        yield _links(found + (together(waiting) if waiting else []))
    return run


def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])


PAIRS = 1 << 20        # of a bucket, about
FLUSH = 1 << 19        # pairs that a task combines at a time
MEMBERS = "key long, item long, pivot long"


def _combined(keys: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, ascending (keys unsigned); whether a pair is its key's first; whether the key has several."""
    k, i = np.concatenate(keys), np.concatenate(items)
    order = np.lexsort((i, k))
    k, i = k[order], i[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (i[1:] != i[:-1])
    k, i = k[new], i[new]
    first = np.ones(len(k), bool)
    first[1:] = k[1:] != k[:-1]
    begin = np.flatnonzero(first)
    count = np.diff(np.append(begin, len(k)))
    return k, i, first, np.repeat(count > 1, count)


def _pivots(i: np.ndarray, first: np.ndarray) -> np.ndarray:
    begin = np.flatnonzero(first)
    return np.repeat(i[begin], np.diff(np.append(begin, len(i))))


def _deal(expand: Callable, buckets: int):
    """Blocks of (key, item) for the buckets, one pair of each key; and members of keys that several items here share."""
    def flush(keys, items):
        k, i, first, shared = _combined(keys, items)
        pivot = _pivots(i, first)
        member = np.stack((k.view(np.int64)[shared], i[shared], pivot[shared]))
        own_k, own_i = k[first], i[first]
        bucket = ((own_k >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cut = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        full = np.flatnonzero(np.diff(cut)).tolist()
        pairs = [own_k[cut[b]:cut[b + 1]].tobytes() + own_i[cut[b]:cut[b + 1]].tobytes() for b in full]
        known = [np.ascontiguousarray(member[:, lo:lo + 65_536]) for lo in range(0, member.shape[1], 65_536)]
        place = [int(m[1, 0]) % buckets for m in known]
        return pa.RecordBatch.from_arrays([pa.array(full + place, pa.int32()), pa.array(pairs + [None] * len(known), pa.binary()),
                                           pa.array([None] * len(full) + [m.tobytes() for m in known], pa.binary())], ["bucket", "pairs", "known"])

    def run(batches):
        keys, items, held = [], [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 2_000):
                k, i = expand(batch.slice(lo, 2_000))
                keys.append(k.view(np.uint64))
                items.append(i)
                held += len(k)
                if held >= FLUSH:
                    yield flush(keys, items)
                    keys, items, held = [], [], 0
        if held:
            yield flush(keys, items)
    return run


def _meet(batches):
    """Members of the keys that several items share; rows come sorted by bucket."""
    def emit(k, i, pivot):
        for lo in range(0, len(k), 65_536):
            yield pa.RecordBatch.from_arrays([pa.array(x[lo:lo + 65_536]) for x in (k, i, pivot)], ["key", "item", "pivot"])

    def found(keys, items):
        k, i, first, shared = _combined(keys, items)
        yield from emit(k.view(np.int64)[shared], i[shared], _pivots(i, first)[shared])
        return [k[first]], [i[first]]  # a key's smallest item stands for those that went out

    here, keys, items, held = None, [], [], 0
    for batch in batches:
        # blocks are read where they lie in the batch, not copied into Python objects
        for bucket, pairs, known in zip(batch.column(0).to_pylist(), *(map(lambda x: x.as_buffer(), c) for c in batch.columns[1:])):
            if bucket != here or held > 4 * PAIRS:
                if held:
                    keys, items = yield from found(keys, items)
                if bucket != here:
                    here, keys, items = bucket, [], []
                held = sum(map(len, keys))
            if known is not None:
                yield from emit(*np.frombuffer(known, np.int64).reshape(3, -1))
            if pairs is not None:
                n = len(pairs) // 16
                keys.append(np.frombuffer(pairs, np.uint64, n))
                items.append(np.frombuffer(pairs, np.int64, n, 8 * n))
                held += n
    if held:
        yield from found(keys, items)


def shared_keys(signed: DataFrame, expand: Callable, each: int) -> DataFrame:
    """(key, item, pivot) for every item of every key that several items have, perhaps repeated or with a pivot that is
    another's partner; `expand` makes keys and items (arrays) of rows of `signed`, `each` keys of a row."""
    buckets = max(signed.sparkSession.sparkContext.defaultParallelism, -(-signed.count() * each // (PAIRS // 2)))
    dealt = signed.mapInArrow(_deal(expand, buckets), "bucket int, pairs binary, known binary").repartition(buckets, "bucket")
    return few(dealt, buckets, 1).sortWithinPartitions("bucket").mapInArrow(_meet, MEMBERS)


def connect(signed: DataFrame, expand: Callable, each: int, prepare: Callable[[DataFrame], Evidence], name: str) -> DataFrame:
    """(node, component) over the items (longs) of `signed`, see `shared_keys`. `prepare` gets all items that
    share a key with another, once. Items without a link have no row."""
    members = saved(shared_keys(signed, expand, each), f"{name}-members")
    n = members.count()
    by = prepare(saved(few(members.select("item").distinct(), n), f"{name}-items"))

    # first the smallest pivot of each item, then the others that are still elsewhere; what lies together is only
    # worked out as far as one round goes, until all links are known
    first = few(members.where("pivot < item").groupBy("item").agg(F.min("pivot").alias("a")), n).select("a", F.col("item").alias("b"))
    links = saved(by.verify(first, n), f"{name}-links")
    known = links.count()
    links, done = stars(links, rounds=1, rows=known)

    def more(found: DataFrame, rounds: int | None) -> None:
        nonlocal links, done, known
        found = saved(found, f"{name}-links")
        if new := found.count():
            known += new
            links, done = stars(links.unionByName(found), rounds=rounds, rows=known)

    comp = _labels(links, done)
    pairs = few(members.where("pivot < item").select(F.col("pivot").alias("a"), F.col("item").alias("b")).distinct(), n)
    apart = few(_with_component(pairs, comp, "a", "_ca"), n)
    apart = few(_with_component(apart, comp, "b", "_cb"), n).where("_ca <> _cb").select("a", "b")
    more(by.verify(apart, n), 1)

    # two items were verified directly; in larger groups others than the pivot may link
    placed = few(_with_component(members.select("key", "item"), _labels(links, done), "item", "component"), n)
    split = few(placed.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"), F.count("*").alias("_n")), n).where(
        "_lo < _hi AND _n > 2").select("key")
    active = few(few(placed.join(split, "key"), n).select("item", "component").distinct(), n)
    active = saved(few(active.join(by.weight, "item"), n), f"{name}-active")
    if active.isEmpty():
        return nodes(links if done else stars(links)[0])
    groups = members.select("key", "item") if by.groups is None else by.groups(active.select("item").distinct())
    rows = saved(few(few(groups.join(active, "item"), n).distinct(), n), f"{name}-groups")
    n = rows.count()
    sizes = few(rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("weight").alias("_w"), F.min("component").alias("_lo"), F.max("component").alias("_hi")), n)
    sizes = sizes.where("_lo < _hi").select("key", F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("_w") / BLOCK_BYTES)).cast("int").alias("parts"))
    dealt = few(rows.join(sizes, "key"), n).withColumn("block", F.pmod(F.xxhash64("item"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = few(dealt.join(by.payload, "item"), n).select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                                                          "block", "item", "component", "payload")
    near = few(dealt.repartition("key", "i", "j"), n, PAIR_ROWS).sortWithinPartitions("key", "i", "j", "item").select(
        "key", "i", "j", "block", "item", "component", "payload").mapInArrow(_compare(by), "a long, b long")
    near = saved(few(near.distinct(), n), f"{name}-near")
    more(by.verify(near, near.count()), None)
    return nodes(links if done else stars(links)[0])
