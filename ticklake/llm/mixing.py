"""Mixing sources to target weights by minimum-cost flow.

Documents may belong to several sources. They are aggregated by membership
pattern (the set of their sources); token capacity flows from patterns to
source quotas, each further repetition of a pattern costing more than the one
before (convex), so text is repeated only where a quota needs it. Every
pattern then selects its share in a seeded order of documents: each document
as often as the whole repetitions say, and those first in order once more.

Only the aggregate by pattern (one row for each distinct set of sources, not
for each document) reaches the driver, and the plan made of it is broadcast;
both are bounded by `MAX_PATTERNS` rows (some 20 MB), beyond which the call
fails before anything is collected: sources are corpora, not hosts. The order within a pattern is cut into
`BINS` ranges of a hash; running sums are taken per range, so no source is
ever sorted in one task.

Edges: null text has size 0; a null source is a source of its own, last in
order; an empty table gives an empty mix; repeated rows are documents of their
own (ties in the seeded order break by doc_id, text, then by arrival); zero-size documents take 0 words.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, read, saved, text_or_empty

WEIGHTS = (5, 2, 1)   # repeating, over the sources in order
SHARE = 1.5           # words of the mix against words of the corpus
MAX_REPEAT = 2        # copies of a document, at most
BINS = 4096           # hash ranges a pattern is cut into
MAX_PATTERNS = 100_000  # distinct sets of sources
SEED = 11


def reshare(sizes: list[int], weights: list[float], total: float, most: float = MAX_REPEAT) -> list[float]:
    """Targets proportional to weights, none above `most` times its size; the excess is shared again by weight."""
    target, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while free:
        w = sum(weights[i] for i in free)
        over = {i for i in free if w <= 0 or left * weights[i] / w > most * sizes[i]}
        for i in over or free:
            target[i] = float(most * sizes[i]) if over else left * weights[i] / w
        if not over:
            break
        left -= sum(target[i] for i in over)
        free -= over
    return target


def min_cost_flow(capacity: dict, quota: dict, repeats: int) -> dict:
    """Words each pattern sends to each of its sources: as much of the quotas as
    can be met, at the least cost, where the k-th repetition of a pattern costs k a word.
    Successive shortest paths; the graph has a node for each pattern and source only."""
    pats, srcs = sorted(capacity, key=repr), sorted(quota, key=repr)
    S, T = ("S",), ("T",)
    arcs: list[list] = []  # to, residual, cost; the reverse arc stands at index ^ 1
    out = defaultdict(list)

    def arc(u, v, cap, cost):
        for a, b, c, k in ((u, v, cap, cost), (v, u, 0.0, -cost)):
            out[a].append(len(arcs))
            arcs.append([b, c, k])

    for p in pats:
        for k in range(1, repeats + 1):
            arc(S, ("p", p), float(capacity[p]), k)
        for s in p:
            arc(("p", p), ("s", s), float("inf"), 0)
    for s in srcs:
        arc(("s", s), T, float(quota[s]), 0)
    eps = 1e-9 * max([1.0, *quota.values()])
    while True:
        dist, via, queue = {S: 0}, {}, [S]
        while queue:  # Bellman-Ford by queue; costs are small integers
            nxt = []
            for u in queue:
                for i in out[u]:
                    v, cap, cost = arcs[i]
                    if cap > eps and dist[u] + cost < dist.get(v, float("inf")):
                        dist[v], via[v] = dist[u] + cost, i
                        nxt.append(v)
            queue = list(dict.fromkeys(nxt))
        if T not in dist:
            break
        path, v = [], T
        while v != S:
            path.append(via[v])
            v = arcs[via[v] ^ 1][0]
        push = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= push
            arcs[i ^ 1][1] += push
    flow = {}
    for p in pats:
        for i in out[("p", p)]:
            if arcs[i][0][0] == "s":
                flow[p, arcs[i][0][1]] = arcs[i ^ 1][1]
    return flow


def mix_sources(docs: DataFrame, sources: str = "source", weights: tuple = WEIGHTS, share: float = SHARE,
                max_repeat: int = MAX_REPEAT, seed: int = SEED, keep: tuple = ()) -> DataFrame:
    """doc_id, sources (array), size, source_size, target (both of the document's first source),
    taken, and the columns named in `keep` (as keep_<name>). `sources` is a string or an array column."""
    many = docs.schema[sources].dataType.simpleString().startswith("array")
    member = F.col(sources) if many else F.array(F.col(sources).cast("string"))
    member = F.when(member.isNull() | (F.size(member) == 0), F.array(F.lit(None).cast("string"))).otherwise(F.array_distinct(member))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.array_sort(member).alias("sources"),
                       F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
                       F.xxhash64(F.lit(seed), F.col("doc_id").cast("long")).alias("_order"),
                       F.xxhash64(text_or_empty()).alias("_tie"), *[F.col(c).alias(f"keep_{c}") for c in keep])
    base = base.withColumns({"_pattern": F.to_json(F.struct(F.col("sources").alias("m")), {"ignoreNullFields": "false"}),
                             "_bin": F.pmod(F.shiftright("_order", 20), F.lit(BINS)).cast("int")})
    if not keep:
        base = saved(base, "mix-sizes")
    bins = saved(base.groupBy("_pattern", "_bin").agg(F.first("sources").alias("sources"), F.sum("size").alias("words")), "mix-bins")
    found = [(r["_pattern"], tuple(r["m"]), r["w"]) for r in
             bins.groupBy("_pattern").agg(F.first("sources").alias("m"), F.sum("words").alias("w")).limit(MAX_PATTERNS + 1).collect()]
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} distinct sets of sources; group them before mixing")
    capacity = {m: w for _, m, w in found}
    names = sorted({s for _, m, _ in found for s in m}, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    place = {s: i for i, s in enumerate(names)}
    sizes = {s: 0 for s in names}
    for m, w in capacity.items():
        for s in m:
            sizes[s] += w
    quota = dict(zip(names, reshare([sizes[s] for s in names], [weights[i % len(weights)] for i in range(len(names))],
                                    share * sum(capacity.values()), max_repeat)))
    flow = min_cost_flow(capacity, quota, max_repeat)
    plan = []
    for key, m, w in found:
        f = round(sum(flow[m, s] for s in m))
        whole = min(max_repeat, f // w) if w else 0
        first = min(m, key=place.__getitem__)
        plan.append((key, int(whole), int(f - whole * w) if whole < max_repeat else 0, int(sizes[first]), float(quota[first])))
    plan = docs.sparkSession.createDataFrame(plan, "_pattern string, _whole long, _rest long, source_size long, target double")
    # the bin in which a pattern's further copies end, and the words before it: one row a pattern, as many as came to the driver
    ahead = Window.partitionBy("_pattern").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    ends = (bins.join(F.broadcast(plan), "_pattern").withColumn("_from", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
            .where("_from <= _rest AND _from + words > _rest").select("_pattern", F.col("_bin").alias("_end"), "_from"))
    ends = F.broadcast(saved(plan.join(ends, "_pattern", "left"), "mix-plan"))
    j = base.join(ends, "_pattern")
    out = ["doc_id", "sources", "size", "source_size", "target", "taken", *[f"keep_{c}" for c in keep]]
    cut = F.coalesce(F.col("_bin") == F.col("_end"), F.lit(False))
    whole = j.where(~cut).withColumn("taken", F.col("size") * (F.col("_whole") + F.coalesce(F.col("_bin") < F.col("_end"), F.lit(False)).cast("long")))
    # only this bin, one of BINS, needs an order
    order = Window.partitionBy("_pattern").orderBy("_order", "doc_id", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    part = j.where(cut).withColumn("_at", F.col("_from") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    part = part.withColumn("taken", F.col("size") * F.col("_whole") + F.least("size", F.greatest(F.lit(0), F.col("_rest") - F.col("_at"))))
    return whole.select(*out).unionByName(part.select(*out))


def materialise(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, in the columns of `docs`: a row for each copy taken. A copy taken in part holds
    its first words, joined by blanks, and its n_chars, where there is such a column, is theirs."""
    mixed = mix_sources(docs, keep=tuple(docs.columns), **options).where("taken > 0")
    rest = F.col("taken") % F.col("size")
    mixed = mixed.withColumn("_copy", F.explode(F.expr("sequence(1, CAST(ceil(taken / size) AS int))")))
    partial = (rest > 0) & (F.col("_copy") == F.ceil(F.col("taken") / F.col("size")))
    words = F.slice(F.regexp_extract_all(F.col("keep_text"), F.lit(WORD), F.lit(0)), F.lit(1), rest.cast("int"))
    mixed = mixed.withColumn("keep_text", F.when(partial, F.array_join(words, " ")).otherwise(F.col("keep_text")))
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("keep_n_chars", F.when(partial, F.length("keep_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("keep_n_chars")))
    return mixed.select(*[F.col(f"keep_{c}").alias(c) for c in docs.columns])


def op6(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents, each of one source."""
    return mix_sources(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
