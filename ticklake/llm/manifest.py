"""Merkle manifest of a dataset: a tree of three-way nodes for each source and one over the sources, by windows.

Leaves are numbered within their source. A node of level l stands in the row
of its first leaf, at a position that 3^l divides, so its run's other nodes
stand at the fixed offsets 3^l and 2 * 3^l: per level one window of lag and
lead columns over (source, block) supplies them, masked by the node's slot in
its run and the run's length; the row of the first child hashes the parent.
Runs never cross a multiple of their size, so windows over blocks of 3^`LEVELS`
rows are exact for `LEVELS` levels, and the blocks' nodes are the rows of the
next step. A source with a third of all rows is thus many blocks; positions
come from a range partitioning and counts of its parts, never from a window
over a whole source. Proofs of the upper steps are joined by block.

A proof is an array of (left, right) sibling digests, leaf upwards; `fold`
recomputes the root from any leaf digest and its proof.

Edges: a null value is `-`; a null source is a source of its own, the first;
null ids come first within their source and are never tampered with; rows that
repeat an id are ordered by leaf (equal rows are interchangeable); a source of
one row has its leaf as subroot, a table of one source that subroot as root,
and where there are no siblings at all the proof is the hash of the empty
string; an empty table gives no rows; other columns are ignored. A text is
held as one string, twice while it is tampered with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import read, saved

LEVELS = 7
WIDTH = 3 ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LINK = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def row_digest(**changed: Column) -> Column:
    """Hash of a row's fields, some of them replaced."""
    return F.sha2(F.concat(*[field(changed.get(c, F.col(c))) for c in FIELDS]), 256)


def tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 2 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """grp (the source, null first in its order), doc_id, digest, changed (the digest of a tampered text, else null)."""
    d = docs.select(*FIELDS)
    broken = F.when(tampered(F.col("doc_id")) & F.col("text").contains("\n"), row_digest(text=F.translate("text", "\n", "")))
    return d.select(F.coalesce(F.concat(F.lit("\x01"), F.col("source").cast("string")), F.lit("")).alias("grp"),
                    F.col("doc_id").cast("long").alias("doc_id"), row_digest().alias("digest"), broken.alias("changed"),
                    F.monotonically_increasing_id().alias("tie"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with pos, from 0 in `order` within their grp, and n, the rows of the grp. The order must tell all rows apart."""
    parts = saved(rows.repartitionByRange("grp", *order).withColumn("part", F.spark_partition_id()), "manifest-ranges")
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (parts.groupBy("grp", "part").agg(F.count("*").alias("here"))  # a row for each part of each grp
              .select("grp", "part", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("start"), F.sum("here").over(Window.partitionBy("grp")).alias("n")))
    inside = F.row_number().over(Window.partitionBy("grp", "part").orderBy(*order))
    return saved(parts.withColumn("inside", inside).join(starts, ["grp", "part"])
                 .withColumn("pos", F.col("start") + F.col("inside") - 1).drop("part", "start", "inside", "tie"), "manifest-positions")


def climb(nodes: DataFrame) -> DataFrame:
    """`LEVELS` levels above the nodes (grp, pos, n, digest): block, path (the proof within the block) and, in a
    block's first row, top (the block's node)."""
    block = Window.partitionBy("grp", "block").orderBy("pos")
    out = nodes.withColumns({"block": F.expr(f"pos div {WIDTH}"), "top": F.col("digest")})
    for level in range(LEVELS):
        step = 3 ** level
        out = out.withColumns({
            "before2": F.lag("top", 2 * step).over(block), "before1": F.lag("top", step).over(block),
            "after1": F.lead("top", step).over(block), "after2": F.lead("top", 2 * step).over(block)})
        slot, many = F.expr(f"(pos div {step}) % 3"), F.expr(f"(n + {step - 1}) div {step}")
        run = F.least(F.lit(3), many - F.expr(f"3 * (pos div {3 * step})"))
        left = F.when(slot == 2, F.concat("before2", "before1")).when(slot == 1, F.col("before1")).otherwise("")
        right = (F.when((slot == 0) & (run == 3), F.concat("after1", "after2"))
                 .when((slot == 0) & (run == 2) | (slot == 1) & (run == 3), F.col("after1")).otherwise(""))
        node = F.col("pos") % step == 0
        out = out.withColumns({
            f"link{level}": F.when(node & (many > 1), F.struct(left.alias("left"), right.alias("right"))),
            "top": F.when(F.col("pos") % (3 * step) == 0, F.when(many > 1, F.sha2(F.concat("top", right), 256)).otherwise(F.col("top")))})
        out = out.drop("before1", "before2", "after1", "after2")
    # every row takes the links of its ancestors, whose rows go before its own
    links = [f"link{level}" for level in range(LEVELS)]
    so_far = block.rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in links})
    return out.withColumn("path", F.filter(F.array(*links), lambda x: x.isNotNull()).cast(LINK)).drop(*links)


def ascend(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The steps of the tree from the numbered nodes upwards, and (grp, root)."""
    most, steps = nodes.agg(F.max("n")).first()[0] or 0, []
    while True:
        steps.append(climb(nodes))
        nodes = saved(steps[-1].where(F.col("pos") % WIDTH == 0).select(
            "grp", F.col("block").alias("pos"), F.expr(f"(n + {WIDTH - 1}) div {WIDTH}").alias("n"), F.col("top").alias("digest")), "manifest-nodes")
        if most <= WIDTH:
            return steps, nodes.select("grp", F.col("digest").alias("root"))
        most = -(-most // WIDTH)


def descend(steps: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first step's rows with their whole path; `above` has a path and further columns for each grp."""
    more = [c for c in above.columns if c not in ("grp", "path")]
    above = above.withColumnRenamed("path", "rest")
    for k, step in enumerate(reversed(steps)):
        # of the last step a grp has one block, of the others every node below hangs from its block
        out = step.join(above, ["grp"] if k == 0 else ["grp", "block"])
        out = out.withColumn("path", F.concat("path", "rest")).drop("rest", "top")
        above = out.select("grp", F.col("pos").alias("block"), F.col("path").alias("rest"), *more)
    return out


def fold(leaf: Column, path: Column) -> Column:
    return F.aggregate(path, leaf, lambda node, link: F.sha2(F.concat(link["left"], node, link["right"]), 256))


def proofs(docs: DataFrame) -> DataFrame:
    """doc_id, source key (grp), leaf, changed, subroot, root, path for each row."""
    steps, subroots = ascend(numbered(saved(leaves(docs), "manifest-leaves"), ["doc_id", "digest", "tie"]))  # texts are read once
    sources = numbered(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("member"), F.col("root").alias("digest")), ["member"])
    upper, root = ascend(sources)
    above = descend(upper, root.withColumn("path", F.array().cast(LINK)))
    above = saved(above.select(F.col("member").alias("grp"), F.col("digest").alias("subroot"), "root", "path"), "manifest-sources")
    return descend(steps, above).select("doc_id", "grp", F.col("digest").alias("leaf"), "changed", "subroot", "root", "path")


def verify(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root (from the tampered leaf where there is one), verified."""
    p = proofs(docs)
    proof = F.sha2(F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), ""), 256)
    p = p.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    return p.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return verify(read(spark, sf_dir, "documents"))


def _sql_field(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"


def _sql_tree(name: str, start: str) -> str:
    """Nodes of all levels; `start`: grp, pos, n, digest of the lowest."""
    return f"""{name}(lvl, grp, pos, n, digest) AS (
    SELECT 0, * FROM ({start})
    UNION ALL
    SELECT lvl + 1, grp, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
    FROM {name} WHERE n > 1 GROUP BY lvl, grp, pos // 3, n)"""


def _sql_links(tree: str, rows: str, shift: str) -> str:
    """Per row and level the digests left and right of the row's ancestor."""
    return f"""SELECT r.id, t.lvl + {shift} AS lvl, coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos < r.pos // (3 ** t.lvl)::BIGINT), '') AS l,
           coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos > r.pos // (3 ** t.lvl)::BIGINT), '') AS r
    FROM {rows} r JOIN {tree} t ON t.grp = r.grp AND t.n > 1 AND t.pos // 3 = r.pos // (3 ** (t.lvl + 1))::BIGINT
    GROUP BY r.id, t.lvl"""


_LEAF = "sha256(" + " || ".join(_sql_field(c) for c in FIELDS) + ")"
OP13_SQL = f"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM (SELECT unnest(range(256))::BIGINT AS i)),
flips AS (
    SELECT doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                                   lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 2 = 0 AS flip
    FROM (SELECT DISTINCT doc_id FROM documents), crc),
leaf AS (
    SELECT row_number() OVER () AS id, coalesce(chr(1) || source, '') AS grp, d.doc_id, {_LEAF.replace("doc_id", "d.doc_id")} AS digest,
           CASE WHEN flip THEN {_LEAF.replace("doc_id", "d.doc_id").replace("text", "replace(text, chr(10), '')")} END AS changed
    FROM documents d LEFT JOIN flips f ON d.doc_id = f.doc_id),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest, id) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM leaf),
{_sql_tree("low", "SELECT grp, pos, n, digest FROM placed")},
subs AS (
    SELECT grp AS id, '' AS grp, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n, digest FROM low WHERE n = 1),
{_sql_tree("high", "SELECT grp, pos, n, digest FROM subs")},
links AS (
    {_sql_links("low", "placed", "0")}
    UNION ALL
    SELECT p.id, u.lvl, u.l, u.r FROM placed p JOIN ({_sql_links("high", "subs", "1000")}) u ON u.id = p.grp),
proof AS (
    SELECT id, sha256(string_agg(l || r, '' ORDER BY lvl)) AS proof, list({{'l': l, 'r': r}} ORDER BY lvl) AS path FROM links GROUP BY id),
done AS (
    SELECT p.doc_id, p.digest AS leaf, s.digest AS subroot, (SELECT digest FROM high WHERE n = 1) AS root,
           coalesce(proof, sha256('')) AS proof_sha256,
           list_reduce(list_prepend({{'l': '', 'r': coalesce(changed, p.digest)}}, coalesce(path, [])),
                       lambda a, x: {{'l': '', 'r': sha256(x.l || a.r || x.r)}}).r AS folded_root
    FROM placed p JOIN subs s ON s.id = p.grp LEFT JOIN proof f ON f.id = p.id)
SELECT *, folded_root = root AS verified FROM done
"""
