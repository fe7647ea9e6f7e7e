"""The Merkle manifest against a tree in plain Python."""
import zlib

import pytest
from conftest import SF_SMALL
from helpers import awkward, documents, nothing, sha

from ticklake.llm import manifest
from ticklake.llm.common import read


def plain_tree(digests):
    """Root, and each leaf's (left, right) siblings upwards."""
    paths, groups = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        up, merged = [], []
        for k in range(0, len(digests), 3):
            run = digests[k:k + 3]
            for j in range(len(run)):
                for leaf in groups[k + j]:
                    paths[leaf].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(sha("".join(run)))
            merged.append([i for g in groups[k:k + 3] for i in g])
        digests, groups = up, merged
    return digests[0], paths


def plain_leaf(row, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    for s in by:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"])))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [plain_tree([plain_leaf(r, r["text"]) for r in by[s]]) for s in names]
    root, upper = plain_tree([t[0] for t in trees])
    out = []
    for (subroot, paths), above, s in zip(trees, upper, names):
        for r, path in zip(by[s], paths):
            path = path + above
            flip = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
            node = plain_leaf(r, r["text"].replace("\n", "") if flip and r["text"] is not None else r["text"])
            for left, right in path:
                node = sha(left + node + right)
            out.append((r["doc_id"], plain_leaf(r, r["text"]), subroot, root, sha("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=str)


def manifest_rows(df):
    return sorted(map(tuple, manifest.verify(df).collect()), key=str)


@pytest.mark.parametrize("levels", [manifest.LEVELS, 1, 2])
def test_manifest_equals_plain_tree(spark, monkeypatch, levels):
    """Also with small blocks, so that a source takes several steps."""
    monkeypatch.setattr(manifest, "LEVELS", levels)
    monkeypatch.setattr(manifest, "WIDTH", 3 ** levels)
    docs = documents(spark, [(i, f"text {i}\nof {i % 7}" if i % 5 else None, "big" if i % 4 else f"s{i % 36}") for i in range(70)])
    got = manifest_rows(docs)
    assert got == plain_manifest(docs.collect())
    assert 0 < sum(r[-1] for r in got) < len(got)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_manifest_sizes(spark, n):
    docs = documents(spark, [(i, f"a\n{i}", "s") for i in range(n)])
    assert manifest_rows(docs) == plain_manifest(docs.collect())


def test_op13_on_the_table(spark):
    got = manifest.op13(spark, SF_SMALL)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_manifest(read(spark, SF_SMALL, "documents").collect())


def test_manifest_edges(spark):
    """Null ids and sources, repeated rows, awkward texts, clashing columns."""
    assert manifest_rows(awkward(spark)) == plain_manifest(awkward(spark).collect())
    odd = documents(spark, [(None, "b\n", None), (None, "a\n", None), (None, "a\n", ""), (3, "x\n", "é"), (3, "x\n", "é"), (3, "y\n", "z"), (-5, "\n", "😀")],
                    ("grp", "digest", "pos", "n", "block", "top", "path", "part", "tie"))
    assert manifest_rows(odd) == plain_manifest(odd.collect())
    assert manifest.verify(nothing(spark)).count() == 0


def test_any_change_is_found(spark):
    """A proof folds to the root from its own leaf alone."""
    docs = documents(spark, [(i, f"line one {i}\nline two", f"s{i % 3}") for i in range(40)])
    changed = {i for i in range(40) if zlib.crc32(str(i).encode()) % 2 == 0}
    assert {r[0] for r in manifest_rows(docs) if not r[-1]} == changed
