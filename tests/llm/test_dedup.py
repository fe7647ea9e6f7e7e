"""Lines, vectors, substrings and documents against plain versions."""
import hashlib

import numpy as np
import pytest
from conftest import SF_CHECK, SF_SMALL
from helpers import awkward, documents, nothing, roots, shingles, unit
from pyspark.sql import functions as F

from ticklake.llm import components as components_module
from ticklake.llm import embeddings, lines, minhash, suffix
from ticklake.llm.common import read, saved
from ticklake.llm.components import components


def small_texts(spark):
    """Copies, edits and hot passages over a few hundred documents."""
    rng = np.random.default_rng(4)
    vocab = ["".join(rng.choice(list("abcdefghij"), 4)) for _ in range(400)]
    base = [" ".join(rng.choice(vocab, 60)) for _ in range(60)]
    hot = " ".join(rng.choice(vocab, 25))
    rows = []
    for i in range(240):
        w = base[i % 60 if i % 3 else 0].split(" ")
        for _ in range(int(rng.integers(0, 8))):
            w[int(rng.integers(len(w)))] = str(rng.choice(vocab))
        lines_ = [" ".join(w[:30]), " ".join(w[30:])]
        if i % 4 == 0:
            lines_.insert(int(rng.integers(3)), hot)
        rows.append((i * 3, "\n".join(lines_), "s"))
    return documents(spark, rows)


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000, x) for x in range(1001, 1200)] + [(i, i + 1) for i in range(2000, 2080)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs + [(None, 3), (5, 5)], "a long, b long")).collect()}
    nodes = {x for p in pairs for x in p if p[0] != p[1]}
    assert got == roots(nodes, [p for p in pairs if p[0] != p[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture()
def many_parts(spark):
    """Small tables stay in as many parts as shuffles make."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_stars_need_no_round_to_confirm_them(spark, many_parts, monkeypatch):
    written = []
    monkeypatch.setattr(components_module, "saved", lambda df, name: written.append(name) or saved(df, name))
    pairs = [(c * 100, c * 100 + k) for c in range(20) for k in range(1, 30)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == roots({x for p in pairs for x in p}, pairs)
    assert len(written) == 2  # links reduced by each task, one round


def test_unfinished_stars_connect_the_same(spark, many_parts):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (250, 2)) if a != b] + [(i, i + 1) for i in range(2000, 2080)]
    nodes = {x for p in pairs for x in p}
    for rounds in (0, 1):
        links, done = components_module.stars(spark.createDataFrame(pairs, "a long, b long"), rounds=rounds)
        links = [(r["a"], r["b"]) for r in links.collect()]
        assert not done and all(a > b for a, b in links) and roots(nodes, links) == roots(nodes, pairs)


def test_few_links_need_no_rounds(spark, many_parts):
    pairs = [(i, i + 1) for i in range(0, 400)] + [(1000 + i % 7, 1000 + i) for i in range(7, 200)]
    links, done = components_module.stars(spark.createDataFrame(pairs, "a long, b long").repartition(8), rounds=1, rows=len(pairs))
    want = roots({x for p in pairs for x in p}, pairs)
    assert done and {r["a"]: r["b"] for r in links.collect()} == {a: b for a, b in want.items() if a != b}


def test_small_steps_run_in_few_tasks(spark, many_parts, monkeypatch):
    """Over hundreds of partitions, what is known to be small is written by as many tasks as there are cores."""
    from ticklake.llm import candidates
    files = {}

    def counted(df, name, *args):
        out = saved(df, name, *args)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out
    for module in (candidates, components_module, lines, minhash):
        monkeypatch.setattr(module, "saved", counted)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        docs = small_texts(spark)
        sets = {r["doc_id"]: shingles(r["text"], 2) for r in docs.collect()}
        assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, 2).collect()} == roots(sets, links_of(sets))
        lines.fuzzy_lines(docs).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert max(files.values()) <= spark.sparkContext.defaultParallelism, files


def test_minhash_equals_brute_force_in_many_parts(spark, many_parts):
    docs = small_texts(spark)
    sets = {r["doc_id"]: shingles(r["text"], 2) for r in docs.collect()}
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, 2).collect()} == roots(sets, links_of(sets))


def links_of(sets, num=80, den=100):
    out = []
    ids = [i for i in sets if sets[i]]
    for x, a in enumerate(ids):
        for b in ids[:x]:
            k = len(sets[a] & sets[b])
            if den * k >= num * (len(sets[a]) + len(sets[b]) - k):
                out.append((a, b))
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_minhash_equals_brute_force(spark, k):
    docs = small_texts(spark)
    sets = {r["doc_id"]: shingles(r["text"], k) for r in docs.collect()}
    want = roots(sets, links_of(sets))
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs, k).collect()}
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())


def missed_and_false(got, want):
    """Documents of one true component that the result parts, and whether any of its components joins two true ones."""
    true = {}
    false = any(true.setdefault(c, want[i]) != want[i] for i, c in got.items())
    return sum(got[i] != want[i] for i in want), false


def test_op10_on_the_table(spark):
    docs = read(spark, SF_SMALL, "documents").collect()
    sets = {r["doc_id"]: shingles(r["text"], 2) for r in docs}
    want = roots(sets, links_of(sets))
    lost, false = missed_and_false({r["doc_id"]: r["component_id"] for r in minhash.op10(spark, SF_SMALL).collect()}, want)
    assert not false and lost <= 1  # each pair may be missed, with the probability that the module states


def test_minhash_recall_just_above_the_threshold(spark):
    """A thousand planted pairs of a similarity of 0.80 to 0.82, none of them alike: at most a hundredth is missed, nothing
    is linked below the threshold."""
    rng = np.random.default_rng(12)
    rows, close = [], 0
    for p in range(1200):
        words = [f"p{p}w{i}" for i in range(120)]
        other = list(words)
        # 2-word shingles: a changed word costs two of 119 (spread apart), so 6 changed leave 107 / 131 = 0.817, 7 leave 0.79
        for at in rng.choice(np.arange(1, 119, 3), 6 if p % 6 else 7, replace=False):
            other[int(at)] = f"q{p}x{at}"
        rows += [(2 * p, " ".join(words), "s"), (2 * p + 1, " ".join(other), "s")]
        close += p % 6 > 0
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(documents(spark, rows), 2).collect()}
    linked = [p for p in range(1200) if got[2 * p + 1] == 2 * p]
    assert all(p % 6 for p in linked) and len(linked) >= 0.99 * close
    assert all(got[2 * p] == 2 * p and got[2 * p + 1] in (2 * p, 2 * p + 1) for p in range(1200))


def test_minhash_edges(spark):
    got = minhash.near_duplicates(awkward(spark), 2).collect()
    assert len(got) == 11
    by = {(r["doc_id"], r["n_shingles"]): r for r in got}
    assert by[2, 0]["kept"] and by[3, 0]["component_id"] == 3 and by[6, 0]["kept"]
    assert by[8, 15]["component_id"] == 1 and not by[8, 15]["kept"]
    assert by[None, 15]["component_id"] is None and by[None, 15]["kept"]
    assert sum(r["doc_id"] == 4 and r["kept"] for r in got) == 2
    assert minhash.near_duplicates(nothing(spark)).count() == 0


def test_lines_against_brute_force(spark):
    """Components never exceed the true ones, hold at least 98 % of the links, and keep their first line."""
    docs = small_texts(spark).where("doc_id < 450")
    place, text = [], []
    for r in docs.orderBy("doc_id").collect():
        for n, line in enumerate(r["text"].split("\n")):
            place.append((r["doc_id"], n))
            text.append(line.lower())
    links = []
    for a in range(len(text)):
        for b in range(a):
            k, n = lines.jaccard(text[a], text[b])
            if lines.DEN * k >= lines.NUM * n:
                links.append((a, b))
    root = roots(range(len(text)), links)
    got = {(r["doc_id"], r["line_no"]): r for r in lines.fuzzy_lines(docs).collect()}
    assert len(got) == len(text)
    comp = [got[p]["component"] if got[p]["component"] is not None else p for p in place]
    true = {}
    for c, i in zip(comp, range(len(text))):
        assert true.setdefault(c, root[i]) == root[i]
    assert np.mean([comp[a] == comp[b] for a, b in links]) >= 0.98
    first = {}
    for c, p in zip(comp, place):
        assert got[p]["kept"] == (first.setdefault(c, p) == p)


def test_large_line_groups_are_compared_exactly():
    rng = np.random.default_rng(2)
    lost = 0
    for _ in range(10):
        base = ["".join(rng.choice(list("abcdefghijklmnop"), 89 + lines.SHINGLE)) for _ in range(500)]
        edited = [t[:-10] + "".join(rng.choice(list("qrstuvwxyz"), 10)) for t in base]  # 80 of 100 shingles in common
        assert lines.jaccard(base[0], edited[0]) == (80, 100)
        packed = lines._pack(base + edited, 0)
        for a in range(500):
            found = list(lines._matches(packed, a, np.arange(500, 1000), lambda b: True))
            assert set(found) <= {a + 500}
            lost += not found
    assert lost == 0


def test_op1_exact_copies_on_the_table(spark):
    """Every line of an equal text belongs to the same component; all lines are there."""
    docs = read(spark, SF_SMALL, "documents").collect()
    got = lines.op1(spark, SF_SMALL).collect()
    assert len(got) == sum(len(r["text"].split("\n")) for r in docs)
    text = {(r["doc_id"], n): x.lower() for r in docs for n, x in enumerate(r["text"].split("\n"))}
    seen = {}
    for r in got:
        if r["component"] is not None:
            assert seen.setdefault(text[r["doc_id"], r["line_no"]], r["component"]) == r["component"]
    assert len(seen) < len(set(text.values()))


def test_line_edges(spark):
    out = {(r["doc_id"], r["line_no"], r["text_hash"]): r for r in lines.fuzzy_lines(awkward(spark)).collect()}
    kept = {k[:2]: r["kept"] for k, r in out.items()}
    assert kept[1, 0] and not kept[8, 0] and kept[2, 0] and kept[6, 0] and kept[6, 2]
    clean = lines.drop_duplicate_lines(awkward(spark))
    assert clean.columns == awkward(spark).columns
    ids = sorted(((r["doc_id"] is None, r["doc_id"]) for r in clean.select("doc_id").collect()), key=lambda x: (x[0], x[1] or 0))
    assert [i for _, i in ids] == [1, 2, 3, 4, 4, 5, 6, 7, 9]  # 8 and the null id have no line of their own
    assert lines.fuzzy_lines(nothing(spark)).count() == 0


def test_line_rewriting(spark):
    docs = documents(spark, [(1, "first line that stays here\nshared line of the site, all rights", "s"),
                             (2, "shared line of the site, all rights\n\nsecond text with its own words", "s")])
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in lines.drop_duplicate_lines(docs).collect()}
    assert got[1][0].count("\n") == 1 and got[2] == ("\nsecond text with its own words", 31)


def brute_repeats(rows, n=suffix.LENGTH):
    first = {}
    for doc, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - n + 1):
            first[b[i:i + n]] = min(first.get(b[i:i + n], doc), doc)
    out = {}
    for doc, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - n + 1):
            if first[b[i:i + n]] < doc:
                gone[i:i + n] = True
        spans = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(b) else 0
        keep = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]]) if b else b""
        out[doc] = (len(b), int(gone.sum()), spans, hashlib.sha256(keep).hexdigest())
    return out


@pytest.mark.parametrize("block,many", [(suffix.BLOCK_BYTES, suffix.MANY), (5_000, 2)])
def test_suffix_equals_brute_force(spark, block, many):
    """Also with small blocks and every shared hash taken as frequent."""
    docs = read(spark, SF_SMALL, "documents").where("n_chars < 4000") if block != suffix.BLOCK_BYTES else read(spark, SF_SMALL, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    with_small = suffix.remove_repeats(docs, block_bytes=block, many=many)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in with_small.collect()}
    assert got == brute_repeats(rows)


def test_suffix_periodic_and_edges(spark):
    rows = [(9, "ab" * 100), (1, "ab" * 40), (2, "x" * 49), (3, "x" * 49), (4, "x" * 300), (5, "x" * 50), (6, None), (7, ""), (8, "é" * 60),
            (10, "é" * 30 + "ü" + "é" * 30), (11, "y" + "é" * 60)]
    docs = documents(spark, [(i, t, "s") for i, t in rows], ("block", "share"))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest())
           for r in suffix.remove_repeats(docs).collect()}
    assert got == brute_repeats(rows)
    a = suffix.remove_repeats(awkward(spark)).collect()
    assert len(a) == 11 and all(r["n_removed"] == 0 for r in a if r["doc_id"] == 4)
    assert suffix.remove_repeats(nothing(spark)).count() == 0


def test_suffix_classes():
    """Classes of suffixes are those of equal first symbols."""
    rng = np.random.default_rng(2)
    for sigma in (2, 4, 200):
        parts = [rng.integers(1, sigma + 1, int(rng.integers(1, 90))) for _ in range(60)]
        parts += [parts[i].copy() for i in range(20)] + [np.full(80, 1)] * 2
        text = np.concatenate([np.append(p, 0) for p in parts]).astype(np.int16)
        end = np.flatnonzero(text == 0)
        sa, cls = suffix.suffix_classes(text, 50)
        prefixes = [bytes(text[i:min(i + 50, end[np.searchsorted(end, i)])].tobytes()) for i in sa]
        want = np.cumsum([0] + [a != b for a, b in zip(prefixes, prefixes[1:])])
        assert (cls == want).all()


def plain_vectors(x, ids, threshold=0.9):
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = n @ n.T >= threshold
    np.fill_diagonal(s, False)
    root = roots(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(s)))])
    return {i: (int(s[k].sum()), root[i], root[i] == i) for k, i in enumerate(ids)}


def test_vectors_on_the_table(spark):
    rows = read(spark, SF_CHECK, "embeddings").collect()
    want = plain_vectors(np.array([r["embedding"] for r in rows], float), [r["vec_id"] for r in rows])
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.op2(spark, SF_CHECK).collect()}
    assert len(got) == len(want)
    links = sum(v[0] for v in want.values())
    assert sum(v[0] for v in got.values()) >= 0.99 * links and all(got[i][0] <= want[i][0] for i in want)
    assert np.mean([got[i] == want[i] for i in want]) >= 0.99


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]),
            (9, [None, 1.0]), (10, [1.0, 0.0, 0.0]), (11, [1.0, 0.0, 0.0]), (12, [0.0, 1.0]), (13, [0.0, -1.0]), (None, [1.0, 0.0])]
    v = spark.createDataFrame([(i, x, 1, "c") for i, x in rows], "vec_id long, embedding array<float>, label int, cell string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(v).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[3] == (2, 1, False)
    assert got[11] == (1, 10, False) and got[12] == (0, 12, True) and got[13] == (0, 13, True)
    assert all(got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9)) and got[None] == (0, None, True)
    assert embeddings.near_duplicates(v.limit(0)).count() == 0


def test_vectors_of_extreme_length(spark):
    """Squares of these overflow or vanish in double precision; their cosines don't."""
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1.01e200]), (3, [1.0, 1.0]), (4, [1e-200, 1e-200]), (5, [1e-200, -1e-200]), (6, [1e300, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(v).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5), 6: (0, 6)}


def test_hot_vector_group_spreads_and_counts(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=16)
    x = np.concatenate((base + rng.normal(scale=0.03, size=(1300, 16)), rng.normal(size=(300, 16)))).astype("float32")
    v = spark.createDataFrame([(i, [float(e) for e in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    want = plain_vectors(x.astype(float), list(range(len(x))))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(v).collect()}
    assert np.mean([got[i] == want[i] for i in want]) >= 0.99


def planted_vectors(rng, pairs, d, low, high):
    """Pairs of unit vectors, each of a cosine between the bounds, in random places."""
    x, z = unit(rng, pairs, d), unit(rng, pairs, d)
    z -= (z * x).sum(1, keepdims=True) * x
    cos = rng.uniform(low, high, (pairs, 1))
    return np.concatenate((x, cos * x + np.sqrt(1 - cos ** 2) * z / np.linalg.norm(z, axis=1, keepdims=True)))


def test_vectors_just_above_the_threshold_in_many_cells(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "PER_CELL", 20)
    x = planted_vectors(np.random.default_rng(8), 3000, 64, 0.901, 0.93)
    v = spark.createDataFrame([(i, e) for i, e in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    assert len(embeddings.fit_cells(v.select(F.col("vec_id").alias("cls"), F.col("embedding").alias("vec")))[64]) == 300
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(v).collect()}
    assert got == plain_vectors(x, list(range(len(x))))


def test_vector_groups_that_meet_count_each_link_once(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "PER_CELL", 30)
    monkeypatch.setattr(embeddings, "BLOCK", 50)
    rng = np.random.default_rng(9)
    base = unit(rng, 60, 12)
    x = np.concatenate([b + rng.normal(scale=0.1, size=(40, 12)) for b in base] + [base[0] + rng.normal(scale=0.02, size=(600, 12))])
    v = spark.createDataFrame([(i, e) for i, e in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(v).collect()}
    assert got == plain_vectors(x, list(range(len(x))))


def plain_shingles(line, n=9):
    """Character shingles as the README states them, without the module."""
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    return {t[i:i + n] for i in range(max(1, len(t) - n + 1))}


def test_overlaps_equal_sets_of_strings():
    rng = np.random.default_rng(3)
    left = ["".join(rng.choice(list("ab é漢 "), int(rng.integers(1, 80)))) for _ in range(300)]
    right = [t if k % 5 == 0 else t[:int(rng.integers(0, len(t) + 1))] + "xyz" for k, t in enumerate(left)]
    inter, union = lines.overlaps(left, right)
    for k, (a, b) in enumerate(zip(left, right)):
        x, y = plain_shingles(a), plain_shingles(b)
        assert (inter[k], union[k]) == (len(x & y), len(x | y)) == lines.jaccard(a, b)


@pytest.mark.parametrize("wide", [1 << 14, 50])
def test_links_of_many_small_groups_at_once(monkeypatch, wide):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(lines, "WIDE", wide)
    payloads, begin, want = [], [0], set()
    for size in (2, 3, 1, 12, 40):
        base = "".join(rng.choice(list("abcdef \u00e9"), 90))
        for k in range(size):
            cut = int(rng.integers(0, 30))
            payloads.append("ab" if k == 5 else base[:cut] + "#" * (k % 3) + base[cut:] if k % 4 else base[cut:])
        begin.append(len(payloads))
        for a in range(begin[-2], begin[-1]):
            for b in range(a + 1, begin[-1]):
                inter, union = lines.jaccard(payloads[a], payloads[b])
                if lines.DEN * inter >= lines.NUM * union:
                    want.add((a, b))
    assert len(want) > 20 and set(zip(*lines._linked(payloads, np.array(begin)))) == want


def test_which_edits_of_a_line_stay_linked(spark):
    """One changed character costs nine shingles: lines of 89 characters and more stay linked, shorter ones don't."""
    rng = np.random.default_rng(14)
    rows, want = [], {}
    for k in range(400):
        n = int(rng.integers(40, 200))
        line = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), n - 2)) + "qz"
        at = int(rng.integers(15, n - 15))
        edited = line[:at] + "#" + line[at + 1:]
        rows += [(2 * k, line, "s"), (2 * k + 1, edited.upper() if k % 2 else edited, "s")]
        x, y = plain_shingles(line), plain_shingles(edited)
        want[k] = 10 * len(x & y) >= 8 * len(x | y)
        assert want[k] == (n >= 89)
    got = {r["doc_id"]: r for r in lines.fuzzy_lines(documents(spark, rows)).collect()}
    linked = {k: got[2 * k]["component"] is not None and got[2 * k]["component"] == got[2 * k + 1]["component"] for k in want}
    assert not any(linked[k] for k in want if not want[k])
    assert np.mean([linked[k] for k in want if want[k]]) >= 0.97
    assert all(got[2 * k]["kept"] and got[2 * k + 1]["kept"] != linked[k] for k in want)


def test_shared_keys_by_blocks(spark, monkeypatch):
    """Members of shared keys, with one key of half of all items, however the blocks are cut."""
    from ticklake.llm import candidates
    rng = np.random.default_rng(15)
    pairs = {(int(k), int(i)) for k, i in zip(rng.integers(0, 600, 1500), rng.integers(0, 2000, 1500))} | {(7, i) for i in range(0, 2000, 2)}
    items = spark.createDataFrame([(i, k) for k, i in pairs], "item long, k long").repartition(5).selectExpr("item", "array(k * 4611686018427388) AS keys")

    def expand(batch):
        return batch.column(1).flatten().to_numpy(), batch.column(0).to_numpy()
    want = {}
    for k, i in pairs:
        want.setdefault(k * 4611686018427388, set()).add(i)
    want = {k: v for k, v in want.items() if len(v) > 1}
    for flush, per in ((1 << 19, 1 << 20), (64, 16)):
        monkeypatch.setattr(candidates, "FLUSH", flush)
        monkeypatch.setattr(candidates, "PAIRS", per)
        got = {}
        for r in candidates.shared_keys(items, expand, 1).collect():
            assert r["pivot"] <= r["item"] and r["pivot"] in want[r["key"]]
            got.setdefault(r["key"], set()).add(r["item"])
        assert got == want


def test_blocks_of_members_are_not_copied_at_once():
    """A task that meets keys reads a batch of large blocks one by one."""
    import tracemalloc

    import pyarrow as pa

    from ticklake.llm import candidates
    block = np.arange(3 * 10_000, dtype=np.int64).tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([0] * 200, pa.int32()), pa.array([None] * 200, pa.binary()), pa.array([block] * 200, pa.binary())],
                                       ["bucket", "pairs", "known"])
    tracemalloc.start()
    rows = sum(b.num_rows for b in candidates._meet(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 2_000_000 and peak < 10 * len(block) < batch.nbytes / 10
