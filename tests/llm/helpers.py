"""Plain versions of the operators' contracts, and awkward tables."""
import hashlib
import re

import numpy as np

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def documents(spark, rows, extra=()):
    """doc_id, text, lang, source, n_chars, and string columns with clashing names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` string" for c in extra)
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), *["x"] * len(extra)) for i, t, s in rows], schema)


def awkward(spark):
    """Nulls, empty and long texts, repeated rows, clashing columns."""
    long = " ".join(f"word{i % 977}" for i in range(20_000))
    rows = [(1, "a b c d e f g h. i j k l m n o p", "s1"), (2, None, "s1"), (3, "", None), (4, long, "s2"), (4, long, "s2"),
            (5, "one", None), (6, "  \n\n\t ", "s2"), (None, "a b c d e f g h. i j k l m n o q", "s1"), (7, "é ü 漢字 😀 x", "s3"),
            (8, "a b c d e f g h. i j k l m n o p", "s3"), (9, "x" * 5000, "s3")]
    return documents(spark, rows, ("size", "target", "score", "component_id", "words", "key", "line", "block", "_pattern"))


def nothing(spark):
    return documents(spark, [], ("size", "key"))


def shingles(text, k):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def unit(rng, n, d):
    x = rng.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)
