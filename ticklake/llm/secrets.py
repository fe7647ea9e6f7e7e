"""Secrets in texts: fixed patterns first, then a character Markov model for what the patterns miss.

Two first-order Markov chains over characters are trained from labelled
samples of the corpus itself: strings the patterns found (label random) and
words that are plain identifiers, dotted names, paths and numbers (label ordinary). A
stretch of `MIN_TOKEN` or more characters of the alphabet outside the pattern
spans - a token, or what is left of one beside a span - is a secret when the
log-likelihood ratio of the two chains reaches `THRESHOLD`. All steps are DataFrame
expressions: texts are scanned once, in the JVM, and only spans go on.

Edges: null and empty texts have no spans; an empty table gives no rows; with
no labelled strings the random chain is uniform; with no ordinary words
either, every ratio is 0 and only the patterns count. Repeated rows are
reported as often as they occur. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read, saved, text_or_empty

ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
# A maximal run is long enough or is dropped, so the bound may stand in the pattern for these two.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
MIN_VALUE = 12
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
MIN_TOKEN = 12         # as the shortest value that the patterns take
TOKEN = f"[A-Za-z0-9+/_.=-]{{{MIN_TOKEN},}}"
ORDINARY = "(?:[A-Za-z]{3,}|[0-9]{1,4})(?:[_./-](?:[A-Za-z]{2,}[0-9]?|[0-9]{1,4}))*[.]?"
STRETCH = 256          # matches whose places are summed up at a time
THRESHOLD = 12.0       # nats
BACKOFF = 4.0          # weight of single characters against pairs in the ordinary chain
SAMPLE_DOCS = 5_000    # documents that give ordinary words, at most about
SAMPLE_STRINGS = 20_000  # strings of each label, at most
KINDS = ("assign", "access", "hex", "markov")
_SPAN = "array<struct<kind:int,start:int,end:int,text:string>>"


def _place(kind: int, found: str, pieces: str) -> Column:
    """Spans of `found`, the matches of a pattern, from `pieces`, the text between them. Running sums are taken over `STRETCH`
    matches at a time, so a text of many matches doesn't copy all of them for each."""
    return F.expr(f"""transform(
        array(filter(zip_with({found}, {pieces}, (m, p) -> struct(length(p) AS gap, length(m) AS len, m AS m)), x -> x.m IS NOT NULL)),
        z -> aggregate(sequence(0, greatest(0, size(z) - 1) div {STRETCH}), struct(0 AS at, CAST(array() AS array<{_SPAN}>) AS parts),
            (a, k) -> transform(array(aggregate(slice(z, CAST(k * {STRETCH} + 1 AS int), {STRETCH}), struct(a.at AS at, CAST(array() AS {_SPAN}) AS spans),
                (b, x) -> struct(b.at + x.gap + x.len AS at,
                                 array_append(b.spans, struct({kind} AS kind, b.at + x.gap AS start, b.at + x.gap + x.len AS end, x.m AS text)) AS spans))),
                r -> struct(r.at AS at, array_append(a.parts, r.spans) AS parts))[0],
            a -> flatten(a.parts)))[0]""")


def _outside(token: str) -> str:
    """SQL for what a token has outside the base spans: stretches of `MIN_TOKEN` characters or more, as spans."""
    touch = f"filter(base, b -> b.start < {token}.end AND {token}.start < b.end)"
    part = (f"struct({token}.kind AS kind, {{a}} AS start, {{z}} AS end, substring({token}.text, {{a}} - {token}.start + 1, {{z}} - {{a}}) AS text)")
    return f"""CASE WHEN NOT exists(base, b -> b.start < {token}.end AND {token}.start < b.end) THEN array({token}) ELSE filter(aggregate(
        array_sort({touch}, (x, y) -> CASE WHEN x.start < y.start THEN -1 WHEN x.start > y.start THEN 1 ELSE 0 END),
        struct({token}.start AS at, CAST(array() AS {_SPAN}) AS spans),
        (a, b) -> struct(greatest(a.at, b.end) AS at, CASE WHEN b.start > a.at THEN array_append(a.spans, {part.format(a='a.at', z='b.start')}) ELSE a.spans END AS spans),
        a -> CASE WHEN a.at < {token}.end THEN array_append(a.spans, {part.format(a='a.at', z=f'{token}.end')}) ELSE a.spans END),
        p -> p.end - p.start >= {MIN_TOKEN}) END"""


def pattern_spans(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, base (spans of the patterns), tokens (candidate spans for the model), strings, words (labelled samples)."""
    every = max(1, docs.count() // sample_docs)
    text, quoted = F.col("_text"), {k: p.replace("\\", "\\\\").replace("'", "\\'") for k, p in
                                    (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("token", TOKEN))}
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("_text"))
    d = d.withColumn("_sampled", F.pmod(F.xxhash64("doc_id", F.length("_text")), F.lit(every)) == 0)
    d = d.withColumns({f"_{k}": F.regexp_extract_all(text, F.lit(p), F.lit(0)) for k, p in
                       (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("token", TOKEN))}
                      | {"_value": F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)),
                         "_words": F.when(F.col("_sampled"), F.array_distinct(F.regexp_extract_all(
                             text, F.lit(f"(?<![A-Za-z0-9+/_.=-])({ORDINARY})(?![A-Za-z0-9+/_.=-])"), F.lit(1))))})
    placed = {f"_at_{k}": F.when(F.size(f"_{k}") > 0, _place(i, f"_{k}", f"split(_text, '{quoted[k]}', -1)"))
              for i, k in enumerate(("assign", "access", "hex", "token"))}
    d = d.select("doc_id", "_value", "_words", *[c.alias(k) for k, c in placed.items()])
    none = f"CAST(array() AS {_SPAN})"
    d = d.withColumn("_at_assign", F.expr(
        f"transform(filter(zip_with(_at_assign, _value, (s, v) -> struct(s AS s, v AS v)), x -> length(x.v) >= {MIN_VALUE}), x -> x.s)"))
    d = d.withColumn("base", F.expr(f"concat(coalesce(_at_assign, {none}), coalesce(_at_access, {none}), coalesce(_at_hex, {none}))"))
    return saved(d.select("doc_id", "base", F.expr(
        f"flatten(transform(coalesce(_at_token, {none}), t -> {_outside('t')}))").alias("tokens"),
        F.expr(f"concat(coalesce(filter(_value, v -> length(v) >= {MIN_VALUE}), CAST(array() AS array<string>)), "
               "transform(filter(base, b -> b.kind > 0), b -> b.text))").alias("strings"),
        F.col("_words").alias("words")), "secret-spans")


def _pairs(strings: DataFrame, column: str) -> dict:
    """Counts of adjacent characters over a bounded sample of distinct strings; at most one row per pair comes back."""
    s = strings.select(F.explode(column).alias("s")).distinct().orderBy(F.xxhash64("s"), "s").limit(SAMPLE_STRINGS)
    p = s.select(F.explode(F.expr("transform(sequence(1, greatest(1, length(s) - 1)), i -> substring(s, i, 2))")).alias("p"))
    return {r["p"]: r["n"] for r in p.where(F.length("p") == 2).groupBy("p").agg(F.count("*").alias("n")).collect()}


def train(spans: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of alphabet characters, row by row."""
    random, plain, size, table = _pairs(spans, "strings"), _pairs(spans, "words"), len(ALPHABET), []
    ends = {b: sum(plain.get(a + b, 0) for a in ALPHABET) for b in ALPHABET}
    total = sum(ends.values())
    single = {b: (n + 0.1) / (total + 0.1 * size) for b, n in ends.items()}  # of one character, where a pair wasn't seen
    for a in ALPHABET:
        n_random = sum(random.get(a + b, 0) for b in ALPHABET)
        n_plain = sum(plain.get(a + b, 0) for b in ALPHABET)
        for b in ALPHABET:
            # half the random chain is uniform: a secret need not look like those already known
            r = 0.5 / size + 0.5 * (random.get(a + b, 0) + 0.5) / (n_random + 0.5 * size)
            table.append(math.log(r) - math.log((plain.get(a + b, 0) + BACKOFF * single[b]) / (n_plain + BACKOFF)))
    return table


def score(token: str, model: list[float]) -> str:
    """SQL for the log-likelihood ratio of a token expression, in nats. The model is one constant array, read by position."""
    table = "CAST(split('" + ",".join(f"{x:.6f}" for x in model) + "', ',') AS array<double>)"
    code = f"transform(sequence(1, length({token})), i -> instr('{ALPHABET}', substring({token}, i, 1)) - 1)"
    return f"""aggregate({code}, struct(-1 AS last, 0.0D AS sum),
        (a, c) -> struct(c AS last, a.sum + CASE WHEN a.last < 0 OR c < 0 THEN 0.0D
                         ELSE element_at({table}, a.last * {len(ALPHABET)} + c + 1) END AS sum), a -> a.sum)"""


def _joined(spans: str) -> Column:
    """kind:start:end of the spans by start, then kind as listed."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"""concat_ws(',', transform(array_sort(transform({spans}, s -> struct(s.start, s.kind, s.end))),
        s -> concat_ws(':', element_at({names}, s.kind + 1), CAST(s.start AS string), CAST(s.end AS string))))""")


def find_secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, base (pattern spans) and secrets (those and the model's), as arrays of kind (a position in KINDS), start, end, text."""
    spans = pattern_spans(docs)
    model = train(spans)
    return spans.select("doc_id", "base", F.expr(
        f"concat(base, filter(tokens, t -> {score('t.text', model)} >= {threshold}D))").alias("secrets"))


def op4(spark, sf_dir: str) -> DataFrame:
    """Secrets of all documents."""
    d = find_secrets(read(spark, sf_dir, "documents"))
    count = {f"n_{k}": F.expr(f"CAST(size(filter(base, s -> s.kind = {i})) AS long)") for i, k in enumerate(KINDS[:3])}
    return d.select("doc_id", *[c.alias(k) for k, c in count.items()],
                    F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("secrets").alias("spans"))
