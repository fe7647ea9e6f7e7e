"""Keyed row selection and sequence operators that stay parallel under skew.

The reference uses ``row_number() = 1`` and ``distinct on`` for top-1 per key
and ``lag`` over (coin, source). There are only a handful of coins and
sources, so a plain window puts a whole coin's history into one task. These
operators give the same rows with plans that split hot keys:

* top-1 / dedupe are aggregates of a struct (``max``/``min``), which Spark
  runs as partial + final hash aggregation: a hot key is reduced map-side
  before the shuffle.
* ``previous`` runs the window inside (key, segment) and carries the last
  row of the previous non-empty segment through a per-segment table.
  Segments are time buckets, and a bucket that is itself hot is split at
  row quantiles (``segments``), so no task holds more than about
  ``MAX_SEGMENT_ROWS`` rows of one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.functions.timefmt import micros, time_bucket


def _nulls_last_parts(cols: Sequence[str]) -> list[Column]:
    """Struct fields ordering ``cols`` ascending with NULLs last."""
    parts: list[Column] = []
    for c in cols:
        parts.append(F.col(c).isNull().alias(f"_n_{c}"))
        parts.append(F.col(c).alias(c))
    return parts


def top1_by_key(df: DataFrame, keys: Sequence[str], order_desc: str, payload: Sequence[str], *,
                method: str = "struct") -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order_desc``.

    Equal to ``row_number() over (partition by keys order by order_desc desc) = 1``
    when ``order_desc`` is unique within a key; with ties the greatest payload
    wins, deterministically.

    ``method="struct"``: one pass, max of a struct (sort-based partial
    aggregation). ``method="join"`` for a materialised table: a hash partial
    aggregate of ``max(order_desc)`` per key (fixed-width buffer), a join back
    on (keys, max) whose small side has one row per key, and the tie-break
    over the winners only; two scans, no sort of the input.
    """
    if method == "join":
        best = df.groupBy(*keys).agg(F.max(order_desc).alias("_best"))
        cond = [df[k] == best[k] for k in keys] + [df[order_desc] == best["_best"]]
        winners = df.join(best, on=cond, how="left_semi")
        return top1_by_key(winners, keys, order_desc, payload)
    packed = F.max(F.struct(F.col(order_desc).alias("_o"), *[F.col(c) for c in payload])).alias("_top")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, F.col("_top._o").alias(order_desc), *[F.col(f"_top.{c}").alias(c) for c in payload])


def dedupe_by_key(df: DataFrame, keys: Sequence[str], tie_break: Sequence[str], rest: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: the smallest by ``tie_break`` (each ascending, NULLs
    last). ``distinct on (keys)`` with an explicit, deterministic choice.
    A key with many copies is pre-reduced in the partial aggregate."""
    packed = F.min(F.struct(*_nulls_last_parts(tie_break), *[F.col(c) for c in rest])).alias("_pick")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_pick.{c}").alias(c) for c in (*tie_break, *rest)])


# rows above which a (key, time bucket) is split further, and the most parts it is split into
MAX_SEGMENT_ROWS = 4_000_000
SPLIT_FANOUT = 4096


def segments(df: DataFrame, keys: Sequence[str], order_col: str, *, bucket_seconds: int = 3600,
             max_rows: int = MAX_SEGMENT_ROWS, fanout: int = SPLIT_FANOUT) -> DataFrame:
    """Add ``_seg``: a number increasing with ``order_col`` within each key,
    such that no (key, _seg) group is much larger than ``max_rows``, as long as
    no (key, bucket) has more than ``fanout`` times as many rows.

    Segments are time buckets; a bucket holding more than ``max_rows`` rows
    (a burst, or a key with most of the data) is split at approximate row
    quantiles of ``order_col`` into as many parts as its count asks for, up to ``fanout``. Counting and the
    quantile sketches are partial aggregates, so a hot bucket is summarised
    map-side; only hot buckets are sketched. Equal ``order_col`` values
    always share a segment.
    """
    us = micros(F.col(order_col))
    b = df.withColumn("_bkt", time_bucket(F.col(order_col), bucket_seconds))
    counts = b.groupBy(*keys, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > max_rows).select(*keys, "_bkt")
    probs = [i / fanout for i in range(1, fanout)]
    bounds = (b.join(hot, on=[*keys, "_bkt"], how="left_semi")
               .groupBy(*keys, "_bkt").agg(F.percentile_approx(us, probs, 10_000).alias("_all"),
                                           F.least(F.lit(fanout), F.ceil(F.count(F.lit(1)) / max_rows)).cast("int").alias("_parts"))
               .select(*keys, "_bkt", F.expr(f"transform(sequence(1, greatest(1, _parts - 1)), i -> _all[CAST(i * {fanout} / _parts AS int) - 1])").alias("_bounds")))
    seg = b.join(bounds, on=[*keys, "_bkt"], how="left")
    sub = F.coalesce(F.size(F.filter(F.col("_bounds"), lambda x: x <= us)), F.lit(0))
    return seg.withColumn("_seg", F.col("_bkt") * F.lit(fanout) + sub).drop("_bkt", "_bounds")


def previous(df: DataFrame, keys: Sequence[str], order_col: str, values: Sequence[str], *,
             bucket_seconds: int | None = 3600, prefix: str = "prev_", max_rows: int = MAX_SEGMENT_ROWS) -> DataFrame:
    """Add ``prefix + v`` = value of ``v`` on the previous row (by ``order_col``)
    of the same key: ``lag(v) over (partition by keys order by order_col)``.

    ``order_col`` must be unique within a key (true for keyed silver rows).
    ``bucket_seconds=None`` gives the plain one-window form.
    """
    if bucket_seconds is None:
        w = Window.partitionBy(*keys).orderBy(order_col)
        return df.select("*", *[F.lag(v).over(w).alias(prefix + v) for v in values])

    bkt = "_seg"
    b = df if bkt in df.columns else segments(df, keys, order_col, bucket_seconds=bucket_seconds, max_rows=max_rows)
    row = F.struct(*[F.col(v) for v in values])
    w_in = Window.partitionBy(*keys, bkt).orderBy(order_col)
    inner = b.withColumn("_prev", F.lag(row).over(w_in))
    # last row of every (key, bucket): partial-aggregated, rows = keys x buckets
    last = (b.groupBy(*keys, bkt)
             .agg(F.max(F.struct(F.col(order_col).alias("_o"), row.alias("_v"))).alias("_last")))
    w_b = Window.partitionBy(*keys).orderBy(bkt)
    carry = last.select(*keys, bkt, F.lag(F.col("_last._v")).over(w_b).alias("_carry"))
    joined = inner.join(carry, on=[*keys, bkt], how="left")
    prev = F.coalesce(F.col("_prev"), F.col("_carry"))
    return joined.select(*df.columns, *[prev[v].alias(prefix + v) for v in values])



def running_max(df: DataFrame, keys: Sequence[str], order_col: str, value: str, out: str, *,
                bucket_seconds: int | None = 3600, max_rows: int = MAX_SEGMENT_ROWS) -> DataFrame:
    """``out`` = max of ``value`` over rows of the same key with
    ``order_col`` <= the current row's (a running max; NULLs ignored).

    Bucketed like ``previous``: a running max inside (key, bucket) plus the
    max of all earlier buckets from a per-bucket table.
    """
    if bucket_seconds is None:
        w = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.max(value).over(w))
    bkt = "_seg"
    b = df if bkt in df.columns else segments(df, keys, order_col, bucket_seconds=bucket_seconds, max_rows=max_rows)
    w_in = Window.partitionBy(*keys, bkt).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    inner = b.withColumn("_in", F.max(value).over(w_in))
    per_bucket = b.groupBy(*keys, bkt).agg(F.max(value).alias("_bmax"))
    w_b = Window.partitionBy(*keys).orderBy(bkt).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(*keys, bkt, F.max("_bmax").over(w_b).alias("_carry"))
    joined = inner.join(carry, on=[*keys, bkt], how="left")
    return joined.select(*df.columns, F.greatest("_in", "_carry").alias(out))
