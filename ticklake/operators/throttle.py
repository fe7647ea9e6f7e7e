"""Per-key throttle: keep a tick when at least N seconds passed since the
last *kept* tick of the same key (the first tick of a key is kept; exactly N
later is kept).

Keep/drop depends on the previous *kept* tick, so the rule is sequential.
Two facts make it distributable without changing the result:

1. A gap >= N between consecutive ticks of a key always restarts the rule
   (the last kept tick is no newer than the previous tick), so the key's
   history splits into independent *chains* at such gaps. Chains are found
   with the segmented ``previous``/``running_max`` operators (time buckets,
   hot buckets split at row quantiles), so no task holds a whole key.
2. Inside a chain the kept ticks are found by jumping: the next kept tick is
   the first tick at or after ``last_kept + N`` (a binary search), so the
   work per chain is proportional to the kept ticks, not to all ticks.

Chains up to ``long_chain_rows`` rows are hash-partitioned by (key, chain)
and sorted; ``mapInPandas`` streams each partition in Arrow batches,
carrying the chain state across batches. Longer chains (a key that never
pauses for N seconds) go to ``throttle_blocks``: time blocks of one chain
are processed in parallel and stitched together by pointer jumping, so no
task holds a whole chain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions.timefmt import micros
from ticklake.operators.keyed import MAX_SEGMENT_ROWS, previous, running_max, segments
from ticklake.session import work_path


def chains(df: DataFrame, key: str, ts: str, seconds: float, *, bucket_seconds: int | None = 3600,
           max_rows: int = MAX_SEGMENT_ROWS) -> DataFrame:
    """Add ``_ts_us`` (event time in microseconds) and ``_chain`` (start of the
    tick's chain, microseconds)."""
    n_us = int(round(seconds * 1_000_000))
    base = df.withColumn("_ts_us", micros(F.col(ts)))
    if bucket_seconds is not None:
        # one segmentation shared by both sequence passes
        base = segments(base, [key], ts, bucket_seconds=bucket_seconds, max_rows=max_rows)
    prev = previous(base, [key], ts, ["_ts_us"], bucket_seconds=bucket_seconds, prefix="_prev")
    gap_start = F.col("_prev_ts_us").isNull() | ((F.col("_ts_us") - F.col("_prev_ts_us")) >= F.lit(n_us))
    flagged = prev.withColumn("_start", F.when(gap_start, F.col("_ts_us"))).drop("_prev_ts_us")
    out = running_max(flagged, [key], ts, "_start", "_chain", bucket_seconds=bucket_seconds).drop("_start")
    return out.drop("_seg") if "_seg" in out.columns else out


def _fold(key: str, n_us: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None  # (key, chain, last kept micros) carried across batches
        for pdf in batches:
            if pdf.empty:
                yield pdf.assign(_kept=pd.Series([], dtype=bool))
                continue
            ts = pdf["_ts_us"].to_numpy(dtype=np.int64)
            ks = pdf[key].to_numpy()
            ch = pdf["_chain"].to_numpy(dtype=np.int64)
            kept = np.zeros(len(pdf), dtype=bool)
            change = np.flatnonzero((ks[1:] != ks[:-1]) | (ch[1:] != ch[:-1])) + 1
            starts = np.concatenate(([0], change))
            ends = np.concatenate((change, [len(pdf)]))
            # the first segment may continue the previous batch's chain
            cont = state is not None and state[0] == ks[0] and state[1] == ch[0]
            # every other segment starts a chain: its first tick is kept (vectorised);
            # only segments longer than one tick need the jump loop
            kept[starts[1:] if cont else starts] = True
            for j in np.flatnonzero((ends - starts > 1) | ((np.arange(len(starts)) == 0) & cont)):
                a, b = int(starts[j]), int(ends[j])
                seg = ts[a:b]
                last = state[2] if (j == 0 and cont) else int(seg[0])
                i = int(np.searchsorted(seg, last + n_us, side="left"))
                while i < len(seg):
                    kept[a + i] = True
                    last = int(seg[i])
                    i = int(np.searchsorted(seg, last + n_us, side="left"))
                if j == len(starts) - 1:
                    state = (ks[a], ch[a], last)
            # carry the state of the batch's last chain into the next batch
            a = int(starts[-1])
            if not (len(starts) == 1 and cont) and ends[-1] - starts[-1] == 1:
                state = (ks[a], ch[a], int(ts[a]))
            yield pdf.assign(_kept=kept)
    return run


def throttle(df: DataFrame, key: str, ts: str, seconds: float, *, tie_break: tuple[str, ...] = (),
             bucket_seconds: int | None = 3600, partitions: int | None = None,
             max_rows: int = MAX_SEGMENT_ROWS, algorithm: str = "auto",
             long_chain_rows: int = MAX_SEGMENT_ROWS) -> DataFrame:
    """Rows of ``df`` that pass the per-``key`` throttle on event time ``ts``.

    Ties on ``ts`` are ordered by ``tie_break`` columns (the first is kept).
    """
    n_us = int(round(seconds * 1_000_000))
    c = chains(df, key, ts, seconds, bucket_seconds=bucket_seconds, max_rows=max_rows)
    from ticklake.operators.throttle_blocks import block_throttle

    def blocks(x: DataFrame) -> DataFrame:
        return block_throttle(x, key, seconds, list(df.columns), tie_break=tie_break,
                              bucket_seconds=bucket_seconds or 3600)

    if algorithm == "blocks":
        return blocks(c)
    if algorithm == "auto":
        # chains longer than the bound are split into blocks; the rest are folded whole.
        # The chain table is written once as a work table under spark.checkpoint.dir,
        # so the size check and the fold read it instead of re-deriving the chains.
        path = work_path(c.sparkSession, "throttle-chains")
        c.write.parquet(path)
        c = c.sparkSession.read.parquet(path)
        sizes = c.groupBy(key, "_chain").agg(F.count(F.lit(1)).alias("_n"))
        long = sizes.where(F.col("_n") > long_chain_rows).select(key, "_chain")
        if long.limit(1).count() > 0:
            short = c.join(long, on=[key, "_chain"], how="left_anti")
            return _fold_all(short, df, key, n_us, tie_break, partitions).unionByName(
                blocks(c.join(long, on=[key, "_chain"], how="left_semi")))
    return _fold_all(c, df, key, n_us, tie_break, partitions)


def _fold_all(c: DataFrame, df: DataFrame, key: str, n_us: int, tie_break: tuple[str, ...],
              partitions: int | None) -> DataFrame:
    parts = [partitions] if partitions else []
    ordered = (c.repartition(*parts, key, "_chain")
                .sortWithinPartitions(key, "_chain", "_ts_us", *tie_break))
    schema = T.StructType(list(ordered.schema.fields) + [T.StructField("_kept", T.BooleanType())])
    folded = ordered.mapInPandas(_fold(key, n_us), schema)
    return folded.where(F.col("_kept")).select(*df.columns)
