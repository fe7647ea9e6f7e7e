"""Per-key throttle without any whole-chain task.

Inside a chain (consecutive gaps < N) cut time into blocks of width
W >= 2N. If the last kept tick before block b is L, the next kept tick is
the first tick >= L + N, which is < L + 2N <= start(b) + 2N: every block
other than the chain's first is entered at a tick in its first 2N seconds.

A. per (key, chain, block), plus a copy of the next block's first 2N
   seconds: run the rule from every possible entry tick and record where it
   enters the next block. Work is linear in the block (entry runs only jump
   between kept ticks).
B. pointer jumping over the entry graph: the chain's first tick enters its
   first block; doubling the "next block entry" map for log2(blocks) rounds
   yields every block's actual entry. Each round is a join; lineage is cut
   by writing each round as a work table under spark.checkpoint.dir.
C. per (key, chain, block): run the rule from the actual entry and mark the
   kept ticks.

Every group is one block of one chain (at most W seconds of one key).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.session import work_path


def _materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write a columnar work table under spark.checkpoint.dir, read it back."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _entries_fn(key_type, n_us: int, w_us: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own = np.sort(pdf.loc[pdf["_own"], "_ts_us"].to_numpy(dtype=np.int64))
        if len(own) == 0:
            return pd.DataFrame({"_k": [], "_chain": [], "_blk": [], "_cand": [], "_next": []})
        look = np.sort(pdf.loc[~pdf["_own"], "_ts_us"].to_numpy(dtype=np.int64))
        arr = np.concatenate([own, look])
        blk = int(pdf["_blk"].iloc[0])
        chain = int(pdf["_chain"].iloc[0])
        b_start, b_next = blk * w_us, (blk + 1) * w_us
        if chain >= b_start:                        # the chain starts in this block
            cands = np.array([chain], dtype=np.int64)
        else:
            u = np.unique(own)
            cands = u[u < b_start + 2 * n_us]
        idx = np.searchsorted(arr, cands, side="left")
        nxt = np.full(len(cands), -1, dtype=np.int64)
        active = np.ones(len(cands), dtype=bool)
        while active.any():
            j = np.searchsorted(arr, arr[idx[active]] + n_us, side="left")
            pos = np.flatnonzero(active)
            end = j >= len(arr)
            active[pos[end]] = False
            ok = ~end
            jj = j[ok]
            crossed = arr[jj] >= b_next
            nxt[pos[ok][crossed]] = arr[jj[crossed]]
            active[pos[ok][crossed]] = False
            idx[pos[ok][~crossed]] = jj[~crossed]
        return pd.DataFrame({"_k": [pdf["_k"].iloc[0]] * len(cands), "_chain": chain, "_blk": blk, "_cand": cands,
                             "_next": pd.Series(nxt, dtype="Int64").mask(nxt < 0)})
    return run


def _mark_fn(n_us: int, cols: list[str], order: list[str]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="mergesort")
        t = pdf["_ts_us"].to_numpy(dtype=np.int64)
        kept = np.zeros(len(t), dtype=bool)
        entry = pdf["_entry"].iloc[0]
        if not pd.isna(entry):
            i = int(np.searchsorted(t, int(entry), side="left"))
            while i < len(t):
                kept[i] = True
                i = int(np.searchsorted(t, t[i] + n_us, side="left"))
        return pdf.loc[kept, cols]
    return run


def block_throttle(c: DataFrame, key: str, seconds: float, out_cols: list[str], *, tie_break: tuple[str, ...] = (),
                   bucket_seconds: int = 3600) -> DataFrame:
    """Kept rows of ``c`` (rows with ``_ts_us`` and ``_chain`` from ``throttle.chains``)."""
    n_us = int(round(seconds * 1_000_000))
    w_us = max(int(bucket_seconds) * 1_000_000, 2 * n_us)
    base = c.withColumn("_k", F.col(key)).withColumn("_blk", F.floor(F.col("_ts_us") / F.lit(w_us)).cast("long"))
    # A: own ticks plus a copy of the first 2N of each block into the block before (same chain)
    first_blk = F.floor(F.col("_chain") / F.lit(w_us)).cast("long")
    copy = ((F.col("_ts_us") - F.col("_blk") * F.lit(w_us)) < F.lit(2 * n_us)) & (F.col("_blk") > first_blk)
    ticks = base.select("_k", "_chain", "_blk", "_ts_us")
    shifted = ticks.select("_k", "_chain", F.explode(F.when(copy, F.array(F.lit(0), F.lit(1)))
                                                     .otherwise(F.array(F.lit(0)))).alias("_off"), "_blk", "_ts_us")
    grouped_in = shifted.select("_k", "_chain", (F.col("_blk") - F.col("_off")).alias("_blk"), "_ts_us",
                                (F.col("_off") == 0).alias("_own"))
    key_type = c.schema[key].dataType
    ent_schema = T.StructType([T.StructField("_k", key_type), T.StructField("_chain", T.LongType()),
                               T.StructField("_blk", T.LongType()), T.StructField("_cand", T.LongType()),
                               T.StructField("_next", T.LongType())])
    entries = grouped_in.groupBy("_k", "_chain", "_blk").applyInPandas(_entries_fn(key_type, n_us, w_us), ent_schema)
    jump = _materialize(entries.select("_k", "_chain", "_blk", "_cand", (F.col("_blk") + 1).alias("_nblk"),
                                       F.col("_next").alias("_ncand")), "throttle-jump")
    # B: reach every block's actual entry from the chain start by doubling the jump map
    reach = jump.where(F.col("_cand") == F.col("_chain")).where(
        F.col("_blk") == F.floor(F.col("_chain") / F.lit(w_us))).select("_k", "_chain", "_blk", "_cand")
    span = entries.groupBy("_k", "_chain").agg((F.max("_blk") - F.min("_blk") + 1).alias("_n")).agg(F.max("_n")).first()[0]
    rounds = max(1, math.ceil(math.log2(max(1, span or 1))) + 1)
    node = ["_k", "_chain", "_blk", "_cand"]
    for _ in range(rounds):
        step = (reach.join(jump, on=node, how="inner").where(F.col("_ncand").isNotNull())
                .select("_k", "_chain", F.col("_nblk").alias("_blk"), F.col("_ncand").alias("_cand")))
        reach = _materialize(reach.unionByName(step).distinct(), "throttle-reach")
        nxt = jump.select("_k", "_chain", F.col("_nblk").alias("_blk"), F.col("_ncand").alias("_cand"),
                          F.struct(*node).alias("_from"))
        two = (nxt.join(jump, on=node, how="left")
               .select(F.col("_from._k").alias("_k"), F.col("_from._chain").alias("_chain"),
                       F.col("_from._blk").alias("_blk"), F.col("_from._cand").alias("_cand"), "_nblk", "_ncand"))
        # a chain ends inside the jump: keep no successor
        jump = _materialize(two, "throttle-jump")
    entry = reach.groupBy("_k", "_chain", "_blk").agg(F.min("_cand").alias("_entry"))
    # C: mark kept ticks inside each block from its actual entry
    marked_in = base.join(entry, on=["_k", "_chain", "_blk"], how="left")
    schema = T.StructType([c.schema[x] for x in out_cols])
    return marked_in.groupBy("_k", "_chain", "_blk").applyInPandas(
        _mark_fn(n_us, out_cols, ["_ts_us", *tie_break]), schema)
