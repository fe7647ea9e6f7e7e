"""Streaming per-key throttle without a group of a whole key.

The rule's state is one number per key, the event time of its last kept tick.
A micro-batch first drops, by a join with that state, what can't pass (older
than ``last + N``: throttled ticks and late ones); what is left starts anew, so
the batch operator (``operators.throttle``: chains, and time blocks of long
chains) gives exactly what a tick-by-tick rule would keep. No task holds a
key's micro-batch; a burst of one coin is split like any hot key.

Batch k reads the state that batch k - 1 wrote, writes its kept ticks under
``batch=<k>`` and then the state after it, so doing a batch again replaces its
own files with the same rows. The state has a row a key and is written whole
each time; the last ``KEEP`` versions stay. Late ticks are dropped from the
throttled output only; the unthrottled append path still has them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticklake.functions.timefmt import micros
from ticklake.operators.keyed import MAX_SEGMENT_ROWS
from ticklake.operators.sinks import BATCH_COL
from ticklake.operators.throttle import throttle
from ticklake.session import ensure_conf, folders, remove_path

KEEP = 3


def _version(batch_id: int) -> str:
    return f"v{batch_id:012d}"


def _state(spark: SparkSession, path: str, before: int) -> str | None:
    """The newest state written before a batch."""
    older = [f for f in folders(spark, path) if f < _version(before)]
    return f"{path}/{older[-1]}" if older else None


def throttle_batch(batch: DataFrame, batch_id: int, path: str, key: str, ts: str, seconds: float, *, tie_break: tuple[str, ...] = (),
                   **options) -> None:
    """Append one micro-batch's kept ticks below ``path``/ticks and advance ``path``/state (idempotent)."""
    spark = ensure_conf(batch.sparkSession)
    n_us = int(round(seconds * 1_000_000))
    known = _state(spark, f"{path}/state", batch_id)
    schema = f"_k {batch.schema[key].dataType.simpleString()}, _last long"
    state = spark.read.schema(schema).parquet(known) if known else spark.createDataFrame([], schema)
    left = batch.join(state, F.col(key).eqNullSafe(F.col("_k")), "left")
    left = left.where(F.col("_last").isNull() | (micros(F.col(ts)) >= F.col("_last") + n_us)).select(*batch.columns)
    kept = throttle(left, key, ts, seconds, tie_break=tie_break, **options)
    (kept.withColumn(BATCH_COL, F.lit(batch_id)).write.mode("overwrite").partitionBy(BATCH_COL).parquet(f"{path}/ticks"))
    own = f"{path}/ticks/{BATCH_COL}={batch_id}"
    new = spark.read.schema(batch.schema).parquet(own) if f"{BATCH_COL}={batch_id}" in folders(spark, f"{path}/ticks") else batch.limit(0)
    last = new.groupBy(F.col(key).alias("_k")).agg(F.max(micros(F.col(ts))).alias("_last"))
    after = state.unionByName(last).groupBy("_k").agg(F.max("_last").alias("_last"))
    after.write.mode("overwrite").parquet(f"{path}/state/{_version(batch_id)}")
    for old in [f for f in folders(spark, f"{path}/state") if f < _version(batch_id)][:-KEEP]:
        remove_path(spark, f"{path}/state/{old}")


def throttle_stream(sdf: DataFrame, key: str, ts: str, seconds: float, *, path: str, checkpoint: str, tie_break: tuple[str, ...] = (),
                    available_now: bool = False, trigger: str | None = None, max_rows: int = MAX_SEGMENT_ROWS,
                    long_chain_rows: int = MAX_SEGMENT_ROWS, bucket_seconds: int = 3600) -> StreamingQuery:
    """Start the query that keeps the throttled ticks of a streaming DataFrame below ``path`` (see ``read_throttled``).
    A ``path`` belongs to one checkpoint."""
    def each(batch: DataFrame, batch_id: int) -> None:
        throttle_batch(batch, batch_id, path, key, ts, seconds, tie_break=tie_break, max_rows=max_rows,
                       long_chain_rows=long_chain_rows, bucket_seconds=bucket_seconds)

    w = sdf.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def read_throttled(spark: SparkSession, path: str) -> DataFrame:
    """The kept ticks of all batches."""
    return spark.read.parquet(f"{path}/ticks").drop(BATCH_COL)
