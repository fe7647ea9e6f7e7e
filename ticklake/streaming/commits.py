"""Which partitions of the lake are complete: a ledger driven by event time.

The event clock is the newest event time that has come, less the watermark's
delay. A day partition is committed one minute after the clock has passed its
end; rows that come for it later reopen it, and it is committed anew with
them. The ledger keeps three kinds of rows a partition - ``land`` (rows a batch
has added), ``reopen`` and ``commit`` (with the rows it then has) - under
dt/batch, so writing a batch again replaces its own rows, and a replay whose
rows are stored already lands none and moves nothing. A batch reads the ledger
from the oldest open day on, not the whole of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.timefmt import as_column
from ticklake.operators.sinks import BATCH_COL
from ticklake.schemas import COMMIT_DELAY, LAKE_PARTITIONS, WATERMARK_DELAY
from ticklake.session import ensure_conf, path_exists

EVENTS = "source string, coin_id string, event string, n long, watermark timestamp_ntz, seq long, dt string, batch string"
CLOCK = "seq long, newest timestamp_ntz, watermark timestamp_ntz, oldest_open string, batch string"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def landed(spark: SparkSession, lake: str, batch: str, touched: list[tuple]) -> DataFrame:
    """Rows that a batch has in each of the partitions it touched (values of LAKE_PARTITIONS)."""
    levels = ["/".join([lake, *[f"{c}={v}" for c, v in zip(LAKE_PARTITIONS, t)], f"{BATCH_COL}={batch}"]) for t in touched]
    levels = [p for p in levels if path_exists(spark, p)]
    if not levels:
        return spark.createDataFrame([], "source string, coin_id string, dt string, n long")
    return (spark.read.option("basePath", lake).parquet(*levels).groupBy(*LAKE_PARTITIONS).agg(F.count(F.lit(1)).alias("n"))
            .select("source", "coin_id", "dt", "n"))


def _status(events: DataFrame) -> DataFrame:
    """Rows, and the numbers of the last landing and the last commit, of each partition."""
    return events.groupBy(*LAKE_PARTITIONS).agg(
        F.sum(F.when(F.col("event") == "land", F.col("n"))).alias("rows"),
        F.max(F.when(F.col("event") == "land", F.col("seq"))).alias("landed"),
        F.max(F.when(F.col("event") == "commit", F.col("seq"))).alias("committed"))


def advance(spark: SparkSession, lake: str, ledger: str, batch: str, accepted: DataFrame, *,
            delay: str = WATERMARK_DELAY, after: str = COMMIT_DELAY) -> None:
    """Enter one landed batch (its accepted rows) into the ledger and commit what the clock has passed (action)."""
    ensure_conf(spark)
    clock = _read(spark, f"{ledger}/clock", CLOCK).where(F.col(BATCH_COL) != batch)
    last = clock.agg(F.max("seq").alias("seq"), F.max("newest").alias("newest"), F.max_by("oldest_open", "seq").alias("oldest")).first()
    touched = accepted.groupBy(*LAKE_PARTITIONS).agg(F.max("recorded_at").alias("newest")).collect()  # one batch's partitions
    newest = max((t for t in (last["newest"], *[r["newest"] for r in touched]) if t is not None), default=None)
    if newest is None:
        return
    seq = (last["seq"] or 0) + 1
    watermark = as_column(newest) - F.expr(f"INTERVAL {delay}")
    oldest = min((d for d in (last["oldest"], *[r["dt"] for r in touched]) if d is not None), default="9999")
    known = _read(spark, f"{ledger}/events", EVENTS).where((F.col("dt") >= oldest) & (F.col(BATCH_COL) != batch))
    new = landed(spark, lake, batch, [tuple(r[c] for c in LAKE_PARTITIONS) for r in touched])
    state = _status(known).join(new, list(LAKE_PARTITIONS), "full")
    was = F.coalesce(F.col("committed") >= F.col("landed"), F.lit(False))
    passed = F.col("dt").cast("timestamp_ntz") + F.expr(f"INTERVAL 1 DAY {after}") <= watermark
    more = F.col("n").isNotNull()
    found = F.filter(F.array(
        F.when(more, F.struct(F.lit("land").alias("event"), F.col("n").alias("k"))),
        F.when(more & was, F.struct(F.lit("reopen").alias("event"), F.col("n").alias("k"))),
        F.when(passed & (more | ~was), F.struct(F.lit("commit").alias("event"), (F.coalesce("rows", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("k")))),
        lambda e: e.isNotNull())
    state = state.withColumns({"e": F.explode_outer(found), "open": ~passed & (more | ~was)}).persist()
    try:
        entries = state.where("e IS NOT NULL").select("source", "coin_id", F.col("e.event").alias("event"), F.col("e.k").alias("n"),
                                                      watermark.alias("watermark"), F.lit(seq).cast("long").alias("seq"), "dt", F.lit(batch).alias(BATCH_COL))
        entries.hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt", BATCH_COL).parquet(f"{ledger}/events")
        still = state.where("open").agg(F.min("dt")).first()[0]
        (spark.range(1).select(F.lit(seq).cast("long").alias("seq"), as_column(newest).alias("newest"), watermark.alias("watermark"),
                               F.lit(still).cast("string").alias("oldest_open"), F.lit(batch).alias(BATCH_COL))
         .write.mode("overwrite").partitionBy(BATCH_COL).parquet(f"{ledger}/clock"))
    finally:
        state.unpersist()


def read_events(spark: SparkSession, ledger: str) -> DataFrame:
    return _read(ensure_conf(spark), f"{ledger}/events", EVENTS)


def partition_status(spark: SparkSession, ledger: str) -> DataFrame:
    """Every partition: its rows, whether it is complete now, how often it was committed and reopened."""
    e = read_events(spark, ledger)
    how_often = e.groupBy(*LAKE_PARTITIONS).agg(F.count_if(F.col("event") == "commit").alias("commits"), F.count_if(F.col("event") == "reopen").alias("reopens"))
    return _status(e).join(how_often, list(LAKE_PARTITIONS)).select(
        *LAKE_PARTITIONS, F.col("rows").alias("n_rows"), F.coalesce(F.col("committed") >= F.col("landed"), F.lit(False)).alias("complete"),
        "commits", "reopens")
