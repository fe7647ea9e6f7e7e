"""The streaming ingest: one read of the feed log, three idempotent writes.

    log (Kafka or landing files)
      -> foreachBatch(batch, id):
           parse each message once -> reason + typed fields   (persisted)
           good     = accepted rows of the unified view
           dead     = rows with a dead-letter reason
           raw      <- upsert by (coin_id, source, recorded_at), greatest log position wins
           lake     <- append under source/coin_id/dt/batch=<query>-<id>
           dlq      <- rejected rows under dt/batch=<query>-<id>
           commits  <- which lake partitions are complete (optional)

Offsets are committed in the query checkpoint only after the batch function
returns. A retried batch replaces its own files; a batch that comes again
under another query or a fresh checkpoint finds its log positions stored and
adds nothing; a batch number used by two queries for different records names
two sets of files. So a restarted query, a lost executor (recomputed from the
replayable source) or a reset checkpoint gives the same tables: effectively
exactly-once over three sinks. The append path is stateless, so late ticks are
written, never dropped.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticklake.functions import jsonx
from ticklake.operators import deadletter as DL
from ticklake.operators import normalize as N
from ticklake.operators import sinks as SK
from ticklake.operators import tables as TB
from ticklake.schemas import CAP, CHANGE, CHECKPOINT_INTERVAL, KEY, PRICE, TOPIC_SNAPSHOTS, TOPIC_TRADES
from ticklake.session import ensure_conf
from ticklake.streaming import commits as CM

# default source per topic when a message has none
TOPIC_FEED = {TOPIC_SNAPSHOTS: "coingecko", TOPIC_TRADES: "binance"}
RAW_OUT = ("coin_id", "source", "symbol", "price_usd", "market_cap", "change_24h", "recorded_at", "ingested_at", "dt")
POSITION = ("topic", "partition", "offset")  # names a record for good
LAKE_OUT = ("symbol", "price_usd", "market_cap", "change_24h", "recorded_at", "source", "coin_id", "dt")


@dataclass(frozen=True)
class Paths:
    raw: str
    lake: str
    dlq: str
    checkpoint: str
    commits: str | None = None  # the ledger of complete partitions, if one is kept


def _feed(topic_col: str = "topic"):
    m = F.create_map(*[F.lit(x) for kv in TOPIC_FEED.items() for x in kv])
    return F.coalesce(F.element_at(m, F.col(topic_col)), F.col(topic_col))


def classify_and_type(batch: DataFrame, *, compat: bool = False) -> DataFrame:
    """One parse per message: the dead-letter reason and the typed fields."""
    logged = jsonx.with_variant(batch, "value")
    v = F.col("_v")
    return logged.select("topic", "partition", "offset", "timestamp", "value",
                         DL.reason(v, compat=compat).alias("reason"), *N.typed_fields(v, _feed()))


def split_batch(batch: DataFrame, *, compat: bool = False, typed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(good typed rows, dead letters with their log positions) of one batch of log records."""
    typed = typed if typed is not None else classify_and_type(batch, compat=compat)
    good = N.accepted(typed.drop("value"))
    dead = DL.dead_letters(typed, topic="topic", value="value", ts="timestamp", keep=POSITION)
    return good, dead


def to_raw(good: DataFrame, ingested_at=None) -> DataFrame:
    """Typed rows in the raw table's types. Prices fit, the others are dead
    letters; a cap or change out of range becomes NULL (decimal casts may not
    fail the stream)."""
    ing = ingested_at if ingested_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return good.select(
        "coin_id", "source", "symbol",
        F.col("price_usd").try_cast(PRICE).alias("price_usd"),
        F.col("market_cap").try_cast(CAP).alias("market_cap"),
        F.col("change_24h").try_cast(CHANGE).alias("change_24h"),
        "recorded_at", ing.alias("ingested_at"), "dt", "timestamp", "partition", "offset")


def process_batch(batch: DataFrame, batch_id: int, paths: Paths, *, query_id: str = "batch", compat: bool = False,
                  dlq_format: str = "parquet") -> None:
    """Write one micro-batch to raw, lake and dead letters (idempotent)."""
    ensure_conf(batch.sparkSession)
    name = f"{query_id}-{batch_id}"
    # the parsed batch is used by three writes: persist it once (recomputed
    # from the replayable source if an executor is lost)
    b = classify_and_type(batch, compat=compat).persist()
    try:
        good, dead = split_batch(batch, typed=b)

        def raw() -> None:
            SK.upsert_by_key(to_raw(good).select(*RAW_OUT, "timestamp", "partition", "offset"), paths.raw,
                             list(KEY), ["timestamp", "partition", "offset"])

        def lake() -> None:
            SK.append_lake(good.select(*LAKE_OUT, *POSITION), paths.lake, name, ids=POSITION)

        def dlq() -> None:
            if dlq_format == "json":
                # the dead-letter topic's value: one JSON record per line
                (DL.to_dlq_json(dead).withColumn(SK.BATCH_COL, F.lit(name))
                 .write.mode("overwrite").partitionBy(SK.BATCH_COL).text(paths.dlq))
            else:
                SK.append_batch(dead.withColumn("dt", F.date_format("failed_at", "yyyy-MM-dd")), paths.dlq, name, ("dt",), ids=POSITION)

        # fill the cache once, then three independent writes as concurrent jobs
        b.count()
        with ThreadPoolExecutor(max_workers=3) as pool:
            for f in [pool.submit(fn) for fn in (raw, lake, dlq)]:
                f.result()
        if paths.commits:
            CM.advance(batch.sparkSession, paths.lake, paths.commits, name, good)
    finally:
        b.unpersist()


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a query keeps for the life of its checkpoint, from the checkpoint's metadata."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def run_stream(spark: SparkSession, log: DataFrame, paths: Paths, *, trigger: str | None = CHECKPOINT_INTERVAL,
               available_now: bool = False, compat: bool = False, name: str | None = None,
               dlq_format: str = "parquet") -> StreamingQuery:
    """Start the ingest query (``log`` is a streaming log DataFrame)."""
    ensure_conf(spark)
    # live counters (no extra job): messages per topic-feed, reported in each progress event
    log = log.observe("ingest_counters", F.count(F.lit(1)).alias("messages"),
                      F.count_if(F.col("topic") == TOPIC_SNAPSHOTS).alias("snapshot_messages"),
                      F.count_if(F.col("topic") == TOPIC_TRADES).alias("trade_messages"))
    ids: list[str] = []

    def each(df: DataFrame, batch_id: int) -> None:
        if not ids:
            ids.append(query_id(df.sparkSession, paths.checkpoint))
        process_batch(df, batch_id, paths, query_id=ids[0], compat=compat, dlq_format=dlq_format)

    w = (log.writeStream
         .foreachBatch(each)
         .option("checkpointLocation", paths.checkpoint))
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def read_raw(spark: SparkSession, paths: Paths) -> DataFrame:
    return TB.read_table(spark, paths.raw).select(*RAW_OUT)


def read_dead_letters(spark: SparkSession, paths: Paths) -> DataFrame:
    return spark.read.parquet(paths.dlq).drop(SK.BATCH_COL, "dt", *POSITION)
