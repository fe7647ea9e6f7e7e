"""Log sources and sinks: Kafka options, the file stand-in, payload landing dirs.

The Kafka connector jar is not part of this environment; the option
builders are complete and tested, and every pipeline also runs on the file
stand-in, which has the same columns as a Kafka read:
``topic, key, value, partition, offset, timestamp``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.schemas import LOG, TOPIC_DLQ, TOPIC_SNAPSHOTS, TOPIC_TRADES
from ticklake.session import file_times, remove_path, set_file_time

LOG_COLUMNS = ("topic", "key", "value", "partition", "offset", "timestamp")
NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def kafka_source_options(bootstrap: str, topics: tuple[str, ...] = (TOPIC_SNAPSHOTS, TOPIC_TRADES), *,
                         group_prefix: str = "ticklake", starting: str = "earliest",
                         max_offsets_per_trigger: int | None = None, min_partitions: int | None = None) -> dict[str, str]:
    """Reader options: earliest start, committed reads only, offsets kept in the
    query checkpoint (no auto commit), a failure instead of a gap when records have aged out, session/request timeouts and backoff."""
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "groupIdPrefix": group_prefix,
        "failOnDataLoss": "true",
        "kafka.isolation.level": "read_committed",
        "kafka.session.timeout.ms": "45000",
        "kafka.request.timeout.ms": "60000",
        "kafka.retry.backoff.ms": "1000",
        "kafka.reconnect.backoff.max.ms": "10000",
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    return opts


def kafka_sink_options(bootstrap: str, topic: str = TOPIC_DLQ) -> dict[str, str]:
    """Durable producer settings: acks=all, idempotence, retries, timeouts."""
    return {
        "kafka.bootstrap.servers": bootstrap,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        "kafka.retries": "10",
        "kafka.delivery.timeout.ms": "120000",
        "kafka.request.timeout.ms": "30000",
        "kafka.max.in.flight.requests.per.connection": "5",
    }


def _project(df: DataFrame) -> DataFrame:
    return df.select(
        "topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "partition", "offset", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


def read_log(spark: SparkSession, path_or_bootstrap: str, *, streaming: bool = True, kafka: bool = False,
             options: dict[str, str] | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """One read of the feed topics: (topic, key, value, partition, offset, timestamp).

    ``kafka=True`` reads the brokers at ``path_or_bootstrap``; otherwise the
    file stand-in: JSON-lines log records with the LOG schema.
    """
    reader = spark.readStream if streaming else spark.read
    if kafka:
        opts = kafka_source_options(path_or_bootstrap)
        opts.update(options or {})
        return _project(reader.format("kafka").options(**opts).load())
    r = reader.schema(LOG).option("timestampNTZFormat", NTZ_FORMAT).options(**(options or {}))
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.json(path_or_bootstrap).select(*LOG_COLUMNS)


def log_records(raw_log: DataFrame) -> DataFrame:
    """Derived log messages as Kafka-shaped records (offset = event id;
    record timestamps have millisecond precision, as Kafka's do)."""
    return raw_log.select(
        "topic", F.lit(None).cast("string").alias("key"), F.col("raw_value").alias("value"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
        F.date_trunc("millisecond", F.col("kafka_ts")).cast("timestamp_ntz").alias("timestamp"))


def _land_together(df: DataFrame, path: str, order: str, files: int) -> bool:
    """Write file ``_part`` = 0, 1, .. of ``df`` in a task each; False, with nothing left behind, if that didn't give ``files`` files in order."""
    spark = df.sparkSession
    before = file_times(spark, path)
    (df.where(F.col("_part").between(0, files - 1)).repartitionById(files, "_part").sortWithinPartitions(order).drop("_part")
     .write.mode("append").option("timestampNTZFormat", NTZ_FORMAT).json(path))
    times = file_times(spark, path)
    new = sorted(times.keys() - before.keys())  # by task, as Spark names them
    if len(new) == files:
        first = max(times.values()) + 1
        for k, name in enumerate(new):
            set_file_time(spark, f"{path}/{name}", first + k)
        times = file_times(spark, path)
        if [times[n] for n in new] == list(range(first, first + files)):
            return True
    for name in new:
        remove_path(spark, f"{path}/{name}")
    return False


def land_files(df: DataFrame, path: str, order: str, *, files: int = 1) -> None:
    """Landing-zone simulator: ``files`` JSON-lines files, one per range of
    ``order``, so that file arrival order (what a file stream follows) equals
    ``order``. One job writes them side by side and their times are set in
    order; where a range is empty or the store keeps its own times, they are
    written one after another. Timestamps keep microseconds."""
    bounds = df.agg(F.min(order).alias("lo"), F.max(order).alias("hi")).first()
    if bounds.lo is None:
        return
    lo, hi = bounds.lo, bounds.hi
    num = lambda c: F.unix_micros(c.cast("timestamp")) if not isinstance(lo, (int, float)) else c
    epoch = _dt.datetime(1970, 1, 1)
    to_num = ((lambda v: (v.replace(tzinfo=None) - epoch) // _dt.timedelta(microseconds=1))
              if not isinstance(lo, (int, float)) else (lambda v: v))
    span = to_num(hi) - to_num(lo) + 1
    part = F.floor((num(F.col(order)) - F.lit(to_num(lo))) * F.lit(files) / F.lit(span))
    if files > 1 and _land_together(df.withColumn("_part", part.cast("int")), path, order, files):
        return
    for k in range(files):
        (df.where(part == k).coalesce(1).sortWithinPartitions(order)
         .write.mode("append").option("timestampNTZFormat", NTZ_FORMAT).json(path))


def land_log(records: DataFrame, path: str, *, files: int = 1, order: str = "offset") -> None:
    """Write log records to a landing directory in ``files`` arrival-ordered files."""
    land_files(records, path, order, files=files)


def to_log(df: DataFrame, *, key_cols: tuple[str, ...] = ("coin_id",),
           value_cols: tuple[str, ...] = ("coin_id", "symbol", "price_usd", "market_cap", "change_24h",
                                          "event_time", "source")) -> DataFrame:
    """Events -> keyed log records (key = key columns joined by ':', value =
    JSON object with nulls kept), ready for a Kafka or file writer."""
    key = F.concat_ws(":", *[F.col(c) for c in key_cols])
    val = F.to_json(F.struct(*[F.col(c) for c in value_cols]), {"ignoreNullFields": "false"})
    return df.select(key.alias("key"), val.alias("value"))


def read_payloads(spark: SparkSession, path: str, feed: str | None = None, *, streaming: bool = True, whole: bool = False,
                  received: str | None = None) -> DataFrame:
    """Landing directory of raw feed bodies: (payload, received_at, feed).

    A body is a line, or with ``whole`` a file (a poll's JSON may span lines).
    ``received_at`` is the landing file's modification time (the poll/frame
    receive time of a file-based landing zone), or where the landing place is
    laid out by receive time the partition column ``received``, in
    microseconds since the epoch."""
    reader = (spark.readStream if streaming else spark.read).format("text").option("wholetext", str(whole).lower())
    if received:
        reader = reader.schema(f"value string, {received} long")
    df = reader.load(path)
    at = F.timestamp_micros(received) if received else F.col("_metadata.file_modification_time")
    return df.select(F.col("value").alias("payload"), at.cast("timestamp_ntz").alias("received_at"), F.lit(feed).cast("string").alias("feed"))


def land_bodies(bodies: DataFrame, path: str, received: str = "received_us") -> None:
    """Write bodies (payload, received_at) as whole files below ``received``=<microseconds>/, one for each receive time."""
    micros_ = F.unix_micros(F.col("received_at").cast("timestamp")).alias(received)
    (bodies.select(F.col("payload").alias("value"), micros_).repartition(received).write.mode("append").option("lineSep", "\n")
     .partitionBy(received).text(path))
