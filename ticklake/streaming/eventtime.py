"""Event time on the stream: a watermark, deduplication inside it, windowed rates.

The append path (``stream``) needs no watermark: it writes late ticks like any
others. Here state is kept, and the watermark bounds it: a record's position
is remembered until event time has passed it by ``delay``, a window until
event time has passed its end. Rows older than the watermark that the batch
before used are dropped and counted; the counts are in the progress reports
(``progress.late_rows``), the rows themselves in the tables of the append path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticklake.operators import normalize as N
from ticklake.schemas import WATERMARK_DELAY
from ticklake.streaming import stream as ST

POSITION = ("topic", "partition", "offset")


def accepted_events(log: DataFrame) -> DataFrame:
    """Accepted rows of a streaming log with ``event_ts``, their event time as an instant."""
    good = N.accepted(ST.classify_and_type(log).drop("value"))
    return good.withColumn("event_ts", F.col("recorded_at").cast("timestamp"))


def once(events: DataFrame, *, keys: tuple[str, ...] = POSITION, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Each key once, as long as its copies are no later than the watermark allows."""
    return events.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(list(keys))


def rates(events: DataFrame, *, window: str = "5 minutes", slide: str = "1 minute", seconds: int = 300) -> DataFrame:
    """Messages of a source per second over sliding windows of event time; a window comes out once, when it is closed."""
    w = F.window("event_ts", window, slide).alias("w")
    return (events.groupBy(w, "source").agg(F.count(F.lit(1)).alias("messages"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                    "source", "messages", (F.col("messages") / F.lit(float(seconds))).alias("msgs_per_sec")))


def run_rates(log: DataFrame, out: str, checkpoint: str, *, available_now: bool = False, trigger: str | None = None,
              delay: str = WATERMARK_DELAY, name: str | None = None) -> StreamingQuery:
    """Append the closed windows of deduplicated messages to the Parquet table at ``out``."""
    w = (rates(once(accepted_events(log), delay=delay)).writeStream.format("parquet").outputMode("append")
         .option("path", out).option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()
