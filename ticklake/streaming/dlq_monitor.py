"""Dead-letter monitor: a streaming query over the dead-letter topic.

Each message is parsed by the never-failing dead-letter parser, logged
counts per (source_topic, reason) are kept as streaming aggregation state
(bounded by the number of topics x reasons), and every trigger rewrites a
small counters table. On Kafka the input is the DLQ topic; here it is a
directory of its JSON lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticklake.operators.deadletter import parse_dead_letters
from ticklake.session import ensure_conf


def read_dlq_messages(spark: SparkSession, path: str, *, streaming: bool = True) -> DataFrame:
    """Dead-letter topic messages (one per line) as bytes in ``value``."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("text").load(path).select(F.col("value").cast("binary").alias("value"))


def dlq_counts(msgs: DataFrame) -> DataFrame:
    parsed = parse_dead_letters(msgs)
    return parsed.groupBy("source_topic", "reason").agg(F.count(F.lit(1)).alias("messages"))


def run_monitor(spark: SparkSession, dlq_path: str, counters_path: str, checkpoint: str, *,
                available_now: bool = False, trigger: str = "30 seconds") -> StreamingQuery:
    """Keep ``counters_path`` equal to the message counts seen so far."""
    ensure_conf(spark)
    counts = dlq_counts(read_dlq_messages(spark, dlq_path))

    def publish(df: DataFrame, batch_id: int) -> None:
        # complete mode hands over the whole (small) counter table each trigger
        df.write.mode("overwrite").parquet(counters_path)

    w = counts.writeStream.outputMode("complete").foreachBatch(publish).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()
