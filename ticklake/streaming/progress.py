"""Streaming progress as a table (records out per second, consumer lag,
liveness) for the ops questions and the alerts.

``record_progress`` adds a listener that appends every progress report of the
session's queries to a Parquet table, so the history is complete;
``progress_frame`` shows what a query itself remembers, its last reports.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_SCHEMA = ("query_name string, batch_id long, batch_ts timestamp_ntz, input_rows long, "
                   "input_rows_per_second double, processed_rows_per_second double, offsets_behind long, "
                   "observed map<string, bigint>, watermark timestamp_ntz, late_rows long, duplicate_rows long, "
                   "sources array<struct<source:string,part:string,start:bigint,end:bigint,latest:bigint>>")


def _offsets(text) -> dict[str, int]:
    """Offsets of a source by partition: ``topic/partition`` of a log, or the names of a file source's own counters."""
    found = json.loads(text) if isinstance(text, str) else text
    out: dict[str, int] = {}
    for topic, parts in (found or {}).items() if isinstance(found, dict) else ():
        if isinstance(parts, dict):
            out |= {f"{topic}/{k}": int(v) for k, v in parts.items()}
        elif isinstance(parts, (int, float)):
            out[topic] = int(parts)
    return out


def _sources(p: dict) -> list[tuple]:
    out = []
    for s in p.get("sources", []):
        start, end, latest = (_offsets(s.get(k)) for k in ("startOffset", "endOffset", "latestOffset"))
        out += [(s.get("description"), k, start.get(k), end.get(k), latest.get(k)) for k in sorted({**start, **end, **latest})]
    return out


def _row(p: dict) -> tuple:
    """One progress report (its JSON form) as a row of PROGRESS_SCHEMA, times as text."""
    behind = sum(int(float((s.get("metrics") or {}).get("maxOffsetsBehindLatest", 0) or 0)) for s in p.get("sources", []))
    observed = {f"{name}.{k}": int(v) if v is not None else None
                for name, row in (p.get("observedMetrics") or {}).items() for k, v in row.items()}
    state = p.get("stateOperators") or []
    text = lambda t: t.replace("T", " ").rstrip("Z") if t else None
    return (p.get("name"), p["batchId"], text(p["timestamp"]), p["numInputRows"],
            float(p.get("inputRowsPerSecond") or 0.0), float(p.get("processedRowsPerSecond") or 0.0), behind, observed,
            text((p.get("eventTime") or {}).get("watermark")), sum(int(s.get("numRowsDroppedByWatermark") or 0) for s in state),
            sum(int((s.get("customMetrics") or {}).get("numDroppedDuplicateRows") or 0) for s in state), _sources(p))


def _frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    df = spark.createDataFrame(rows, PROGRESS_SCHEMA.replace("timestamp_ntz", "string"))
    return df.selectExpr("query_name", "batch_id", "cast(batch_ts as timestamp_ntz) as batch_ts", "input_rows",
                         "input_rows_per_second", "processed_rows_per_second", "offsets_behind", "observed",
                         "cast(watermark as timestamp_ntz) as watermark", "late_rows", "duplicate_rows", "sources")


class ProgressTable(StreamingQueryListener):
    """Appends the reports to the table at ``path``, ``every`` of them at a time and the rest when a query ends or idles."""

    def __init__(self, spark: SparkSession, path: str, every: int = 20) -> None:
        self.spark, self.path, self.every, self.held = spark, path, every, []

    def flush(self) -> None:
        rows, self.held = self.held, []
        if rows:
            _frame(self.spark, rows).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.held.append(_row(json.loads(event.progress.json)))
        if len(self.held) >= self.every:
            self.flush()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        self.flush()

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.flush()


def record_progress(spark: SparkSession, path: str) -> ProgressTable:
    """Start recording; ``spark.streams.removeListener`` ends it."""
    listener = ProgressTable(spark, path)
    spark.streams.addListener(listener)
    return listener


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The query's recent progress reports (a bounded, driver-side ring of
    metadata) as a DataFrame."""
    return _frame(spark, [_row(json.loads(p.json) if hasattr(p, "json") else p) for p in query.recentProgress])


def late_rows(progress: DataFrame) -> DataFrame:
    """Of each batch: its watermark, the records read, those dropped as later than the watermark, and copies dropped."""
    return progress.select("query_name", "batch_id", "watermark", "input_rows", "late_rows", "duplicate_rows")


def source_lag(progress: DataFrame) -> DataFrame:
    """Consumer lag of each source partition after each batch, from the offsets of the reports: records read, end, latest
    and how far the end is behind (NULL where a source doesn't report its latest offset)."""
    s = progress.select("query_name", "batch_id", "batch_ts", "processed_rows_per_second", F.explode("sources").alias("s"))
    return s.select("query_name", "batch_id", "batch_ts", F.col("s.source").alias("source"), F.col("s.part").alias("part"),
                    (F.col("s.end") - F.coalesce("s.start", F.lit(0))).alias("records"), F.col("s.end").alias("end"), F.col("s.latest").alias("latest"),
                    (F.col("s.latest") - F.col("s.end")).alias("lag"), "processed_rows_per_second")


def topic_lag(progress: DataFrame, log_ends: DataFrame, counters: dict[str, str]) -> DataFrame:
    """The same for a source without offsets of its own (files): per batch and topic the records out (an observed
    counter of the query, by topic in ``counters``), all until then, and how many of the log's records (``log_ends``:
    topic, records) are still to come."""
    names = F.array(*[F.struct(F.lit(t).alias("topic"), F.coalesce(F.col("observed")[c], F.lit(0)).alias("records_out")) for t, c in counters.items()])
    each = progress.select("query_name", "batch_id", "processed_rows_per_second", F.explode(names).alias("t")).select(
        "query_name", "batch_id", "processed_rows_per_second", "t.*")
    so_far = Window.partitionBy("query_name", "topic").orderBy("batch_id")  # a row for each batch
    each = each.withColumn("records_so_far", F.sum("records_out").over(so_far))
    return each.join(log_ends, "topic").select("query_name", "batch_id", "topic", "records_out", "records_so_far",
                                               (F.col("records") - F.col("records_so_far")).alias("lag"), "processed_rows_per_second")
