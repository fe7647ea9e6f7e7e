"""Event time on the stream: late rows, complete partitions, offsets of progress reports."""
import json

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from ticklake.operators import sinks as SK
from ticklake.sources import derived as D
from ticklake.sources import log as L
from ticklake.streaming import commits as CM
from ticklake.streaming import progress as PR
from ticklake.streaming import stream as ST


def ticks(spark, data):
    """Accepted rows (coin, event time, offset) of one feed, as the lake takes them."""
    df = spark.createDataFrame(data, "coin_id string, recorded_at string, offset long")
    df = df.withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))
    return df.select(F.lit("btc").alias("symbol"), F.lit(1.0).alias("price_usd"), F.lit(None).cast("double").alias("market_cap"),
                     F.lit(None).cast("double").alias("change_24h"), "recorded_at", F.lit("binance").alias("source"), "coin_id",
                     F.date_format("recorded_at", "yyyy-MM-dd").alias("dt"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset")


class Lake:
    def __init__(self, spark, folder):
        self.spark, self.lake, self.ledger = spark, f"{folder}/lake", f"{folder}/ledger"

    def batch(self, name, data):
        b = ticks(self.spark, data)
        SK.append_lake(b, self.lake, name, ids=ST.POSITION)
        CM.advance(self.spark, self.lake, self.ledger, name, b)
        return self.status()

    def status(self):
        return {(r["coin_id"], r["dt"][-2:]): (r["n_rows"], r["complete"], r["commits"], r["reopens"])
                for r in rows(CM.partition_status(self.spark, self.ledger))}


def test_a_day_is_complete_a_minute_after_event_time_has_passed_it(spark, tmp_dir):
    lake = Lake(spark, tmp_dir)
    assert lake.batch("q-0", [("a", "2024-01-01 10:00:00", 1), ("b", "2024-01-01 11:00:00", 2)]) == {("a", "01"): (1, False, 0, 0), ("b", "01"): (1, False, 0, 0)}
    # 15 s of watermark and a minute more: 00:01:14.999 is too early, 00:01:15 is not
    assert not lake.batch("q-1", [("a", "2024-01-02 00:01:14.999", 3)])["a", "01"][1]
    got = lake.batch("q-2", [("a", "2024-01-02 00:01:15", 4)])
    assert got == {("a", "01"): (1, True, 1, 0), ("b", "01"): (1, True, 1, 0), ("a", "02"): (2, False, 0, 0)}
    # a late row reopens its day, which is committed anew with it; the other stays
    got = lake.batch("q-3", [("b", "2024-01-01 12:00:00", 5)])
    assert got["b", "01"] == (2, True, 2, 1) and got["a", "01"] == (1, True, 1, 0)
    last = CM.read_events(spark, lake.ledger).where("event = 'commit' AND coin_id = 'b'").orderBy("seq").collect()
    assert [r["n"] for r in last] == [1, 2]


def test_batches_written_again_move_nothing(spark, tmp_dir):
    lake = Lake(spark, tmp_dir)
    lake.batch("q-0", [("a", "2024-01-01 10:00:00", 1)])
    late = [("a", "2024-01-05 10:00:00", 2), ("c", "2024-01-01 10:00:00", 3)]
    want = lake.batch("q-1", late)
    assert want == {("a", "01"): (1, True, 1, 0), ("c", "01"): (1, True, 1, 0), ("a", "05"): (1, False, 0, 0)}
    assert lake.batch("q-1", late) == want                                  # a retry replaces its own entries
    assert lake.batch("other-0", late) == want                              # a replay under another name lands nothing
    assert lake.batch("q-2", [("a", "2024-01-05 11:00:00", 4)])["a", "05"] == (2, False, 0, 0)


def test_the_ledger_is_read_from_the_oldest_open_day(spark, tmp_dir):
    lake = Lake(spark, tmp_dir)
    for k in range(1, 6):
        lake.batch(f"q-{k}", [("a", f"2024-01-{k:02d} 10:00:00", k)])
    clock = spark.read.schema(CM.CLOCK).parquet(f"{lake.ledger}/clock").orderBy("seq").collect()
    assert [r["oldest_open"] for r in clock] == [f"2024-01-{k:02d}" for k in range(1, 6)]
    assert sum(v[1] for v in lake.status().values()) == 4


def test_late_rows_are_written_by_the_append_path(spark, tmp_dir):
    """The ledger changes nothing in raw, lake and dead letters."""
    landing = f"{tmp_dir}/landing"
    L.land_files(D.arrivals(D.table(spark, SF_SMALL, "events")), landing, "arrival", files=3)
    log = L.read_log(spark, landing, max_files_per_trigger=1)
    plain = ST.Paths(f"{tmp_dir}/raw", f"{tmp_dir}/lake", f"{tmp_dir}/dlq", f"{tmp_dir}/ck")
    kept = ST.Paths(f"{tmp_dir}/raw2", f"{tmp_dir}/lake2", f"{tmp_dir}/dlq2", f"{tmp_dir}/ck2", f"{tmp_dir}/commits")
    for p in (plain, kept):
        ST.run_stream(spark, log, p, available_now=True).awaitTermination()
    key = ["coin_id", "source", "recorded_at"]
    assert rows(ST.read_raw(spark, plain).drop("ingested_at"), key) == rows(ST.read_raw(spark, kept).drop("ingested_at"), key)
    total = CM.partition_status(spark, kept.commits).agg(F.sum("n_rows")).first()[0]
    assert spark.read.parquet(plain.lake).count() == spark.read.parquet(kept.lake).count() == total


REPORT = {"name": "ingest", "batchId": 7, "timestamp": "2024-01-01T00:00:30.000Z", "numInputRows": 150, "inputRowsPerSecond": 5.0,
          "processedRowsPerSecond": 10.0, "eventTime": {"watermark": "2024-01-01T00:00:15.000Z"},
          "stateOperators": [{"numRowsDroppedByWatermark": 4, "customMetrics": {"numDroppedDuplicateRows": 2}}, {"numRowsDroppedByWatermark": 1}],
          "sources": [{"description": "log", "startOffset": {"a": {"0": 10, "1": 5}}, "endOffset": {"a": {"0": 110, "1": 55}, "b": {"0": 3}},
                       "latestOffset": {"a": {"0": 160, "1": 55}, "b": {"0": 9}}},
                      {"description": "files", "startOffset": '{"logOffset": 3}', "endOffset": '{"logOffset": 4}', "latestOffset": None}]}


def test_offsets_of_a_report_give_lag_by_partition(spark):
    p = PR._frame(spark, [PR._row(json.loads(json.dumps(REPORT)))])
    lag = {(r["source"], r["part"]): (r["records"], r["end"], r["latest"], r["lag"]) for r in PR.source_lag(p).collect()}
    assert lag == {("log", "a/0"): (100, 110, 160, 50), ("log", "a/1"): (50, 55, 55, 0), ("log", "b/0"): (3, 3, 9, 6),
                   ("files", "logOffset"): (1, 4, None, None)}
    row = PR.late_rows(p).first()
    assert (row["late_rows"], row["duplicate_rows"], str(row["watermark"])) == (5, 2, "2024-01-01 00:00:15")


def test_reports_are_written_together(spark, tmp_dir):
    table = PR.ProgressTable(spark, f"{tmp_dir}/progress", every=3)

    class Event:
        class progress:  # noqa: N801
            json = json.dumps(REPORT)
    for _ in range(4):
        table.onQueryProgress(Event)
    assert PR.read_progress(spark, f"{tmp_dir}/progress").count() == 3
    table.onQueryTerminated(None)
    assert PR.read_progress(spark, f"{tmp_dir}/progress").count() == 4
    assert len(spark.read.parquet(f"{tmp_dir}/progress").inputFiles()) == 2
