"""The streaming ingest equals the batch plan, and replays are no-ops."""
import __spark_entry__ as E
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from ticklake.sources import derived as D
from ticklake.sources import log as L
from ticklake.streaming import stream as ST
from ticklake.streaming.progress import progress_frame


def test_stream_replay_and_batch_equality(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    L.land_log(L.log_records(D.raw_log(D.table(spark, SF_SMALL, "events"))), landing, files=3)
    paths = ST.Paths(f"{tmp_dir}/raw", f"{tmp_dir}/lake", f"{tmp_dir}/dlq", f"{tmp_dir}/ck")
    q = ST.run_stream(spark, L.read_log(spark, landing, max_files_per_trigger=1), paths, available_now=True,
                      name="ingest_test")
    q.awaitTermination()
    prog = progress_frame(spark, q)
    assert prog.agg(F.sum("input_rows")).first()[0] == 1000
    assert prog.agg(F.sum(F.col("observed")["ingest_counters.messages"])).first()[0] == 1000
    raw1 = rows(ST.read_raw(spark, paths).drop("ingested_at"), ["coin_id", "source", "recorded_at"])
    lake1 = spark.read.parquet(paths.lake).count()
    # a second query over the same landing dir, with a new checkpoint and batches of two files
    paths2 = ST.Paths(paths.raw, paths.lake, paths.dlq, f"{tmp_dir}/ck2")
    ST.run_stream(spark, L.read_log(spark, landing, max_files_per_trigger=2), paths2, available_now=True).awaitTermination()
    assert rows(ST.read_raw(spark, paths).drop("ingested_at"), ["coin_id", "source", "recorded_at"]) == raw1
    assert spark.read.parquet(paths.lake).count() == lake1
    # accepted + rejected = input
    good, dead = ST.split_batch(L.read_log(spark, landing, streaming=False))
    assert good.count() + dead.count() == 1000
    assert ST.read_dead_letters(spark, paths).count() == dead.count()


def _ticks(spark, offsets):
    """Log records at the given offsets, each its own key."""
    return spark.createDataFrame(
        [("binance.trades.raw", None, f'{{"coin_id": "solana", "price_usd": {o + 1}, "event_time": "2024-03-01T00:00:{o:02d}.000000+00:00"}}', 0, o)
         for o in offsets], "topic string, key string, value string, partition int, offset long").withColumn(
        "timestamp", F.lit("2024-03-01 01:00:00").cast("timestamp_ntz"))


def test_equal_batch_numbers_of_two_queries_lose_nothing(spark, tmp_dir):
    """Five ticks as batch 0 of one query, seven others as batch 0 of another: twelve in raw and lake.
    The same again under third names changes nothing."""
    paths = ST.Paths(f"{tmp_dir}/raw", f"{tmp_dir}/lake", f"{tmp_dir}/dlq", f"{tmp_dir}/ck")
    for name in ("q1", "q2", "q1", "q3"):
        ST.process_batch(_ticks(spark, range(5) if name == "q1" else range(5, 12)), 0, paths, query_id=name)
        if name == "q2":
            assert ST.read_raw(spark, paths).count() == spark.read.parquet(paths.lake).count() == 12
    assert ST.read_raw(spark, paths).count() == spark.read.parquet(paths.lake).count() == 12


def test_unusable_prices_are_dead_letters(spark, tmp_dir):
    paths = ST.Paths(f"{tmp_dir}/raw", f"{tmp_dir}/lake", f"{tmp_dir}/dlq", f"{tmp_dir}/ck")
    bad = _ticks(spark, range(4)).withColumn("value", F.expr(
        "replace(value, concat('\"price_usd\": ', offset + 1), concat('\"price_usd\": ', element_at(array('\"NaN\"', '1e40', '\"-Infinity\"', '5'), cast(offset + 1 as int))))"))
    ST.process_batch(bad, 0, paths)
    assert [float(r.price_usd) for r in ST.read_raw(spark, paths).collect()] == [5.0]
    assert {r.reason for r in ST.read_dead_letters(spark, paths).collect()} == {"missing_or_invalid_price_usd"}
    assert ST.read_dead_letters(spark, paths).count() == 3


def test_kafka_options():
    o = L.kafka_source_options("broker:9093", max_offsets_per_trigger=500)
    assert o["failOnDataLoss"] == "true" and o["startingOffsets"] == "earliest" and o["kafka.isolation.level"] == "read_committed"
    assert o["subscribe"] == "coingecko.prices.raw,binance.trades.raw" and o["maxOffsetsPerTrigger"] == "500"
    s = L.kafka_sink_options("broker:9093")
    assert s["kafka.acks"] == "all" and s["kafka.enable.idempotence"] == "true" and s["topic"] == "prices.dead-letter"


def test_publish_keys(spark):
    df = spark.createDataFrame([("bitcoin", "btc", 1.0, None, None, "t", "binance")],
                               "coin_id string, symbol string, price_usd double, market_cap double, change_24h double, "
                               "event_time string, source string")
    r = L.to_log(df, key_cols=("coin_id", "source")).first()
    assert r.key == "bitcoin:binance" and '"market_cap":null' in r.value


def test_dlq_topic_and_monitor_stream(spark, tmp_dir):
    """Ingest writes dead letters as topic JSON; the monitor stream counts them."""
    from ticklake.operators.deadletter import classify, dead_letters
    from ticklake.streaming.dlq_monitor import run_monitor
    landing = f"{tmp_dir}/landing"
    recs = L.log_records(D.raw_log(D.table(spark, SF_SMALL, "events")))
    L.land_log(recs, landing, files=2)
    paths = ST.Paths(f"{tmp_dir}/raw", f"{tmp_dir}/lake", f"{tmp_dir}/dlq", f"{tmp_dir}/ck")
    ST.run_stream(spark, L.read_log(spark, landing, max_files_per_trigger=1), paths, available_now=True,
                  dlq_format="json").awaitTermination()
    run_monitor(spark, paths.dlq, f"{tmp_dir}/counters", f"{tmp_dir}/ck-mon", available_now=True).awaitTermination()
    got = {(r["source_topic"], r["reason"]): r["messages"] for r in rows(spark.read.parquet(f"{tmp_dir}/counters"))}
    want = {(r["source_topic"], r["reason"]): r["count"] for r in rows(
        dead_letters(classify(D.raw_log(D.table(spark, SF_SMALL, "events")))).groupBy("source_topic", "reason").count())}
    assert got == want and sum(got.values()) > 0


def test_landing_is_one_job_and_keeps_the_order(spark, tmp_dir):
    """However many files, one job writes them; a stream that takes one at a time gets them by offset."""
    from ticklake.session import file_times
    recs = L.log_records(D.raw_log(D.table(spark, SF_SMALL, "events")))
    jobs = []
    for files in (2, 6):
        spark.sparkContext.setJobGroup(f"landing-{files}", "landing")
        L.land_log(recs, f"{tmp_dir}/{files}", files=files)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"landing-{files}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]
    times = file_times(spark, f"{tmp_dir}/6")
    assert len(times) == 6 and len(set(times.values())) == 6
    spans = [spark.read.schema("offset long").json(f"{tmp_dir}/6/{n}").agg(F.min("offset"), F.max("offset")).first()
             for n in sorted(times, key=times.get)]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    back = L.read_log(spark, f"{tmp_dir}/6", streaming=False).select(*recs.columns)
    assert back.exceptAll(recs).isEmpty() and back.count() == recs.count()


def test_landing_with_empty_ranges_keeps_every_record(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (100, "c"), (None, "d")], "n long, s string")
    L.land_files(df, tmp_dir + "/gap", "n", files=5)
    assert sorted(r.s for r in spark.read.schema("n long, s string").json(tmp_dir + "/gap").collect()) == ["a", "b", "c"]
