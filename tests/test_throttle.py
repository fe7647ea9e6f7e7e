"""Per-key throttle: unit case, boundary, and equality with a sequential loop,
between bucketed and plain chain detection, and between batch and stream."""
import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_CHECK, rows
from ticklake.operators.throttle import throttle
from ticklake.sources import derived as D
from ticklake.streaming.throttle_stream import read_throttled, throttle_batch, throttle_stream


def _df(spark, data):
    return spark.createDataFrame(data, "id long, coin_id string, ts string").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))


def test_first_kept_second_dropped_other_key_kept(spark):
    df = _df(spark, [(1, "bitcoin", "2024-01-01 00:00:00"), (2, "bitcoin", "2024-01-01 00:00:05"),
                     (3, "ethereum", "2024-01-01 00:00:05")])
    assert sorted(r.id for r in throttle(df, "coin_id", "ts", 10).collect()) == [1, 3]


def test_exactly_n_later_is_kept(spark):
    df = _df(spark, [(1, "bitcoin", "2024-01-01 00:00:00"), (2, "bitcoin", "2024-01-01 00:00:10"),
                     (3, "bitcoin", "2024-01-01 00:00:19.999999"), (4, "bitcoin", "2024-01-01 00:00:20")])
    assert sorted(r.id for r in throttle(df, "coin_id", "ts", 10).collect()) == [1, 2, 4]


def _sequential(events, seconds):
    last, kept = {}, set()
    for r in sorted(events, key=lambda r: (r["ts"], r["event_id"])):
        k = r["coin_id"]
        if k not in last or (r["ts"] - last[k]) >= dt.timedelta(seconds=seconds):
            last[k] = r["ts"]
            kept.add(r["event_id"])
    return kept


def test_equals_sequential_loop_on_fixture(spark):
    ticks = D.tick_base(D.table(spark, SF_CHECK, "events")).select("event_id", "coin_id", "ts")
    data = rows(ticks)
    for n in (600, 3600):
        want = _sequential(data, n)
        got = {r.event_id for r in throttle(ticks, "coin_id", "ts", n, tie_break=("event_id",)).collect()}
        plain = {r.event_id for r in throttle(ticks, "coin_id", "ts", n, tie_break=("event_id",),
                                              bucket_seconds=None).collect()}
        assert got == want == plain
    assert len(_sequential(data, 600)) == 6859


def test_dense_single_chain_streams_through_small_batches(spark):
    """One long chain (every gap < N) crossing many Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        data = [(i, "bitcoin", f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}") for i in range(300)]
        got = sorted(r.id for r in throttle(_df(spark, data), "coin_id", "ts", 7).collect())
        assert got == list(range(0, 300, 7))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_stream_matches_batch(spark, tmp_dir):
    """Ticks arriving as three time-ordered files, one per micro-batch."""
    from ticklake.sources.log import NTZ_FORMAT, land_files
    df = _df(spark, [(i, "bitcoin" if i % 3 else "solana", f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}")
                     for i in range(180)])
    land_files(df, f"{tmp_dir}/in", "ts", files=3)
    src = (spark.readStream.schema("id long, coin_id string, ts timestamp_ntz").option("timestampNTZFormat", NTZ_FORMAT)
           .option("maxFilesPerTrigger", "1").json(f"{tmp_dir}/in"))
    throttle_stream(src, "coin_id", "ts", 7, path=f"{tmp_dir}/out", checkpoint=f"{tmp_dir}/ck", tie_break=("id",),
                    available_now=True).awaitTermination()
    stream = {r.id for r in read_throttled(spark, f"{tmp_dir}/out").collect()}
    batch = {r.id for r in throttle(df, "coin_id", "ts", 7).collect()}
    assert stream == batch


def test_random_chains_across_tiny_batches(spark):
    """Mixed singleton and long chains, several keys, Arrow batches of 3 rows."""
    import random
    rnd = random.Random(7)
    data, base = [], dt.datetime(2024, 1, 1)
    for key in ("bitcoin", "ethereum", "solana"):
        t = base
        for i in range(400):
            t += dt.timedelta(seconds=rnd.choice([1, 2, 3, 5, 8, 13, 30]))
            data.append({"event_id": len(data), "coin_id": key, "ts": t})
    df = spark.createDataFrame([(r["event_id"], r["coin_id"], r["ts"].isoformat(sep=" ")) for r in data],
                               "event_id long, coin_id string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        for n in (4, 10, 25):
            got = {r.event_id for r in throttle(df, "coin_id", "ts", n, tie_break=("event_id",), partitions=2).collect()}
            assert got == _sequential(data, n), n
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_hot_buckets_split_at_quantiles(spark):
    """With a tiny per-task bound every hour bucket is split; results are unchanged."""
    ticks = D.tick_base(D.table(spark, SF_CHECK, "events")).select("event_id", "coin_id", "ts")
    from ticklake.operators.keyed import segments
    seg = segments(ticks, ["coin_id"], "ts", bucket_seconds=30 * 86400, max_rows=100)
    sizes = [r["n"] for r in rows(seg.groupBy("coin_id", "_seg").agg(F.count(F.lit(1)).alias("n")))]
    assert max(sizes) < 300 and len(sizes) > 5 * 10
    want = {r.event_id for r in throttle(ticks, "coin_id", "ts", 600, tie_break=("event_id",), bucket_seconds=None).collect()}
    got = {r.event_id for r in throttle(ticks, "coin_id", "ts", 600, tie_break=("event_id",),
                                        bucket_seconds=30 * 86400, max_rows=100).collect()}
    assert got == want


def _dense(spark, seed=3, n=1500, id_base=0):
    import random
    rnd = random.Random(seed)
    data = []
    for key in ("bitcoin", "ethereum", "solana"):
        t = dt.datetime(2024, 1, 1)
        for _ in range(n):
            t += dt.timedelta(seconds=rnd.choice([1, 2, 3, 5, 8]), microseconds=rnd.randint(0, 999999))
            data.append({"event_id": id_base + len(data), "coin_id": key, "ts": t})
    df = spark.createDataFrame([(r["event_id"], r["coin_id"], r["ts"].isoformat(sep=" ")) for r in data],
                               "event_id long, coin_id string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return data, df


def test_block_parallel_throttle_on_unbroken_dense_chains(spark):
    """Every key is one chain (all gaps < N): blocks + pointer jumping = sequential rule."""
    data, df = _dense(spark)
    for n in (9, 25):
        got = {r.event_id for r in throttle(df, "coin_id", "ts", n, tie_break=("event_id",), bucket_seconds=60,
                                            algorithm="blocks").collect()}
        assert got == _sequential(data, n), n


def test_auto_routes_long_chains_to_blocks(spark):
    data, df = _dense(spark, seed=5, n=600, id_base=10_000_000)
    ticks = D.tick_base(D.table(spark, SF_CHECK, "events")).select("event_id", "coin_id", "ts")
    mixed = df.unionByName(ticks.where(F.col("coin_id").isin("error", "signup")))
    want = _sequential(data + rows(ticks.where(F.col("coin_id").isin("error", "signup"))), 9)
    got = {r.event_id for r in throttle(mixed, "coin_id", "ts", 9, tie_break=("event_id",), bucket_seconds=60,
                                        long_chain_rows=100).collect()}
    assert got == want


def test_stream_batches_of_dense_keys_split_into_small_groups(spark, tmp_dir):
    """Bursts of single chains in every micro-batch, groups of at most some hundred rows; batches done again change
    nothing, and neither do late ticks."""
    data, df = _dense(spark, seed=11, n=900)
    span = [(0, 1200), (1200, 2500), (2500, 10**9)]
    start = dt.datetime(2024, 1, 1)
    cut = [df.where((F.col("ts") >= F.lit(start + dt.timedelta(seconds=a))) & (F.col("ts") < F.lit(start + dt.timedelta(seconds=min(b, 10**7)))))
           for a, b in span]
    late = cut[0].withColumn("event_id", F.col("event_id") + 100_000)
    options = {"tie_break": ("event_id",), "long_chain_rows": 200, "max_rows": 150, "bucket_seconds": 60}
    for k, b in [(0, cut[0]), (1, cut[1].unionByName(late)), (1, cut[1].unionByName(late)), (0, cut[0]), (1, cut[1]), (2, cut[2])]:
        throttle_batch(b, k, tmp_dir, "coin_id", "ts", 25, **options)
    got = {r.event_id for r in read_throttled(spark, tmp_dir).collect()}
    assert got == _sequential(data, 25)
    # a block is 60 s of one chain: the groups that tasks hold
    sizes = df.groupBy("coin_id", F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 60)).count().agg(F.max("count")).first()[0]
    assert sizes < 60 and df.groupBy("coin_id").count().agg(F.max("count")).first()[0] == 900


def test_stream_state_is_a_row_a_key(spark, tmp_dir):
    for k in range(6):
        throttle_batch(_df(spark, [(k, None if k % 2 else "a", f"2024-01-01 00:00:{k:02d}")]), k, tmp_dir, "coin_id", "ts", 2)
    from ticklake.session import folders
    assert len(folders(spark, f"{tmp_dir}/state")) <= 4
    assert sorted(r.id for r in read_throttled(spark, tmp_dir).collect()) == [0, 1, 2, 3, 4, 5]
    throttle_batch(_df(spark, []), 6, tmp_dir, "coin_id", "ts", 2)
    assert read_throttled(spark, tmp_dir).count() == 6
