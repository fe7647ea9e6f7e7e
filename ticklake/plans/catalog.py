"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (through ``ticklake.sources.derived``)
over their full extent; ``as_of`` is the newest event time, so results are
reproducible.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.plans import bi as B
from ticklake.plans import gold as G
from ticklake.plans import silver as S
from ticklake.session import ensure_conf
from ticklake.sources import derived as D

Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """Lazily built frames of one (session, data folder)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = ensure_conf(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return D.table(self.spark, self.sf_dir, name)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def as_of(self) -> Column:
        """Newest event time (never the wall clock). Evaluated once per query
        (one aggregate over one column) and used as a literal: every report
        shares it, and time-window predicates become pushed scan filters."""
        from ticklake.functions.timefmt import as_column
        return as_column(self.events.agg(F.max("ts")).first()[0])

    @cached_property
    def raw(self) -> DataFrame:
        return D.dirty_ticks(self.events).drop("event_id")

    @cached_property
    def stg(self) -> DataFrame:
        return S.stg_prices(self.raw)

    @cached_property
    def clean(self) -> DataFrame:
        return S.clean_prices(self.stg)

    @cached_property
    def clean_table(self) -> DataFrame:
        """Silver as a scheduled run finds it: written once under the work
        folder and read back (for reports that read silver several times)."""
        from ticklake.session import work_path
        path = work_path(self.spark, "silver")
        self.clean.write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def latest(self) -> DataFrame:
        return G.latest(self.clean)

    @cached_property
    def lbs(self) -> DataFrame:
        return G.latest_by_source(self.clean)

    @cached_property
    def comparison(self) -> DataFrame:
        return G.comparison(self.lbs)

    def gold(self) -> dict[str, DataFrame]:
        return {
            "latest": self.latest,
            "latest_by_source": self.lbs,
            "comparison": self.comparison,
            "daily": G.daily(self.clean),
            "zone_volume": G.zone_volume(self.raw, self.clean, self.lbs, as_of=self.as_of),
            "freshness": G.freshness(self.lbs, as_of=self.as_of),
            "sanity": G.sanity(self.latest, self.comparison),
        }


def _q(fn: Callable[[Inputs], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Inputs(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _materialized_first_load(i: Inputs, first: DataFrame) -> DataFrame:
    """The first run's silver table, written (day-partitioned) under the
    shared work folder and read back, as a scheduled run would find it."""
    from ticklake.session import work_path
    path = work_path(i.spark, "silver-first-load")
    first.withColumn("dt", F.date_format("recorded_at", "yyyy-MM-dd")).write.partitionBy("dt").parquet(path)
    return i.spark.read.parquet(path)


def _silver_incremental(i: Inputs) -> DataFrame:
    """Two runs: a first load of everything older than a week before as_of,
    then an incremental run over the whole staging view."""
    cut = i.as_of - F.expr("INTERVAL 7 DAYS")
    first = _materialized_first_load(i, S.clean_prices(i.stg.where(F.col("recorded_at") < cut)))
    return S.clean_prices(i.stg, existing=first)


def _silver_late(i: Inputs) -> DataFrame:
    """First load holds one feed only; the incremental run's global
    high-water mark then skips the other feed's older rows."""
    first = _materialized_first_load(i, S.clean_prices(i.stg.where(F.col("source") == "coingecko")))
    return S.clean_prices(i.stg, existing=first)


def _silver_column_sync(i: Inputs) -> DataFrame:
    """Three runs over a written table whose source has a grade at first, then a venue
    instead, then both: a column is dropped from all days and comes back empty."""
    from ticklake.session import work_path
    path = work_path(i.spark, "silver-columns")
    raw = i.raw.withColumns({"grade": F.floor("price_usd").cast("long") % 10, "venue": F.upper(F.trim("source"))})
    until = lambda days: F.col("recorded_at") < i.as_of - F.expr(f"INTERVAL {days} DAYS")
    for part in (raw.drop("venue").where(until(14)), raw.drop("grade").where(until(7)), raw):
        out = S.refresh_silver(i.spark, S.stg_prices(part, S.source_columns(part)), path)
    return out


def _bi(name: str) -> Callable[[Inputs], DataFrame]:
    def f(i: Inputs) -> DataFrame:
        return B.bi(name, i.gold())
    f.__name__ = f"bi_{name}"
    return f


def catalog() -> dict[str, Query]:
    q: dict[str, Callable[[Inputs], DataFrame]] = {
        "stg_prices": lambda i: i.stg,
        "silver_clean": lambda i: i.clean,
        "silver_incremental": _silver_incremental,
        "silver_late_arrivals": _silver_late,
        "silver_column_sync": _silver_column_sync,
        "latest_prices": lambda i: i.latest,
        "latest_by_source": lambda i: i.lbs,
        "source_comparison": lambda i: i.comparison,
        "daily_prices": lambda i: G.daily(i.clean),
        "price_changes": lambda i: G.changes(i.clean_table),
        "price_changes_plain": lambda i: G.changes(i.clean),   # over the silver view, not the written table
        "zone_volume": lambda i: G.zone_volume(i.raw, i.clean, i.lbs, as_of=i.as_of),
        "freshness": lambda i: G.freshness(i.lbs, as_of=i.as_of),
        "freshness_rollup": lambda i: G.freshness(i.lbs, as_of=i.as_of, roll_up=True),
        "gold_sanity": lambda i: G.sanity(i.latest, i.comparison),
    }
    for name in B.QUESTIONS:
        q[f"bi_{name}"] = _bi(name)
    _edge(q)
    _throttle(q)
    _quality(q)
    _sinks(q)
    _ops(q)
    _streaming(q)
    _misc(q)
    return {k: _q(v) for k, v in q.items()}


# --- stream edge ---------------------------------------------------------

def _edge(q: dict[str, Callable[[Inputs], DataFrame]]) -> None:
    from ticklake.functions import jsonx
    from ticklake.functions.contract import with_contract
    from ticklake.operators import deadletter as DL
    from ticklake.operators import normalize as N

    def log(i: Inputs) -> DataFrame:
        return D.raw_log(i.events)

    def validity_split(i: Inputs) -> DataFrame:
        """Accepted + rejected = input, per feed, in one pass over the log."""
        lg = DL.classify(log(i))
        parsed = N.parse_events(lg, keep=("feed", "reason"))
        by_feed = lg.groupBy("feed").agg(
            F.count(F.lit(1)).alias("input_rows"),
            F.count_if(F.col("reason").isNull()).alias("accepted_rows"),
            F.count_if(F.col("reason").isNotNull()).alias("rejected_rows"))
        unified = parsed.groupBy("feed").agg(F.count(F.lit(1)).alias("unified_rows"))
        return by_feed.join(unified, "feed", "left").select(
            "feed", "input_rows", "accepted_rows", "rejected_rows",
            F.coalesce("unified_rows", F.lit(0)).alias("unified_rows"))

    def contract(i: Inputs) -> DataFrame:
        c = with_contract(log(i), "raw_value")
        return c.select("event_id", "feed", (F.size("violations") == 0).alias("is_valid"),
                        F.array_join("violations", ",").alias("violations"))

    def rule_counts(i: Inputs) -> DataFrame:
        c = with_contract(log(i), "raw_value")
        return (c.select(jsonx.explode_parsed(F.col("violations")).alias("rule")).groupBy("rule")
                .agg(F.count(F.lit(1)).alias("messages")))

    def joined(df: DataFrame) -> DataFrame:
        return df.withColumn("violations", F.array_join("violations", ","))

    q.update({
        "unified_prices": lambda i: N.parse_events(log(i)),
        "dead_letters": lambda i: DL.dead_letters(DL.classify(log(i))),
        "dead_letters_compat": lambda i: DL.dead_letters(DL.classify(log(i), compat=True)),
        "dlq_counts": lambda i: (DL.dead_letters(DL.classify(log(i))).groupBy("source_topic", "reason")
                                 .agg(F.count(F.lit(1)).alias("messages"))),
        "validity_split": validity_split,
        "contract_violations": contract,
        "contract_rule_counts": rule_counts,
        "normalize_snapshot": lambda i: joined(N.normalize_snapshot(D.snapshot_bodies(i.events))),
        "normalize_trades": lambda i: joined(N.normalize_trades(D.trade_frames(i.events))),
    })


def _mart_counts(i: Inputs) -> DataFrame:
    """Rows of every mart (the smoke test after a deployment)."""
    gold = {**i.gold(), "changes": G.changes(i.clean)}
    out = None
    for name in ("latest", "latest_by_source", "comparison", "daily", "changes", "freshness", "zone_volume"):
        r = gold[name].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("mart"), "n_rows")
        out = r if out is None else out.unionByName(r)
    return out


# --- throttle --------------------------------------------------------------

def _throttle(q: dict[str, Callable[[Inputs], DataFrame]]) -> None:
    from ticklake.operators.throttle import throttle

    def ticks(i: Inputs) -> DataFrame:
        return D.tick_base(i.events).select("event_id", "coin_id", "ts")

    q["throttled_ticks"] = lambda i: throttle(ticks(i), "coin_id", "ts", 600, tie_break=("event_id",))
    q["throttled_ticks_blocks"] = lambda i: throttle(ticks(i), "coin_id", "ts", 600, tie_break=("event_id",), algorithm="blocks",
                                                    bucket_seconds=86_400)
    q["throttled_ticks_hourly"] = lambda i: throttle(ticks(i), "coin_id", "ts", 3600, tie_break=("event_id",))


# --- quality -----------------------------------------------------------------

def _quality(q: dict[str, Callable[[Inputs], DataFrame]]) -> None:
    from ticklake.operators import checks as C
    from ticklake.plans import quality as QL

    def rels(i: Inputs) -> dict[str, DataFrame]:
        gold = {**i.gold(), "changes": G.changes(i.clean)}
        return QL.relations(i.raw, i.stg, i.clean, gold, as_of=i.as_of)

    def dq_results(i: Inputs) -> DataFrame:
        """Checks read the zone tables as written by a run: raw and silver are
        materialised once under the work folder, every suite reads them."""
        from ticklake.session import work_path
        raw_p, clean_p = work_path(i.spark, "dq-raw"), work_path(i.spark, "dq-silver")
        i.raw.write.parquet(raw_p)
        raw = i.spark.read.parquet(raw_p)
        S.clean_prices(S.stg_prices(raw)).write.parquet(clean_p)
        clean = i.spark.read.parquet(clean_p)
        lbs, latest = G.latest_by_source(clean), G.latest(clean)
        gold = {"latest": latest, "latest_by_source": lbs, "comparison": G.comparison(lbs), "daily": G.daily(clean),
                "changes": G.changes(clean)}
        rels = QL.relations(raw, S.stg_prices(raw), clean, gold, as_of=i.as_of)
        return QL.quality_results(rels, as_of=i.as_of).unionByName(QL.feed_results(rels["raw_24h"]))

    def dq_incremental(i: Inputs) -> DataFrame:
        """Checks of a silver table written in two runs, from numbers that the second run takes of its own days alone."""
        from ticklake.operators import check_store as CS
        from ticklake.session import work_path
        path, store = work_path(i.spark, "silver"), work_path(i.spark, "check-numbers")
        rules = [C.not_null("coin_id"), C.not_null("market_cap"), C.accepted_values("source", ("coingecko",)), C.accepted_values("source", ("coingecko", "binance")),
                 C.min_gt("price_usd", 0), C.min_gt("price_usd", 5), C.unique("coin_id", "source", "recorded_at"), C.unique("recorded_at"), C.unique("coin_id"),
                 C.row_count_min(1), C.row_count_eq(5), C.freshness("recorded_at", 10)]
        for part in (i.stg.where(F.col("recorded_at") < i.as_of - F.expr("INTERVAL 7 DAYS")), i.stg):
            S.refresh_silver(i.spark, part, path)
            CS.update(i.spark, path, store, rules)
        return CS.results(i.spark, path, store, "silver", rules, as_of=i.as_of)

    q["dq_incremental"] = dq_incremental
    q["dq_results"] = dq_results
    q["dq_gate"] = lambda i: C.by_zone(dq_results(i))
    q["mart_counts"] = lambda i: _mart_counts(i)

    def model_run_tests(i: Inputs) -> DataFrame:
        """A full model run (silver incremental-capable, gold tables), each model's
        tests right after it; the run's test results."""
        from ticklake.plans.pipeline import run_pipeline
        from ticklake.session import work_path
        res = run_pipeline(i.spark, i.raw, work_path(i.spark, "warehouse"), as_of=i.as_of,
                           gate_off=("raw", "stg_prices", "latest"))  # the fixture's raw rows are dirty on purpose
        return res.results

    q["model_run_tests"] = model_run_tests
    q["source_volume"] = lambda i: C.source_volume(rels(i)["raw_24h"])
    q["coin_coverage"] = lambda i: C.coin_coverage(rels(i)["raw_24h"])


# --- sinks, lake, backfills ----------------------------------------------------

def _sinks(q: dict[str, Callable[[Inputs], DataFrame]]) -> None:
    from ticklake.operators import backfill as BF
    from ticklake.operators import normalize as N
    from ticklake.operators import sinks as SK
    from ticklake.session import work_path

    def unified(i: Inputs) -> DataFrame:
        return N.parse_events(D.raw_log(i.events), keep=("event_id", "topic", "kafka_ts"))

    lake_cols = ["symbol", "price_usd", "market_cap", "change_24h", "recorded_at", "source", "coin_id", "dt"]

    def land(i: Inputs) -> str:
        """Two micro-batches (one per topic) landed; then the first replayed under
        its own name, and all records in batches cut otherwise, as a query with a
        fresh checkpoint would send them."""
        path, parsed = work_path(i.spark, "lake"), work_path(i.spark, "lake-records")
        unified(i).select(*lake_cols, "event_id", "topic").write.parquet(parsed)  # cut into five batches below
        u = i.spark.read.parquet(parsed)
        batches = [u.where(F.col("topic") == t).drop("topic") for t in ("coingecko.prices.raw", "binance.trades.raw")]
        for n, b in enumerate([*batches, batches[0]]):
            SK.append_lake(b, path, f"first-{n % 2}", ids=("event_id",))
        for n in range(2):
            SK.append_lake(u.where(F.col("event_id") % 2 == n).drop("topic"), path, f"second-{n}", ids=("event_id",))
        return path

    def lake_roundtrip(i: Inputs) -> DataFrame:
        return SK.read_lake(i.spark, land(i)).select(*lake_cols)

    def lake_compaction(i: Inputs) -> DataFrame:
        """Land, compact all days of every source and coin, read back."""
        path = land(i)
        SK.compact_days(i.spark, path, days=None, ids=("event_id",))
        return SK.read_lake(i.spark, path).select(*lake_cols)

    def lake_rows(i: Inputs) -> DataFrame:
        """Rows of every lake partition."""
        return SK.read_lake(i.spark, land(i)).groupBy("source", "coin_id", "dt").agg(F.count(F.lit(1)).alias("n_rows"))

    def lake_inventory(i: Inputs) -> DataFrame:
        return SK.lake_inventory(i.spark, land(i)).select("partition", "file_size")

    def upsert_state(i: Inputs) -> DataFrame:
        """Raw keyed table after two overlapping batches; the second restates
        prices (+1) for its keys at later log positions, the first write's
        ingested_at is kept. Then the first batch again, and both cut into other
        batches: replays in any order change nothing."""
        path = work_path(i.spark, "raw")
        u = unified(i)
        b0 = (u.where(F.col("kafka_ts") < i.as_of - F.expr("INTERVAL 10 DAYS"))
               .withColumn("ingested_at", i.as_of).withColumn("pos", F.col("event_id")))
        b1 = (u.where(F.col("kafka_ts") >= i.as_of - F.expr("INTERVAL 20 DAYS"))
               .withColumn("price_usd", F.col("price_usd") + 1)
               .withColumn("ingested_at", i.as_of + F.expr("INTERVAL 1 HOUR")).withColumn("pos", F.col("event_id") + 1_000_000_000_000))
        cols = ["coin_id", "source", "symbol", "price_usd", "market_cap", "change_24h", "recorded_at",
                "ingested_at", "dt", "resent", "kafka_ts", "pos"]
        b0, b1 = b0.withColumn("resent", F.lit(0)).select(*cols), b1.withColumn("resent", F.lit(1)).select(*cols)
        both = b0.unionByName(b1)
        for b in (b0, b1, b0, both.where(F.col("pos") % 2 == 0), both.where(F.col("pos") % 2 == 1)):
            SK.upsert_by_key(b, path, ["coin_id", "source", "recorded_at"], ["resent", "kafka_ts", "pos"])
        return i.spark.read.parquet(path).select(*cols[:9])

    def seed_history(i: Inputs) -> DataFrame:
        existing = D.ticks(i.events)
        grid = BF.history_grid(i.spark, i.as_of)
        return existing.unionByName(SK.insert_if_absent(existing, grid, ["coin_id", "source", "recorded_at"]))

    def backfill_legacy(i: Inputs) -> DataFrame:
        zone = D.ticks(i.events)
        legacy = zone.drop("source")
        return zone.unionByName(BF.copy_legacy(legacy, zone))

    def backfill_two_column(i: Inputs) -> DataFrame:
        """Legacy rows from before there was a source, into a zone that lacks the last ten days: key (coin, time)."""
        legacy = D.ticks(i.events).drop("source")
        zone = legacy.where(F.col("recorded_at") < i.as_of - F.expr("INTERVAL 10 DAYS"))
        return BF.copy_legacy(legacy, zone, source=None)

    def migration_key_check(i: Inputs) -> DataFrame:
        legacy = D.ticks(i.events).withColumn(
            "source", F.when(F.col("source") == "binance", F.col("source")))
        _, check = BF.add_source_column(legacy)
        return check

    q.update({
        "lake_roundtrip": lake_roundtrip,
        "lake_compaction": lake_compaction,
        "lake_inventory": lake_inventory,
        "lake_rows": lake_rows,
        "upsert_state": upsert_state,
        "seed_history": seed_history,
        "backfill_legacy": backfill_legacy,
        "backfill_two_column": backfill_two_column,
        "migration_key_check": migration_key_check,
    })


# --- operations ------------------------------------------------------------------

def _ops(q: dict[str, Callable[[Inputs], DataFrame]]) -> None:
    from ticklake.operators import deadletter as DL
    from ticklake.operators import ops as O

    def il(i: Inputs) -> DataFrame:
        return D.ingest_log(i.events)

    def dlq(i: Inputs) -> DataFrame:
        return DL.dead_letters(DL.classify(D.raw_log(i.events)))

    def dead_between(i: Inputs):
        def rows(since: Column | None, until: Column) -> DataFrame:
            """Dead letters of the records of a time, filtered before they are parsed."""
            ev = i.events.where(F.col("ts") <= until + F.expr("INTERVAL 1 SECOND"))
            if since is not None:
                ev = ev.where(F.col("ts") >= since - F.expr("INTERVAL 1 SECOND"))
            return DL.dead_letters(DL.classify(D.raw_log(ev)))
        return rows

    q.update({
        "ops_throughput": lambda i: O.throughput(il(i)),
        "ops_last_price": lambda i: O.last_price(il(i)),
        "ops_counters": lambda i: O.counters(il(i), dlq(i)),
        "ops_errors_1h": lambda i: O.window_count(il(i), as_of=i.as_of, seconds=3600, where=F.col("kind") == "error"),
        "ops_poll_age": lambda i: O.poll_age(il(i), as_of=i.as_of),
        "ops_feed_b_10m": lambda i: O.window_count(
            il(i), as_of=i.as_of, seconds=600,
            where=(F.col("kind") == "published") & (F.col("service") == "binance")),
        "alerts": lambda i: O.alerts(il(i), dead_between(i), D.progress_log(i.events), as_of=i.as_of),
        "alert_episodes": lambda i: O.episodes(il(i), dead_between(i), D.progress_log(i.events), as_of=i.as_of),
    })


# --- streaming -------------------------------------------------------------------

def _streaming(q: dict[str, Callable[[Inputs], DataFrame]]) -> None:
    from ticklake.session import work_path
    from ticklake.sources import log as L
    from ticklake.streaming import stream as ST
    from ticklake.streaming.throttle_stream import read_throttled, throttle_stream

    def ingest(i: Inputs, dlq_format: str = "parquet") -> ST.Paths:
        """Land the log in five time-ordered files, stream them one file per
        micro-batch, then stream the landing folder again with a fresh checkpoint
        and batches of two files (the tables must not change)."""
        landing = work_path(i.spark, "landing")
        L.land_log(L.log_records(D.raw_log(i.events)), landing, files=5)
        base = work_path(i.spark, "stream")
        paths = ST.Paths(f"{base}/raw", f"{base}/lake", f"{base}/dlq", f"{base}/_checkpoint")
        log = L.read_log(i.spark, landing, max_files_per_trigger=1)
        ST.run_stream(i.spark, log, paths, available_now=True, dlq_format=dlq_format).awaitTermination()
        if dlq_format == "parquet":  # a topic's text has no positions: a second query would publish again, as on any log
            again = ST.Paths(paths.raw, paths.lake, paths.dlq, f"{base}/_checkpoint2")
            ST.run_stream(i.spark, L.read_log(i.spark, landing, max_files_per_trigger=2), again, available_now=True).awaitTermination()
        return paths

    def stream_progress(i: Inputs) -> DataFrame:
        """The ingest's recorded progress: messages in, by feed, and those left behind at the end."""
        from ticklake.streaming.progress import read_progress, record_progress
        table = work_path(i.spark, "progress")
        listener = record_progress(i.spark, table)
        try:
            ingest(i, dlq_format="json")
            # reports come by the listener bus; a query's last one may still be on its way
            i.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        finally:
            i.spark.streams.removeListener(listener)
            listener.flush()
        seen = lambda k: F.sum(F.col("observed")[f"ingest_counters.{k}"]).cast("long").alias(k)
        return read_progress(i.spark, table).agg(F.sum("input_rows").cast("long").alias("input_rows"), seen("messages"),
                                                 seen("snapshot_messages"), seen("trade_messages"),
                                                 F.max("offsets_behind").alias("offsets_behind"))

    def recorded(i: Inputs, run: Callable[[], None]) -> DataFrame:
        """The progress reports of what ``run`` does."""
        from ticklake.streaming.progress import read_progress, record_progress
        table = work_path(i.spark, "progress")
        listener = record_progress(i.spark, table)
        try:
            run()
            i.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        finally:
            i.spark.streams.removeListener(listener)
            listener.flush()
        return read_progress(i.spark, table)

    def late_landing(i: Inputs, *, copies: bool) -> DataFrame:
        """The feed log in five files by arrival, some records late and some twice, as a stream of one file a batch."""
        landing = work_path(i.spark, "late-landing")
        L.land_files(D.arrivals(i.events, copies=copies), landing, "arrival", files=5)
        return L.read_log(i.spark, landing, max_files_per_trigger=1)

    def stream_rates(i: Inputs) -> DataFrame:
        """Closed windows of the deduplicated stream."""
        from ticklake.streaming.eventtime import run_rates
        out = work_path(i.spark, "rates")
        run_rates(late_landing(i, copies=True), out, out + "_checkpoint", available_now=True).awaitTermination()
        return i.spark.read.parquet(out)

    def stream_late_rows(i: Inputs) -> DataFrame:
        """What the same stream dropped, by batch of records."""
        from ticklake.streaming.eventtime import run_rates
        from ticklake.streaming.progress import late_rows
        out, log = work_path(i.spark, "rates"), late_landing(i, copies=True)
        reports = recorded(i, lambda: run_rates(log, out, out + "_checkpoint", available_now=True).awaitTermination())
        return late_rows(reports).where("input_rows > 0").drop("query_name")

    def stream_commits(i: Inputs) -> DataFrame:
        """The lake's partitions after a stream with late rows: complete, and how often committed and reopened."""
        from ticklake.streaming.commits import partition_status
        log, base = late_landing(i, copies=False), work_path(i.spark, "stream")
        paths = ST.Paths(f"{base}/raw", f"{base}/lake", f"{base}/dlq", f"{base}/_checkpoint", f"{base}/commits")
        ST.run_stream(i.spark, log, paths, available_now=True).awaitTermination()
        return partition_status(i.spark, paths.commits)

    def stream_lag(i: Inputs) -> DataFrame:
        """Records out and records still to come of each topic after each batch of an ingest that catches up."""
        from ticklake.schemas import TOPIC_SNAPSHOTS, TOPIC_TRADES
        from ticklake.streaming.progress import topic_lag
        landing, base = work_path(i.spark, "landing"), work_path(i.spark, "stream")
        L.land_log(L.log_records(D.raw_log(i.events)), landing, files=5)
        paths = ST.Paths(f"{base}/raw", f"{base}/lake", f"{base}/dlq", f"{base}/_checkpoint")
        log = L.read_log(i.spark, landing, max_files_per_trigger=1)
        reports = recorded(i, lambda: ST.run_stream(i.spark, log, paths, available_now=True, name="ingest").awaitTermination())
        ends = L.read_log(i.spark, landing, streaming=False).groupBy("topic").agg(F.count(F.lit(1)).alias("records"))
        lag = topic_lag(reports, ends, {TOPIC_SNAPSHOTS: "ingest_counters.snapshot_messages", TOPIC_TRADES: "ingest_counters.trade_messages"})
        return lag.select("query_name", "batch_id", "topic", "records_out", "records_so_far", "lag",
                          (F.col("processed_rows_per_second") > 0).alias("flowing"))

    def stream_dlq_monitor(i: Inputs) -> DataFrame:
        """Ingest writing the dead-letter topic as JSON, then the monitor stream's counters."""
        from ticklake.streaming.dlq_monitor import run_monitor
        paths = ingest(i, dlq_format="json")
        counters = work_path(i.spark, "dlq-counters")
        run_monitor(i.spark, paths.dlq, counters, counters + "_checkpoint", available_now=True).awaitTermination()
        return i.spark.read.parquet(counters)

    def stream_throttled(i: Inputs) -> DataFrame:
        landing = work_path(i.spark, "ticks-landing")
        ticks = D.tick_base(i.events).select("event_id", "coin_id", "ts")
        L.land_files(ticks, landing, "ts", files=5)
        src = (i.spark.readStream.schema("event_id long, coin_id string, ts timestamp_ntz")
               .option("timestampNTZFormat", L.NTZ_FORMAT).option("maxFilesPerTrigger", "1").json(landing))
        out = work_path(i.spark, "throttled")
        throttle_stream(src, "coin_id", "ts", 600, path=out, checkpoint=out + "_checkpoint", tie_break=("event_id",),
                        available_now=True).awaitTermination()
        return read_throttled(i.spark, out).select("event_id", "coin_id", "ts")

    q.update({
        "stream_raw": lambda i: ST.read_raw(i.spark, ingest(i)).drop("ingested_at"),
        "stream_dead_letters": lambda i: ST.read_dead_letters(i.spark, ingest(i)),
        "stream_throttled": stream_throttled,
        "stream_dlq_monitor": stream_dlq_monitor,
        "stream_progress": stream_progress,
        "stream_rates": stream_rates,
        "stream_late_rows": stream_late_rows,
        "stream_commits": stream_commits,
        "stream_lag": stream_lag,
    })


# --- readers, publishing, replay, declared freshness ---------------------------------

def _misc(q: dict[str, Callable[[Inputs], DataFrame]]) -> None:
    from ticklake.functions import jsonx
    from ticklake.functions.timefmt import as_column, seconds_between
    from ticklake.operators import deadletter as DL
    from ticklake.operators import normalize as N
    from ticklake.operators import sinks as SK
    from ticklake.session import work_path
    from ticklake.sources import log as L

    def debug_view(i: Inputs) -> DataFrame:
        """The debug consumer's projection of the feed log."""
        recs = L.log_records(D.raw_log(i.events))
        v = jsonx.parse(F.col("value"))
        return recs.select("partition", "offset", jsonx.scalar_text(v, "$.coin_id").alias("coin_id"),
                           jsonx.scalar_text(v, "$.price_usd").alias("price_usd"),
                           jsonx.scalar_text(v, "$.event_time").alias("event_time"))

    def dlq_messages(i: Inputs) -> DataFrame:
        """Dead-letter topic: the classifier's records as JSON, plus foreign
        messages (whole document texts) that landed on the topic."""
        dead = DL.to_dlq_json(DL.dead_letters(DL.classify(D.raw_log(i.events))))
        junk = i.table("documents").select(F.col("text").alias("value"))
        return dead.unionByName(junk).select(F.col("value").cast("binary").alias("value"))

    def snapshots(i: Inputs) -> DataFrame:
        return N.normalize_snapshot(D.snapshot_bodies(i.events)).where(F.size("violations") == 0)

    def publish_snapshots(i: Inputs) -> DataFrame:
        """Feed A's valid events as log records keyed by coin, read back from their JSON."""
        recs = L.to_log(snapshots(i), key_cols=("coin_id",))
        event = F.from_json("value", "coin_id string, symbol string, price_usd double, market_cap double, change_24h double, event_time string, source string")
        return recs.select("key", event.alias("e")).select("key", "e.*")

    def dead_letter_replay(i: Inputs) -> DataFrame:
        """Dead letters, delivered twice, as records for their source topic: one for each log position."""
        recs = L.log_records(D.raw_log(i.events))
        dead = DL.dead_letters(DL.classify(recs, value="value"), value="value", ts="timestamp", keep=("topic", "partition", "offset"))
        return DL.dedupe_delivered(dead.unionByName(dead)).select(F.col("source_topic").alias("topic"), F.col("raw_value").alias("value"))

    def payload_events(i: Inputs) -> DataFrame:
        """Trade frames landed as text, read back as payloads and normalised."""
        landing = work_path(i.spark, "payloads")
        D.trade_frames(i.events).select(F.col("payload").alias("value")).write.text(landing)
        read = L.read_payloads(i.spark, landing, "binance", streaming=False).withColumn("frame_id", F.lit(0).cast("long"))
        return N.normalize_trades(read).where(F.size("violations") == 0).select("coin_id", "symbol", "price_usd", "event_time", "source")

    def landed_snapshots(i: Inputs) -> DataFrame:
        """Poll bodies landed as whole files by receive time, read back and normalised; the events carry that time."""
        landing = work_path(i.spark, "bodies")
        L.land_bodies(D.hourly_bodies(i.events), landing)
        read = L.read_payloads(i.spark, landing, "coingecko", streaming=False, whole=True, received="received_us").withColumn("poll_id", F.lit(0).cast("long"))
        ev = N.normalize_snapshot(read).where(F.size("violations") == 0)
        return ev.select("coin_id", "symbol", "price_usd", "event_time", "source")

    def dlq_previews(i: Inputs) -> DataFrame:
        """What the monitor logs of each dead letter: the start of its raw text."""
        return DL.parse_dead_letters(dlq_messages(i)).select("source_topic", "reason", DL.preview(F.col("raw_value")).alias("preview"))

    def publish_records(i: Inputs) -> DataFrame:
        t = N.normalize_trades(D.trade_frames(i.events))
        return L.to_log(t.where(F.size("violations") == 0), key_cols=("coin_id", "source"))

    def source_freshness(i: Inputs) -> DataFrame:
        """Declared source freshness of the raw table: warn after 10, error
        after 30 minutes without a new row."""
        age = seconds_between(as_column(i.as_of), F.max("recorded_at"))
        raw = i.raw
        return raw.agg(F.max("recorded_at").alias("max_loaded_at"), age.alias("age_seconds")).select(
            F.lit("raw.crypto_prices").alias("source_name"), "max_loaded_at", "age_seconds",
            F.when(F.col("age_seconds") > 30 * 60, "error").when(F.col("age_seconds") > 10 * 60, "warn")
             .otherwise("pass").alias("status"))

    def lake_replay(i: Inputs) -> DataFrame:
        """Rebuild a keyed raw table from the lake (insert-if-absent)."""
        lake = work_path(i.spark, "lake")
        u = N.parse_events(D.raw_log(i.events))
        SK.append_lake(u, lake, "first-0")
        raw = work_path(i.spark, "raw-replay")
        SK.append_if_absent(SK.read_lake(i.spark, lake).select(*u.columns), raw,
                            ["coin_id", "source", "recorded_at"], partition_by=("dt",))
        return i.spark.read.parquet(raw).select(*u.columns)

    q.update({
        "log_debug_view": debug_view,
        "dlq_monitor": lambda i: DL.parse_dead_letters(dlq_messages(i)),
        "dlq_monitor_counts": lambda i: (DL.parse_dead_letters(dlq_messages(i)).groupBy("source_topic", "reason")
                                         .agg(F.count(F.lit(1)).alias("messages"))),
        "publish_records": publish_records,
        "publish_snapshots": publish_snapshots,
        # what the publisher writes to its own log: coin, price and change of each event
        "publish_log": lambda i: snapshots(i).select("coin_id", "price_usd", "change_24h"),
        "dead_letter_replay": dead_letter_replay,
        "payload_events": payload_events,
        "landed_snapshots": landed_snapshots,
        "dlq_previews": dlq_previews,
        "latest_ticks_top": lambda i: i.clean.orderBy(F.col("recorded_at").desc(), "coin_id", "source").limit(10),
        "source_freshness": source_freshness,
        "lake_replay": lake_replay,
    })
