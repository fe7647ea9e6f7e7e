"""Operational rollups and alert rules as table queries at an explicit ``as_of``.

Counters become grouped counts, gauges become latest-value aggregates, and
an alert's "held for d" (true at every 15 s evaluation step over d) becomes
one conditional aggregate per evaluation step over the rows of the last
(hold + range) seconds, a pushed filter; what is older matters to staleness
alone, as one maximum. ``episodes`` answers the same for the whole history:
every row changes a rule's metric at two steps at most, so steps at which
something changes are summed up first and the firings are the islands of
consecutive true steps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.functions.timefmt import as_column, micros, seconds_between
from ticklake.operators.keyed import top1_by_key
from ticklake.schemas import ALERT_POLL_STALE_SECONDS

EVAL_STEP_SECONDS = 15


def throughput(log: DataFrame, *, window: str = "5 minutes", slide: str = "1 minute", seconds: int = 300) -> DataFrame:
    """Published messages per second over sliding windows, feeds summed."""
    pub = log.where(F.col("kind") == "published")
    return (pub.groupBy(F.window("ts", window, slide).alias("w"))
            .agg((F.count(F.lit(1)) / F.lit(float(seconds))).alias("msgs_per_sec"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "msgs_per_sec"))


def last_price(log: DataFrame, *, service: str = "coingecko") -> DataFrame:
    """Last published price per coin of one feed (a gauge)."""
    pub = log.where((F.col("kind") == "published") & (F.col("service") == service))
    return top1_by_key(pub, ["coin_id"], "ts", ["price_usd"]).select(
        "coin_id", "price_usd", F.col("ts").alias("last_published_at"))


def counters(log: DataFrame, dlq: DataFrame) -> DataFrame:
    """Labelled counters: published per (service, coin), errors per
    (service, type), dead letters per (topic, reason)."""
    pub = (log.where(F.col("kind") == "published").groupBy("service", "coin_id")
           .agg(F.count(F.lit(1)).alias("value"))
           .select(F.lit("messages_published_total").alias("counter"),
                   F.concat_ws(",", F.concat(F.lit("service="), "service"), F.concat(F.lit("coin_id="), "coin_id")).alias("labels"),
                   "value"))
    err = (log.where(F.col("kind") == "error").groupBy("service", "error_type")
           .agg(F.count(F.lit(1)).alias("value"))
           .select(F.lit("errors_total").alias("counter"),
                   F.concat_ws(",", F.concat(F.lit("service="), "service"), F.concat(F.lit("error_type="), "error_type")).alias("labels"),
                   "value"))
    dl = (dlq.groupBy("source_topic", "reason").agg(F.count(F.lit(1)).alias("value"))
          .select(F.lit("dlq_messages_total").alias("counter"),
                  F.concat_ws(",", F.concat(F.lit("source_topic="), "source_topic"), F.concat(F.lit("reason="), "reason")).alias("labels"),
                  "value"))
    return pub.unionByName(err).unionByName(dl)


def window_count(log: DataFrame, *, as_of, seconds: int, where: Column) -> DataFrame:
    """Rows matching ``where`` in (as_of - seconds, as_of]."""
    t = as_column(as_of)
    cond = where & (F.col("ts") > t - F.expr(f"INTERVAL {int(seconds)} SECONDS")) & (F.col("ts") <= t)
    return log.agg(F.count_if(cond).alias("value"))


def poll_age(log: DataFrame, *, as_of, service: str = "coingecko") -> DataFrame:
    """Seconds since the last successful poll (published message) of a feed:
    one partial maximum a task over two columns."""
    t0 = as_column(as_of)
    pub = log.where((F.col("kind") == "published") & (F.col("service") == service) & (F.col("ts") <= t0))
    return pub.agg(seconds_between(t0, F.max("ts")).alias("seconds_since_poll"))


@dataclass(frozen=True)
class Alert:
    name: str
    severity: str
    service: str
    hold_seconds: int
    kind: str                # "stale" | "count" | "gauge" (sum of value_col over the latest sample)
    range_seconds: int = 0   # counted range for "count"
    op: str = ">"            # comparison of the metric with the threshold
    threshold: float = 0
    table: str = "log"       # "log" | "dlq" | "progress"
    where: tuple = ()        # (column, value) equality filters
    value_col: str = ""      # gauge column


# fixed values: the alert rules (name, severity, service, hold, metric and threshold)
ALERTS = (
    Alert("CoingeckoPollStale", "warning", "coingecko-ingest", 120, "stale", op=">",
          threshold=ALERT_POLL_STALE_SECONDS, where=(("service", "coingecko"), ("kind", "published"))),
    Alert("CoingeckoApiErrors", "warning", "coingecko-ingest", 300, "count", 900, ">", 0,
          where=(("service", "coingecko"), ("kind", "error"))),
    Alert("BinancePublishStale", "warning", "binance-ingest", 300, "count", 600, "==", 0,
          where=(("service", "binance"), ("kind", "published"))),
    Alert("BinanceWsErrors", "warning", "binance-ingest", 120, "count", 900, ">", 3,
          where=(("service", "binance"), ("kind", "error"))),
    # "not running" has held for three minutes when no batch has ended for as long
    Alert("StreamNoRunningJobs", "critical", "stream", 0, "stale", op=">", threshold=180, table="progress"),
    Alert("DeadLetterMessagesDetected", "warning", "dlq-monitor", 300, "count", 900, ">", 0, table="dlq"),
    # consumer lag over the streaming progress table (offsets behind the latest, summed over sources)
    Alert("ConsumerLagHigh", "warning", "stream", 600, "gauge", 300, ">", 5000, table="progress", value_col="offsets_behind"),
)
LAG_ALERT = ALERTS[-1]


def lag_alert(progress: DataFrame, *, as_of) -> DataFrame:
    """Lag > 5000 messages held for 10 minutes, from ``streaming.progress``."""
    return evaluate(LAG_ALERT, progress, as_of=as_of, ts_col="batch_ts")


def _cmp(x: Column, op: str, v: float) -> Column:
    return {">": x > v, "==": x == v, ">=": x >= v, "<": x < v}[op]


def _mine(alert: Alert) -> Column:
    cond = F.lit(True)
    for c, v in alert.where:
        cond = cond & (F.col(c) == v)
    return cond


def _metrics(alert: Alert, t0: Column, ts: Column, older: Column) -> list[Column]:
    """The rule's metric at every evaluation step, newest first, as aggregates over its table's recent rows;
    ``older``: the newest of its rows before these."""
    mine = _mine(alert)
    out = []
    for k in range(alert.hold_seconds // EVAL_STEP_SECONDS + 1):
        t = t0 - F.expr(f"INTERVAL {k * EVAL_STEP_SECONDS} SECONDS")
        lo = t - F.expr(f"INTERVAL {alert.range_seconds} SECONDS")
        if alert.kind == "stale":
            # no series yet -> no sample -> the rule cannot fire
            out.append(seconds_between(t, F.greatest(F.max(F.when(mine & (ts <= t), ts)), older)))
        elif alert.kind == "gauge":
            # the latest sample at or before t (a sample older than the range is stale: no value)
            out.append(F.max_by(F.col(alert.value_col), F.when(mine & (ts <= t) & (ts > lo), ts)).cast("double"))
        else:
            out.append(F.count_if(mine & (ts > lo) & (ts <= t)).cast("double"))
    return out


def reach_seconds(rules: list[Alert]) -> int:
    """How far back of ``as_of`` rows matter step by step."""
    return max(a.hold_seconds + a.range_seconds for a in rules)


def evaluate_all(rules: list[Alert], df: DataFrame, *, as_of, ts_col: str = "ts") -> DataFrame:
    """Name, severity, service, firing and value (metric at as_of) of the rules over one table. Every step of
    every rule is a conditional aggregate over the rows of the last ``reach_seconds`` (a pushed filter with a literal
    as_of); for staleness the newest older row of each such rule is found in one aggregate over the rest."""
    t0, ts = as_column(as_of), F.col(ts_col)
    since = t0 - F.expr(f"INTERVAL {reach_seconds(rules)} SECONDS")
    stale = [r for r, a in enumerate(rules) if a.kind == "stale"]
    recent = df.where((ts > since) & (ts <= t0))
    metrics = {(r, k): m for r, a in enumerate(rules) for k, m in enumerate(
        _metrics(a, t0, ts, F.max(f"_older{r}") if r in stale else F.lit(None).cast("timestamp_ntz")))}
    if stale:
        old = df.where(ts <= since).agg(*[F.max(F.when(_mine(rules[r]), ts)).cast("timestamp_ntz").alias(f"_older{r}") for r in stale])
        recent = recent.unionByName(old, allowMissingColumns=True)  # a row without a time of its own
    row = recent.agg(*[m.alias(f"m{r}_{k}") for (r, k), m in metrics.items()])
    found = []
    for r, a in enumerate(rules):
        held = F.lit(True)
        for k in range(a.hold_seconds // EVAL_STEP_SECONDS + 1):
            held = held & F.coalesce(_cmp(F.col(f"m{r}_{k}"), a.op, a.threshold), F.lit(False))
        found.append(F.struct(F.lit(a.name).alias("name"), F.lit(a.severity).alias("severity"), F.lit(a.service).alias("service"),
                              held.alias("firing"), F.col(f"m{r}_0").cast("double").alias("value")))
    return row.select(F.explode(F.array(*found)).alias("r")).select("r.*")


def evaluate(alert: Alert, df: DataFrame, *, as_of, ts_col: str = "ts") -> DataFrame:
    """One rule, one row."""
    return evaluate_all([alert], df, as_of=as_of, ts_col=ts_col)


def _tables(log: DataFrame, dlq, progress: DataFrame, since: Column | None, until: Column):
    """(rules, rows, time column) of each table. ``dlq`` may be a function (since, until) -> rows, for a table that
    is parsed from records: their time is then filtered before the parse."""
    for name, df, col in (("log", log, "ts"), ("dlq", dlq, "failed_at"), ("progress", progress, "batch_ts")):
        rules = [a for a in ALERTS if a.table == name]
        if callable(df):
            df = df(since(rules) if since is not None else None, until)
        yield rules, df, col


def alerts(log: DataFrame, dlq, progress: DataFrame, *, as_of) -> DataFrame:
    """All alert rules at ``as_of``."""
    t0, out = as_column(as_of), None
    for rules, df, col in _tables(log, dlq, progress, lambda r: t0 - F.expr(f"INTERVAL {reach_seconds(r)} SECONDS"), t0):
        r = evaluate_all(rules, df, as_of=as_of, ts_col=col)
        out = r if out is None else out.unionByName(r)
    return out


DAY_STEPS = 86_400 // EVAL_STEP_SECONDS


def _step(us: Column, t0: Column) -> Column:
    """The first evaluation step at or after a time in microseconds: steps are counted from as_of (0) backwards."""
    return -F.floor((micros(t0) - us) / F.lit(EVAL_STEP_SECONDS * 1_000_000)).cast("long")


def _true_steps(rules: list[Alert], df: DataFrame, t0: Column, ts: Column) -> DataFrame:
    """(rule, first, end): stretches of steps at which a rule's condition holds, in parts that follow each other or not."""
    us = micros(ts)
    df = df.where(ts <= t0)
    begin = df.agg(_step(F.min(us), t0).alias("b"))
    changes, parts = [], []
    for a in rules:
        name = F.lit(a.name).alias("rule")
        if a.kind == "gauge":
            # a sample counts at its step and until it is too old; the latest of a step decides
            reach = F.sequence(_step(us, t0), F.least(F.lit(0), _step(us + a.range_seconds * 1_000_000, t0) - 1))
            at = df.where(_mine(a)).where(_step(us, t0) <= F.least(F.lit(0), _step(us + a.range_seconds * 1_000_000, t0) - 1)).select(
                F.explode(reach).alias("first"), us.alias("_us"), F.col(a.value_col).alias("_v"))
            at = at.groupBy("first").agg(F.max_by("_v", "_us").alias("v")).where(F.coalesce(_cmp(F.col("v"), a.op, a.threshold), F.lit(False)))
            parts.append(at.select(name, "first", (F.col("first") + 1).alias("end")))
        else:
            # counted in (t - range, t]; stale is: none in [t - threshold, t]
            gone = (_step(us + a.range_seconds * 1_000_000, t0) if a.kind == "count" else _step(us + int(a.threshold * 1_000_000) + 1, t0))
            up, down = (F.struct(name, s.alias("step"), F.lit(d).alias("delta")) for s, d in ((_step(us, t0), 1), (gone, -1)))
            changes.append(F.when(_mine(a), F.array(up, down)))
    if changes:
        # a row for each step at which a rule's count changes: bounded by time, not by rows
        each = df.select(F.explode(F.flatten(F.filter(F.array(*changes), lambda x: x.isNotNull()))).alias("c")).select("c.*")
        counted = [a.name for a in rules if a.kind == "count"]
        zero = begin.where("b IS NOT NULL").select(F.explode(F.array(*[F.lit(n) for n in counted]).cast("array<string>")).alias("rule"), F.col("b").alias("step"),
                                                   F.lit(0).alias("delta"))
        steps = (each.unionByName(zero).where("step <= 0").groupBy("rule", "step").agg(F.sum("delta").alias("_step_delta"))
                 .withColumn("day", F.floor(F.col("step") / DAY_STEPS)))
        days = steps.groupBy("rule", "day").agg(F.sum("_step_delta").alias("_last"), F.min("step").alias("_first"))
        by_day = Window.partitionBy("rule").orderBy("day")
        days = days.select("rule", "day", F.coalesce(F.sum("_last").over(by_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                           F.lead("_first").over(by_day).alias("next_day"))
        in_day = Window.partitionBy("rule", "day").orderBy("step")
        steps = steps.select("rule", "day", "step", F.sum("_step_delta").over(in_day).alias("so_far"), F.lead("step").over(in_day).alias("next")).join(days, ["rule", "day"])
        v, holds = (F.col("before") + F.col("so_far")).cast("double"), F.lit(False)
        for a in rules:
            if a.kind != "gauge":
                holds = holds | ((F.col("rule") == a.name) & (v == 0 if a.kind == "stale" else _cmp(v, a.op, a.threshold)))
        parts.append(steps.where(holds).select("rule", F.col("step").alias("first"), F.coalesce("next", "next_day", F.lit(1)).cast("long").alias("end")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def episodes(log: DataFrame, dlq, progress: DataFrame, *, as_of) -> DataFrame:
    """Every firing of every rule from the first row of its table until ``as_of``: since when its condition held, when it
    had held long enough and fired, and the first step at which it no longer held (NULL: it still fires)."""
    t0, out = as_column(as_of), None
    rules = F.create_map(*[x for a in ALERTS for x in (F.lit(a.name), F.struct(
        F.lit(a.severity).alias("severity"), F.lit(a.service).alias("service"), F.lit(a.hold_seconds // EVAL_STEP_SECONDS).alias("hold")))])
    for each, df, col in _tables(log, dlq, progress, None, t0):
        t = _true_steps(each, df, t0, F.col(col))
        out = t if out is None else out.unionByName(t)
    # islands; a row for each stretch of a rule, again bounded by the steps of the history
    in_order = Window.partitionBy("rule").orderBy("_step_first")
    out = out.withColumnRenamed("first", "_step_first")
    starts = out.withColumn("_step_new", F.when(F.lag("end").over(in_order) == F.col("_step_first"), 0).otherwise(1))
    found = starts.withColumn("island", F.sum("_step_new").over(in_order)).groupBy("rule", "island").agg(F.min("_step_first").alias("a"), F.max("end").alias("z"))
    found = found.withColumn("r", rules[F.col("rule")]).where("z - 1 - a >= r.hold")
    at = lambda step: t0 + F.make_dt_interval(secs=step * EVAL_STEP_SECONDS)
    return found.select(F.col("rule").alias("name"), "r.severity", "r.service", at(F.col("a")).alias("pending_at"), at(F.col("a") + F.col("r.hold")).alias("fired_at"),
                        F.when(F.col("z") <= 0, at(F.col("z"))).alias("resolved_at"))


def ops(name: str, log: DataFrame, dlq: DataFrame | None = None, progress: DataFrame | None = None, *,
        as_of) -> DataFrame:
    """Answer one operational question by name."""
    questions = {
        "throughput": lambda: throughput(log),
        "last_price": lambda: last_price(log),
        "counters": lambda: counters(log, dlq),
        "errors_1h": lambda: window_count(log, as_of=as_of, seconds=3600, where=F.col("kind") == "error"),
        "poll_age": lambda: poll_age(log, as_of=as_of),
        "feed_b_10m": lambda: window_count(log, as_of=as_of, seconds=600,
                                           where=(F.col("kind") == "published") & (F.col("service") == "binance")),
        "lag": lambda: lag_alert(progress, as_of=as_of),
        "alerts": lambda: alerts(log, dlq, progress, as_of=as_of),
    }
    return questions[name]()
