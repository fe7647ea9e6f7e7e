"""Firings over the whole history against a loop over every evaluation step, and against the rules at one instant."""
import datetime as dt

import numpy as np
import pytest

from pyspark.sql import functions as F

from ticklake.operators import ops as O

AS_OF = dt.datetime(2024, 1, 2, 0, 0, 0)
LOG = "ts timestamp_ntz, service string, kind string"


def tables(spark, seed, n=260):
    rng = np.random.default_rng(seed)
    # bursts and pauses over a day
    at = lambda k: sorted(AS_OF - dt.timedelta(microseconds=int(x)) for x in rng.choice([3e9, 8.64e10], 1) * rng.random(k) ** 2 * 1e0)
    log = [(t, str(rng.choice(["coingecko", "binance"])), str(rng.choice(["published", "error"], p=[0.6, 0.4]))) for t in at(n)]
    log += [(AS_OF - dt.timedelta(seconds=15 * int(rng.integers(0, 5000))), "coingecko", "published") for _ in range(20)]  # on a step
    dlq = [(t,) for t in at(30)]
    progress = [(t.replace(microsecond=0), int(rng.integers(0, 12_000))) for t in at(200)]
    progress = list({t: (t, v) for t, v in progress}.values())
    return (log, dlq, progress, spark.createDataFrame(log, LOG), spark.createDataFrame(dlq, "failed_at timestamp_ntz"),
            spark.createDataFrame(progress, "batch_ts timestamp_ntz, offsets_behind long"))


def plain(rule, rows):
    """(pending, fired, resolved) from the metric at every step; rows: (time, row) of the rule's whole table."""
    if not rows:
        return []
    first = min(t for t, _ in rows)
    steps = int((AS_OF - first) / dt.timedelta(seconds=15))
    mine = [(t, r) for t, r in rows if all(r[c] == v for c, v in rule.where)]
    true = []
    for k in range(-steps, 1):
        t = AS_OF + dt.timedelta(seconds=15 * k)
        if rule.kind == "count":
            m = sum(t - dt.timedelta(seconds=rule.range_seconds) < x <= t for x, _ in mine)
        elif rule.kind == "stale":
            before = [x for x, _ in mine if x <= t]
            m = (t - max(before)).total_seconds() if before else None
        else:
            before = [(x, r) for x, r in mine if t - dt.timedelta(seconds=rule.range_seconds) < x <= t]
            m = max(before)[1][rule.value_col] if before else None
        true.append(m is not None and {">": m > rule.threshold, "==": m == rule.threshold}[rule.op])
    out, k = [], 0
    while k < len(true):
        z = k
        while z < len(true) and true[z]:
            z += 1
        if z > k and (z - 1 - k) * 15 >= rule.hold_seconds:
            at = lambda i: AS_OF + dt.timedelta(seconds=15 * (i - steps))
            out.append((rule.name, at(k), at(k) + dt.timedelta(seconds=rule.hold_seconds), at(z) if z < len(true) else None))
        k = max(z, k + 1)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_episodes_equal_a_loop_over_all_steps(spark, seed):
    log, dlq, progress, *frames = tables(spark, seed)
    rows = {"log": [(r[0], {"service": r[1], "kind": r[2]}) for r in log], "dlq": [(r[0], {}) for r in dlq],
            "progress": [(r[0], {"offsets_behind": r[1]}) for r in progress]}
    want = sorted((e for rule in O.ALERTS for e in plain(rule, rows[rule.table])), key=str)
    got = O.episodes(*frames, as_of=AS_OF)
    assert sorted(((r["name"], r["pending_at"], r["fired_at"], r["resolved_at"]) for r in got.collect()), key=str) == want
    # what still fires at as_of is what the instant rules say
    firing = {r["name"] for r in O.alerts(*frames, as_of=AS_OF).where("firing").collect()}
    assert firing == {e[0] for e in want if e[3] is None}
    assert len(want) > 10


def test_nothing_to_fire(spark):
    empty = spark.createDataFrame([], LOG)
    out = O.episodes(empty, spark.createDataFrame([], "failed_at timestamp_ntz"),
                     spark.createDataFrame([], "batch_ts timestamp_ntz, offsets_behind long"), as_of=AS_OF)
    assert out.count() == 0


def test_counted_rules_read_recent_rows_alone(spark, tmp_dir):
    """The time filter of a table without staleness rules reaches the scan; with them only one maximum reads the rest."""
    _, _, _, log, dlq, progress = tables(spark, 9)
    dlq.write.parquet(f"{tmp_dir}/dlq")
    rules = [a for a in O.ALERTS if a.table == "dlq"]
    plan = O.evaluate_all(rules, spark.read.parquet(f"{tmp_dir}/dlq"), as_of=AS_OF, ts_col="failed_at")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(failed_at" in plan and "LessThanOrEqual(failed_at" in plan
    log.write.parquet(f"{tmp_dir}/log")
    plan = O.evaluate_all([a for a in O.ALERTS if a.table == "log"], spark.read.parquet(f"{tmp_dir}/log"), as_of=AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThan(ts") == 1 and plan.count("PushedFilters") == 2
