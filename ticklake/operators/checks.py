"""Declarative data-quality checks.

``run_checks(df, zone, rules)`` evaluates every row-level rule of a table in
ONE aggregate pass (partial + final aggregation, no collect), adds one
grouped count per uniqueness rule, and returns a small result frame:

    zone, check_name, column_name, failed_rows, total_rows, success

An empty input fails every check of its zone. ``gate(results)`` is the only
driver-side step: it reads the (bounded) result rows and raises on failure.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.timefmt import as_column, minutes_between
from ticklake.schemas import CHECK_FRESHNESS_MINUTES, MIN_ROWS_PER_SOURCE, SOURCES, TRACKED_COINS

RESULT_COLUMNS = ("zone", "check_name", "column_name", "failed_rows", "total_rows", "success")


@dataclass(frozen=True)
class Rule:
    kind: str                      # not_null | accepted_values | min_gt | unique | row_count_min
    columns: tuple[str, ...] = ()  # | row_count_eq | freshness
    values: tuple = field(default=())
    threshold: float | None = None

    @property
    def name(self) -> str:
        return self.kind

    @property
    def column_label(self) -> str:
        return ",".join(self.columns)


def not_null(c: str) -> Rule:
    return Rule("not_null", (c,))


def accepted_values(c: str, values: Sequence[str]) -> Rule:
    return Rule("accepted_values", (c,), tuple(values))


def min_gt(c: str, bound: float = 0) -> Rule:
    return Rule("min_gt", (c,), threshold=bound)


def unique(*cols: str) -> Rule:
    return Rule("unique", tuple(cols))


def row_count_min(n: int = 1) -> Rule:
    return Rule("row_count_min", threshold=n)


def row_count_eq(n: int) -> Rule:
    return Rule("row_count_eq", threshold=n)


def freshness(c: str, minutes: float = CHECK_FRESHNESS_MINUTES) -> Rule:
    return Rule("freshness", (c,), threshold=minutes)


def _row_level(rule: Rule, as_of) -> tuple[Column, Column]:
    """(failed-row aggregate, success aggregate given the failure count)."""
    if rule.kind == "not_null":
        failed = F.count_if(F.col(rule.columns[0]).isNull())
        return failed, failed == 0
    if rule.kind == "accepted_values":
        c = F.col(rule.columns[0])
        failed = F.count_if(c.isNotNull() & ~c.isin(*rule.values))
        return failed, failed == 0
    if rule.kind == "min_gt":
        c = F.col(rule.columns[0])
        failed = F.count_if(c <= rule.threshold)
        return failed, F.coalesce(F.min(c) > rule.threshold, F.lit(False))
    if rule.kind == "row_count_min":
        n = F.count(F.lit(1))
        return F.when(n < rule.threshold, 1).otherwise(0).cast("long"), n >= rule.threshold
    if rule.kind == "row_count_eq":
        n = F.count(F.lit(1))
        return F.when(n != rule.threshold, 1).otherwise(0).cast("long"), n == rule.threshold
    if rule.kind == "freshness":
        age = minutes_between(as_column(as_of), F.max(rule.columns[0]))
        ok = F.coalesce(age <= rule.threshold, F.lit(False))
        return F.when(ok, 0).otherwise(1).cast("long"), ok
    raise ValueError(f"not a row-level rule: {rule.kind}")


def run_checks(df: DataFrame, zone: str, rules: Sequence[Rule], *, as_of=None) -> DataFrame:
    """Evaluate ``rules`` on ``df``; one result row per rule."""
    row_rules = [r for r in rules if r.kind != "unique"]
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, r in enumerate(row_rules):
        failed, ok = _row_level(r, as_of)
        aggs += [failed.cast("long").alias(f"_f{i}"), ok.alias(f"_s{i}")]
    one = df.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("check_name"), F.lit(r.column_label).alias("column_name"),
                 F.col(f"_f{i}").alias("failed_rows"), F.col(f"_s{i}").alias("ok"))
        for i, r in enumerate(row_rules)])) if row_rules else None
    parts: list[DataFrame] = []
    if stacked is not None:
        parts.append(one.select(F.col("_total").alias("total_rows"), stacked.alias("r"))
                     .select("r.check_name", "r.column_name", "r.failed_rows", "total_rows", "r.ok"))
    for r in (r for r in rules if r.kind == "unique"):
        cols = list(r.columns)
        # one grouped count; a single-column key ignores NULLs (a combination does not)
        counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
        key_ok = F.col(cols[0]).isNotNull() if len(cols) == 1 else F.lit(True)
        dup = counted.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_rows"),
                          F.count_if(key_ok & (F.col("_n") > 1)).alias("failed_rows"))
        parts.append(dup.select(
            F.lit(r.name).alias("check_name"), F.lit(r.column_label).alias("column_name"),
            "failed_rows", "total_rows", (F.col("failed_rows") == 0).alias("ok")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(
        F.lit(zone).alias("zone"), "check_name", "column_name", "failed_rows", "total_rows",
        (F.col("ok") & (F.col("total_rows") > 0)).alias("success"))


def source_volume(df: DataFrame, *, sources: Sequence[str] = SOURCES, min_rows: int = MIN_ROWS_PER_SOURCE,
                  zone: str = "raw") -> DataFrame:
    """Rows per expected source (zero-filled) against a minimum."""
    spark = df.sparkSession
    expected = spark.createDataFrame([(s,) for s in sources], "source string")
    counts = df.groupBy("source").agg(F.count(F.lit(1)).alias("row_count"))
    return expected.join(counts, "source", "left").select(
        F.lit(zone).alias("zone"), "source", F.coalesce("row_count", F.lit(0)).alias("row_count"),
        (F.coalesce("row_count", F.lit(0)) >= min_rows).alias("success"))


def coin_coverage(df: DataFrame, *, sources: Sequence[str] = SOURCES, coins: Sequence[str] = TRACKED_COINS,
                  zone: str = "raw") -> DataFrame:
    """Per expected source: every tracked coin seen at least once."""
    spark = df.sparkSession
    expected = spark.createDataFrame([(s,) for s in sources], "source string")
    # distinct (source, coin) pairs restricted to the tracked set: bounded by sources x coins
    seen = (df.where(F.col("coin_id").isin(*coins)).groupBy("source")
              .agg(F.count_distinct("coin_id").alias("coins_seen"),
                   F.array_sort(F.collect_set("coin_id")).alias("_seen")))
    want = F.array(*[F.lit(c) for c in sorted(coins)])
    return expected.join(seen, "source", "left").select(
        F.lit(zone).alias("zone"), "source",
        F.coalesce("coins_seen", F.lit(0)).cast("long").alias("coins_seen"),
        F.array_join(F.array_except(want, F.coalesce("_seen", F.array().cast("array<string>"))), ",").alias("missing_coins"),
        (F.coalesce("coins_seen", F.lit(0)) == len(coins)).alias("success"))


def gate(results: DataFrame) -> None:
    """Raise when any check failed (reads the small result table only)."""
    bad = results.where(~F.col("success")).select("zone", "check_name", "column_name").collect()  # a row for each rule at most
    if bad:
        raise AssertionError("quality checks failed: " + "; ".join(f"{r.zone}.{r.check_name}({r.column_name})" for r in bad))


def by_zone(results: DataFrame) -> DataFrame:
    """Pass or fail of every zone, with its counts."""
    return results.groupBy("zone").agg(F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("success")).alias("failed_checks"),
                                       F.min("success").alias("passed"))
