"""Data-quality checks over a table that grows by days, without reading it again.

Each day partition's part of every rule is a few numbers that add up: failed
rows, rows with a value, the newest time, keys that occur twice. They are
stored beside the table's name, one row a rule and day, with a fingerprint of
the day's files. A later run reads the days whose files have changed, replaces
their numbers, and adds up all of them: the results are those of
``checks.run_checks`` over the whole table.

A uniqueness rule is a sum over days only if its columns tell the day (they
hold ``day_from``, the column the partition comes from); other uniqueness
rules are counted over the whole table each time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.timefmt import as_column, minutes_between
from ticklake.operators import tables as TB
from ticklake.operators.checks import RESULT_COLUMNS, Rule, run_checks
from ticklake.session import ensure_conf, files, folders, path_exists

NUMBERS = "rule int, failed long, valid long, total long, newest timestamp_ntz, files string, dt string"


def local(rule: Rule, day_from: str) -> bool:
    """Whether the rule's numbers add up over days."""
    return rule.kind != "unique" or day_from in rule.columns


def _numbers(rule: Rule):
    """(failed, rows with a value, newest time) of a row-level rule, as aggregates of a day."""
    c = F.col(rule.columns[0]) if rule.columns else None
    none, never = F.lit(0).cast("long"), F.lit(None).cast("timestamp_ntz")
    if rule.kind == "not_null":
        return F.count_if(c.isNull()), none, never
    if rule.kind == "accepted_values":
        return F.count_if(c.isNotNull() & ~c.isin(*rule.values)), none, never
    if rule.kind == "min_gt":
        return F.count_if(c <= rule.threshold), F.count(c), never
    if rule.kind == "freshness":
        return none, none, F.max(c).cast("timestamp_ntz")
    return none, none, never


def _of_days(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule (its place), dt and its numbers: one pass for all row-level rules, a grouped count for each uniqueness rule."""
    plain = [(k, r) for k, r in enumerate(rules) if r.kind != "unique"]
    structs = [F.struct(F.lit(k).alias("rule"), *[n.alias(a) for n, a in zip(_numbers(r), ("failed", "valid", "newest"))]) for k, r in plain]
    out = df.groupBy("dt").agg(F.count(F.lit(1)).alias("total"), *[s.alias(f"_r{k}") for (k, _), s in zip(plain, structs)])
    out = out.select("dt", "total", F.explode(F.array(*[F.col(f"_r{k}") for k, _ in plain])).alias("r")).select("r.*", "total", "dt")
    for k, r in enumerate(rules):
        if r.kind == "unique":
            each = df.groupBy("dt", *r.columns).agg(F.count(F.lit(1)).alias("_n"))
            known = F.col(r.columns[0]).isNotNull() if len(r.columns) == 1 else F.lit(True)
            found = each.groupBy("dt").agg(F.count_if(known & (F.col("_n") > 1)).alias("failed"), F.sum("_n").alias("total"))
            out = out.unionByName(found.select(F.lit(k).alias("rule"), "failed", F.lit(0).cast("long").alias("valid"),
                                               F.lit(None).cast("timestamp_ntz").alias("newest"), "total", "dt"))
    return out


def _days(spark: SparkSession, path: str) -> dict[str, str]:
    """Day partitions by the store's listing, and a fingerprint of each one's files."""
    return {d.removeprefix("dt="): ";".join(files(spark, f"{path}/{d}")) for d in folders(spark, path) if d.startswith("dt=")}


def touched_days(spark: SparkSession, path: str, store: str) -> list[str]:
    """Days whose files aren't those that the stored numbers were taken from."""
    known = {}
    if path_exists(spark, store):
        known = {r["dt"]: r["files"] for r in spark.read.schema(NUMBERS).parquet(store).select("dt", "files").distinct().collect()}  # a row a day
    return sorted(d for d, f in _days(spark, path).items() if known.get(d) != f)


def update(spark: SparkSession, path: str, store: str, rules: Sequence[Rule], *, day_from: str = "recorded_at") -> list[str]:
    """Bring the numbers of a day-partitioned table up to date (action); returns the days that were read."""
    ensure_conf(spark)
    days = touched_days(spark, path, store)
    if days:
        marks = _days(spark, path)
        mark = F.create_map(*[F.lit(x) for d in days for x in (d, marks[d])])[F.col("dt")]
        df = TB.read_table(spark, path).where(F.col("dt").isin(days))
        mine = [r if local(r, day_from) else Rule("row_count_min") for r in rules]  # places stay
        (_of_days(df, mine).select("rule", "failed", "valid", "total", "newest", mark.alias("files"), "dt").hint("rebalance", "dt")
         .write.mode("overwrite").partitionBy("dt").parquet(store))
    return days


def results(spark: SparkSession, path: str, store: str, zone: str, rules: Sequence[Rule], *, as_of=None, day_from: str = "recorded_at") -> DataFrame:
    """The rules' results from the stored numbers, as ``run_checks`` gives them."""
    live = list(_days(spark, path))
    n = spark.read.schema(NUMBERS).parquet(store).where(F.col("dt").isin(live)).groupBy("rule").agg(
        F.sum("failed").alias("failed"), F.sum("valid").alias("valid"), F.sum("total").alias("total"), F.max("newest").alias("newest"))
    found = None
    for k, r in enumerate(rules):
        if not local(r, day_from):
            one = run_checks(TB.read_table(spark, path), zone, [r], as_of=as_of)
        else:
            failed, total = F.col("failed"), F.col("total")
            if r.kind == "freshness":
                fresh = F.coalesce(minutes_between(as_column(as_of), F.col("newest")) <= r.threshold, F.lit(False))
                failed = F.when(fresh, 0).otherwise(1)
            elif r.kind == "row_count_min":
                failed = F.when(total < r.threshold, 1).otherwise(0)
            elif r.kind == "row_count_eq":
                failed = F.when(total != r.threshold, 1).otherwise(0)
            ok = (failed == 0) & ((F.col("valid") > 0) if r.kind == "min_gt" else F.lit(True)) & (total > 0)
            one = n.where(F.col("rule") == k).select(F.lit(zone).alias("zone"), F.lit(r.name).alias("check_name"), F.lit(r.column_label).alias("column_name"),
                                                     failed.cast("long").alias("failed_rows"), total.alias("total_rows"), ok.alias("success"))
        found = one if found is None else found.unionByName(one)
    return found.select(*RESULT_COLUMNS)
