"""Idempotent sinks on plain Parquet (no table format needed).

* ``merge_by_key`` / ``upsert_by_key``: keyed upsert. Per key the row of the
  greatest ``order`` (stored with the row) wins, whatever order batches come
  in, so a replay of any batch changes nothing; the first ``ingested_at`` of a
  key is kept. A batch may lack stored columns (a key keeps their values, new
  keys have NULL) and bring new ones (see ``tables``); another type fails. Only the partitions the batch touches are read (a literal
  partition filter), batch rows without a stored key are appended, and only
  partitions in which a stored row loses are rewritten, from a staging copy.
* ``insert_if_absent``: in-batch dedupe (first wins) + anti join + append.
* ``append_lake``: the Hive-partitioned lake (source/coin_id/dt/batch). A
  batch is named by its query and number, so no two queries or checkpoints
  share one; writing it again replaces exactly its own files. With ``ids``
  rows whose log position is already stored in a touched partition are left
  out, so a replay under another name adds nothing.
* ``compact_lake`` / ``compact_days``: write the rows of one or many days as one
  new level, in one job, then remove the levels it replaces; run again after a
  crash they drop what was doubled.

Every action is a Spark job (task retries survive a lost executor) and can
be re-run with the same arguments to the same result.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.operators import tables as TB
from ticklake.operators.keyed import dedupe_by_key, top1_by_key
from ticklake.schemas import LAKE_PARTITIONS
from ticklake.session import ensure_conf, folders, path_exists, remove_path, work_path

BATCH_COL = "batch"


def latest_per_key(batch: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """In-batch dedupe: per key the row with the greatest ``order`` wins."""
    payload = [c for c in batch.columns if c not in key]
    ordered = batch.withColumn("_ord", F.struct(*[F.col(c) for c in order]))
    top = top1_by_key(ordered, key, "_ord", payload)
    return top.select(*batch.columns)


def merge_by_key(existing: DataFrame | None, batch: DataFrame, key: Sequence[str], order: Sequence[str], *,
                 keep_first: Sequence[str] = ("ingested_at",)) -> DataFrame:
    """New state after upserting ``batch`` into ``existing`` (pure plan).

    Per key the greatest ``order`` wins (on equal order the stored row stays);
    ``keep_first`` columns keep the stored value of a key.
    """
    new = latest_per_key(batch, key, order)
    if existing is None:
        return new
    TB.check_types(existing.schema, new.schema)
    absent = [f for f in existing.schema.fields if f.name not in new.columns]
    new = new.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
    new = _winners(existing, new, key, order, [*keep_first, *[f.name for f in absent]])
    kept = existing.join(new.select(*key), on=list(key), how="left_anti")
    return kept.unionByName(new.drop("_stored"), allowMissingColumns=True)


def _winners(existing: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str],
             keep_first: Sequence[str]) -> DataFrame:
    """The rows of ``new`` (one per key) that beat the stored row or have none;
    ``_stored`` tells which. ``existing`` needs key, order and kept columns only."""
    keep = [c for c in keep_first if c in existing.columns and c in new.columns]
    old = existing.select(*key, F.struct(*[F.col(c) for c in order]).alias("_old_order"),
                          *[F.col(c).alias(f"_old_{c}") for c in keep])
    j = new.join(old, on=list(key), how="left")
    j = j.where(F.col("_old_order").isNull() | (F.struct(*[F.col(c) for c in order]) > F.col("_old_order")))
    return j.select(*[F.coalesce(F.col(f"_old_{c}"), F.col(c)).alias(c) if c in keep else F.col(c) for c in new.columns],
                    F.col("_old_order").isNotNull().alias("_stored"))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written at ``path``; a store that can't answer raises."""
    return path_exists(spark, path)


def touched_filter(values: list, parts: Sequence[str]):
    """Literal predicate for the given partition values: it prunes folders before any file is read."""
    if len(parts) == 1:
        known = [v[0] for v in values if v[0] is not None]
        cond = F.col(parts[0]).isin(known)
        return cond if len(known) == len(values) else cond | F.col(parts[0]).isNull()
    groups: dict[tuple, list] = {}
    for v in values:
        groups.setdefault(tuple(v[:-1]), []).append(v[-1:])
    conds = []
    for head, last in groups.items():
        each = touched_filter(last, parts[-1:])
        for c, x in zip(parts, head):
            each = F.col(c).eqNullSafe(F.lit(x)) & each
        conds.append(each)
    while len(conds) > 1:  # in pairs: a chain of hundreds of ORs overflows the analyser's stack
        conds = [a | b for a, b in zip(conds[::2], conds[1::2])] + conds[len(conds) & ~1:]
    return conds[0] if conds else F.lit(False)


def upsert_by_key(batch: DataFrame, path: str, key: Sequence[str], order: Sequence[str], *,
                  partition_by: Sequence[str] = ("dt",), keep_first: Sequence[str] = ("ingested_at",), sync: bool = False) -> None:
    """Upsert ``batch`` into the Parquet table at ``path`` (action).

    ``key`` must determine the partition columns (e.g. ``dt`` from
    ``recorded_at``) and ``order`` must be stored columns. Columns that the
    batch brings are added to the table; stored columns that it lacks keep
    their values, or with ``sync`` are dropped from the whole table.
    """
    spark = ensure_conf(batch.sparkSession)
    parts = list(partition_by)
    full_key = list(dict.fromkeys([*key, *parts]))
    staged = work_path(spark, "upsert-batch")
    latest_per_key(batch, full_key, order).select(*batch.columns).write.parquet(staged)  # read several times below
    new = spark.read.schema(batch.schema).parquet(staged)
    if not table_exists(spark, path):
        new.hint("rebalance", *parts).write.mode("append").partitionBy(*parts).parquet(path)
        TB.declare(spark, path, T.StructType([*[f for f in batch.schema.fields if f.name not in parts], *[batch.schema[c] for c in parts]]))
        remove_path(spark, staged)
        return
    schema = TB.evolve(spark, path, batch.schema, sync=sync, parts=tuple(parts))
    absent = [c for c in schema.names if c not in batch.columns]
    new = TB.fill(new, schema)
    touched = [tuple(r) for r in new.select(*parts).distinct().collect()]  # partition values of one batch
    if touched:
        stored = spark.read.schema(schema).parquet(path).where(touched_filter(touched, parts))
        keep = [*[c for c in keep_first if c in batch.columns], *absent]
        win = _winners(stored.select(*dict.fromkeys([*full_key, *order, *keep])), new, full_key, order, keep)
        won = work_path(spark, "upsert-winners")
        win.write.parquet(won)
        win = spark.read.schema(win.schema).parquet(won)
        clash = [tuple(r) for r in win.where("_stored").select(*parts).distinct().collect()]
        if clash:
            inside = touched_filter(clash, parts)
            rewrite = work_path(spark, "upsert-rewrite")
            rows = win.where(inside).drop("_stored").select(*schema.names)
            kept = stored.where(inside).join(rows.select(*full_key), on=full_key, how="left_anti").select(*schema.names)
            kept.unionByName(rows).hint("rebalance", *parts).write.partitionBy(*parts).parquet(rewrite)
            (spark.read.schema(schema).parquet(rewrite).select(*schema.names)
             .hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts).parquet(path))
            remove_path(spark, rewrite)
            win = win.where(~F.coalesce(inside, F.lit(False)))
        (win.drop("_stored").select(*schema.names).hint("rebalance", *parts)
         .write.mode("append").partitionBy(*parts).parquet(path))
        remove_path(spark, won)
    remove_path(spark, staged)


def insert_if_absent(existing: DataFrame | None, batch: DataFrame, key: Sequence[str],
                     order: Sequence[str] = ()) -> DataFrame:
    """Rows of ``batch`` to append: first row per key (by ``order``
    ascending, NULLs last) whose key is not already in ``existing``."""
    tie = list(order) or [c for c in batch.columns if c not in key]
    rest = [c for c in batch.columns if c not in key and c not in tie]
    first = dedupe_by_key(batch, key, tie, rest).select(*batch.columns)
    if existing is None:
        return first
    return first.join(existing.select(*key), on=list(key), how="left_anti")


def append_if_absent(batch: DataFrame, path: str, key: Sequence[str], order: Sequence[str] = (), *,
                     partition_by: Sequence[str] = ()) -> None:
    """Action: append the rows of ``batch`` whose key is not yet at ``path``.

    ``key`` must determine the partition columns: stored keys are read from the
    partitions that the batch touches alone, by a literal filter, and their key
    columns only. On a large side Spark adds its runtime Bloom filter to the join.
    """
    spark = ensure_conf(batch.sparkSession)
    parts = list(partition_by)
    if not table_exists(spark, path):
        rows, schema = insert_if_absent(None, batch, key, order), None
    else:
        schema = TB.evolve(spark, path, batch.schema, parts=tuple(parts))
        stored = spark.read.schema(schema).parquet(path)
        if parts:
            touched = [tuple(r) for r in batch.select(*parts).distinct().collect()]  # partition values of one batch
            stored = stored.where(touched_filter(touched, parts)) if touched else stored.limit(0)
        rows = TB.fill(insert_if_absent(stored, batch, key, order), schema)
    staging = work_path(spark, "insert-staging")
    rows.write.mode("overwrite").parquet(staging)
    w = spark.read.schema(rows.schema).parquet(staging)
    if parts:
        w.hint("rebalance", *parts).write.mode("append").partitionBy(*parts).parquet(path)
    else:
        w.write.mode("append").parquet(path)
    if schema is None:
        TB.declare(spark, path, T.StructType([*[f for f in rows.schema.fields if f.name not in parts], *[rows.schema[c] for c in parts]]))
    remove_path(spark, staging)


def append_batch(rows: DataFrame, path: str, batch: str, parts: Sequence[str], *, ids: Sequence[str] = (),
                 max_records_per_file: int = 1_000_000) -> None:
    """Write ``rows`` under ``parts``/batch=<batch>, replacing that batch's own files.

    ``batch`` must name one set of rows for good (a query id and its batch
    number). With ``ids``, columns that name a row (its log position), rows
    already stored under another batch of a touched partition are left out.
    Rows are rebalanced by partition columns: each partition gets few files,
    and AQE splits a hot one over several tasks."""
    spark = ensure_conf(rows.sparkSession)
    out = rows.select(*[c for c in rows.columns if c not in (*parts, BATCH_COL)], *parts, F.lit(str(batch)).alias(BATCH_COL))
    if ids and table_exists(spark, path):
        touched = [tuple(r) for r in rows.select(*parts).distinct().collect()]  # partition values of one batch
        if touched:
            have = (spark.read.schema(out.schema).parquet(path).where(touched_filter(touched, parts))
                    .where(F.col(BATCH_COL) != str(batch)).select(*ids))
            out = out.join(have, on=list(ids), how="left_anti").select(*out.columns)
    (out.hint("rebalance", *parts)
        .write.mode("overwrite").option("compression", "snappy")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*parts, BATCH_COL).parquet(path))


def append_lake(df: DataFrame, path: str, batch: str | int, *, ids: Sequence[str] = (), max_records_per_file: int = 1_000_000) -> None:
    """Land rows (LAKE columns and ``ids``) under source/coin_id/dt/batch=<batch>."""
    append_batch(df, path, str(batch), LAKE_PARTITIONS, ids=ids, max_records_per_file=max_records_per_file)


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """The lake without the batch bookkeeping column (``dt`` stays a string)."""
    ensure_conf(spark)
    return spark.read.parquet(path).drop(BATCH_COL)


def _compact(spark: SparkSession, path: str, partitions: Sequence[str], ids: Sequence[str], rows_per_file: int) -> None:
    """Rewrite the listed partitions (source=/coin_id=/dt= folders) as one new level, in one job. Only listed
    levels are read and removed, so what lands meanwhile stays."""
    ensure_conf(spark)
    old = [f"{path}/{p}/{name}" for p in partitions for name in folders(spark, f"{path}/{p}")]
    if not old:
        return
    rows = spark.read.option("basePath", path).parquet(*old).drop(BATCH_COL)
    if ids:
        rows = rows.dropDuplicates([*LAKE_PARTITIONS, *ids])
    append = rows.withColumn(BATCH_COL, F.lit(f"compacted-{uuid.uuid4().hex[:12]}")).hint("rebalance", *LAKE_PARTITIONS).write.mode("append")
    append.option("maxRecordsPerFile", rows_per_file).partitionBy(*LAKE_PARTITIONS, BATCH_COL).parquet(path)
    for level in old:
        remove_path(spark, level)


def compact_lake(spark: SparkSession, path: str, source: str, coin_id: str, dt: str, *, ids: Sequence[str] = (),
                 rows_per_file: int = 1_000_000) -> None:
    """Rewrite one (source, coin, day) into few files, each task writing about
    one. The new level is written before the old ones are removed, so a crash
    loses nothing; with ``ids`` the next run drops what it left twice. Each run's
    level has a name of its own."""
    _compact(spark, path, [f"source={source}/coin_id={coin_id}/dt={dt}"], ids, rows_per_file)


def compact_days(spark: SparkSession, path: str, *, days: int | None = 1, ids: Sequence[str] = (), rows_per_file: int = 1_000_000) -> None:
    """Compact the oldest ``days`` days (None: all) of every source and coin, in one
    job as ``compact_lake`` does; partitions come from the store's listing."""
    _compact(spark, path, [f"{s}/{c}/{d}" for s in folders(spark, path) for c in folders(spark, f"{path}/{s}")
                           for d in folders(spark, f"{path}/{s}/{c}")[:days]], ids, rows_per_file)


def lake_inventory(spark: SparkSession, path: str, *, last: int = 30) -> DataFrame:
    """Newest data files of the lake: partition, file, size, time.

    A file listing as a DataFrame (the binary-file source without its
    ``content`` column reads no data)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(path)
             .select(F.col("path").alias("file_path"), F.col("length").alias("file_size"),
                     F.col("modificationTime").alias("modified_at")))
    return (files.withColumn("partition", F.regexp_extract("file_path", r"(source=[^/]+/coin_id=[^/]+/dt=[^/]+)", 1))
            .orderBy(F.col("modified_at").desc(), F.col("file_path").desc()).limit(last))
