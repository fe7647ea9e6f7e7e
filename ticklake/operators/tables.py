"""The declared columns of a Parquet table that is written in parts over time.

Files of one table may have different columns, as sources gain and lose them.
``_columns.json`` beside the partitions holds the declared schema: readers
give it to Spark, so a column that a file lacks is NULL in its rows, a column
that was dropped is gone from all partitions alike, and no footers have to be
read to find the columns. A table without the file takes the union of its
files' columns, once.

A column's type never changes silently, and a name that was dropped may come
back only after its old values are gone from the files (``forget_dropped``).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.session import ensure_conf, path_exists, read_text, remove_path, work_path, write_text

LEDGER = "_columns.json"


class ColumnTypeError(ValueError):
    """A batch has a stored column with another type."""


def _plain(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def declare(spark: SparkSession, path: str, schema: T.StructType, dropped: tuple[str, ...] = ()) -> None:
    """Write the declared schema and the names that files may still hold but readers don't see."""
    text = json.dumps({"schema": json.loads(_plain(schema).json()), "dropped": sorted(dropped)})
    write_text(spark, f"{path}/{LEDGER}", text)


def declared(spark: SparkSession, path: str) -> tuple[T.StructType, tuple[str, ...]]:
    """The table's columns and its dropped names."""
    if path_exists(spark, f"{path}/{LEDGER}"):
        held = json.loads(read_text(spark, f"{path}/{LEDGER}"))
        return T.StructType.fromJson(held["schema"]), tuple(held["dropped"])
    return _plain(ensure_conf(spark).read.option("mergeSchema", "true").parquet(path).schema), ()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """All rows with the declared columns."""
    return ensure_conf(spark).read.schema(declared(spark, path)[0]).parquet(path)


def check_types(have: T.StructType, new: T.StructType) -> None:
    types = {f.name: f.dataType for f in have.fields}
    bad = [f"{f.name}: {types[f.name].simpleString()} is stored, {f.dataType.simpleString()} comes"
           for f in new.fields if f.name in types and types[f.name] != f.dataType]
    if bad:
        raise ColumnTypeError("; ".join(bad))


def evolve(spark: SparkSession, path: str, batch: T.StructType, *, sync: bool = False, parts: tuple[str, ...] = ()) -> T.StructType:
    """The declared schema after a batch with these columns: its new columns are added;
    with ``sync`` stored columns that it lacks are dropped from the whole table, else they
    stay. Adding and dropping write the declaration alone, no data."""
    have, dropped = declared(spark, path)
    check_types(have, batch)
    names = {f.name for f in batch.fields}
    known = {f.name for f in have.fields}
    stay = [f for f in have.fields if f.name in names or not sync or f.name in parts]
    added = [f for f in _plain(batch).fields if f.name not in known]
    if {f.name for f in added} & set(dropped):
        forget_dropped(spark, path, parts)
        dropped = ()
    gone = tuple(f.name for f in have.fields if f not in stay)
    data = [f for f in (*stay, *added) if f.name not in parts]
    out = T.StructType(data + [f for f in (*stay, *added) if f.name in parts])  # partition columns come last, as Spark reads them
    if added or gone or not path_exists(spark, f"{path}/{LEDGER}"):
        declare(spark, path, out, (*dropped, *gone))
    return out


def forget_dropped(spark: SparkSession, path: str, parts: tuple[str, ...]) -> None:
    """Rewrite the table with its declared columns alone: dropped values are gone for good.
    One pass over the table, written beside it first and then over its partitions."""
    have, dropped = declared(spark, path)
    if not dropped:
        return
    staged = work_path(spark, "columns")
    read_table(spark, path).hint("rebalance", *parts).write.partitionBy(*parts).parquet(staged)
    rows = spark.read.schema(have).parquet(staged)
    rows.hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts).parquet(path)
    declare(spark, path, have)
    remove_path(spark, staged)


def fill(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with exactly these columns; those it lacks are NULL."""
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
