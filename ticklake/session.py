"""Session helpers: the settings every plan relies on, and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the library depends on for correct results.
REQUIRED_SQL_CONF = {
    # silver time is zone-less; every `as_of` subtraction assumes UTC
    "spark.sql.session.timeZone": "UTC",
    # `dt` is a string partition; do not let discovery turn it into a DATE
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # keyed rewrites replace only the partitions they touch
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the plans need (idempotent, cheap)."""
    for k, v in REQUIRED_SQL_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


# Sizing defaults for large runs (overridable per call or by the cluster's
# spark-defaults): AQE coalesces small shuffle partitions towards the advisory
# size and splits skewed ones; scans split files at maxPartitionBytes.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def get_session(master: str | None = None, app: str = "ticklake", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster the master and resources come from spark-submit; here we only
    add SQL settings. `local[*]` is used when nothing else is configured.
    """
    b = SparkSession.builder.appName(app)
    if master or not os.environ.get("SPARK_MASTER"):
        b = b.master(master or "local[*]")
    b = b.config("spark.ui.enabled", "false")
    for k, v in {**SCALE_DEFAULTS, **REQUIRED_SQL_CONF, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_conf(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Read from the session. When it is unset, a local master gets a fresh local
    folder; on a cluster that folder would be another one on every machine, so
    the call fails there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set; {master} needs a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ticklake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/ticklake/{name}-{uuid.uuid4().hex[:12]}"


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and authority under which Spark resolves it, as a URI that other libraries read."""
    fs, p = _fs_path(spark, path)
    uri = fs.makeQualified(p).toString()
    return re.sub(r"^file:/+", "file:///", uri)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the store has the path; errors other than its absence are raised."""
    fs, p = _fs_path(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path, from the store's listing (no Spark job); none if it is absent."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory())


def files(spark: SparkSession, path: str) -> list[str]:
    """Name, length and time of the data files directly below a path, from the store's listing."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}" for f in fs.listStatus(p)
                  if f.isFile() and not f.getPath().getName().startswith(("_", ".")))


def file_times(spark: SparkSession, path: str) -> dict[str, int]:
    """Modification time (ms) of the data files directly below a path, from the store's listing."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return {}
    return {f.getPath().getName(): f.getModificationTime() for f in fs.listStatus(p)
            if f.isFile() and not f.getPath().getName().startswith(("_", "."))}


def set_file_time(spark: SparkSession, path: str, ms: int) -> None:
    """Set a file's modification time; some stores keep their own."""
    fs, p = _fs_path(spark, path)
    fs.setTimes(p, ms, -1)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that the library itself wrote (staging copies, superseded files)."""
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file of the library's own, whole or not at all where the store renames atomically."""
    fs, p = _fs_path(spark, path)
    _, beside = _fs_path(spark, f"{path}.{uuid.uuid4().hex[:12]}.tmp")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(p).toUri(), jsc.hadoopConfiguration()).rename(
        fs.makeQualified(beside), fs.makeQualified(p), how)


def read_text(spark: SparkSession, path: str) -> str:
    """Read a small file of the library's own."""
    fs, p = _fs_path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(b & 0xFF for b in spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
