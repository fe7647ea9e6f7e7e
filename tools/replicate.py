"""Derive an N-times larger copy of the driver tables for scale runs.

    python tools/replicate.py /root/testdata/sf0.1 /tmp/rep10 10

``events`` is replicated N times with each copy shifted past the previous
one in time (and in event id), so history grows N-fold instead of
duplicating keys; it is written as several files so scans split. Other
tables are linked unchanged.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(src: str, dst: str, n: int) -> None:
    from pyspark.sql import functions as F

    from ticklake.session import get_session
    spark = get_session("local[8]")
    ev = spark.read.parquet(f"{src}/events.parquet")
    b = ev.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"), F.max("event_id").alias("top")).first()
    span_us = int((b.hi - b.lo).total_seconds() * 1_000_000) + 1_000_000
    id_step = int(b.top) + 1
    rep = (ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k"))
             .select((F.col("event_id") + F.col("k") * id_step).alias("event_id"),
                     (F.col("ts") + F.make_dt_interval(secs=F.col("k") * F.lit(span_us / 1e6))).alias("ts"),
                     "user_id", "event_type", "value", "props"))
    os.makedirs(dst, exist_ok=True)
    rep.repartitionByRange(max(8, n), "event_id").write.mode("overwrite").parquet(f"{dst}/events.parquet")
    for name in os.listdir(src):
        if name != "events.parquet" and not os.path.exists(f"{dst}/{name}"):
            os.symlink(f"{src}/{name}", f"{dst}/{name}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], int(sys.argv[3]))
