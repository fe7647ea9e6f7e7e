"""Batch model run: raw -> silver -> gold, each model followed by its checks.

``run_pipeline`` materialises every model as a Parquet table under a
warehouse folder (silver incrementally unless ``full_refresh``; gold fully
rewritten), runs the model's tests right after it, and skips dependants of
a model whose tests failed (the per-model gate). Every step is a Spark job
over tables written by the previous step, so lineage stays short and a lost
executor only repeats one step's tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ticklake.operators import checks as C
from ticklake.plans import gold as G
from ticklake.plans import quality as QL
from ticklake.plans import silver as S
from ticklake.session import ensure_conf

# model -> (dependencies, build function over already materialised inputs)
Build = Callable[[dict[str, DataFrame]], DataFrame]


@dataclass
class RunResult:
    built: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)
    results: DataFrame | None = None


def _tests_for(model: str):
    names = {"raw": "source:raw.crypto_prices", "stg_prices": "model:stg_crypto_prices", "silver": "model:crypto_prices_clean",
             "latest": "model:mart_latest_prices", "latest_by_source": "model:mart_latest_prices_by_source",
             "comparison": "model:mart_source_price_comparison", "daily": "model:mart_daily_prices",
             "changes": "model:fct_price_changes"}
    want = names.get(model)
    return [(z, rules) for z, _, rules in QL.MODEL_TESTS if z == want]


def run_pipeline(spark: SparkSession, raw: DataFrame, warehouse: str, *, as_of, full_refresh: bool = False,
                 gate_off: tuple[str, ...] = ()) -> RunResult:
    """Build the models in dependency order (action).

    The source and every model are tested right after they are built; a failing
    test stops the dependants, except of the names in ``gate_off``. Columns that
    the source has gained reach silver, those it has lost leave it.
    """
    ensure_conf(spark)
    path = lambda m: f"{warehouse.rstrip('/')}/{m}"
    out = RunResult()
    tables: dict[str, DataFrame] = {"raw": raw}
    results: list[DataFrame] = []

    def silver_build(t: dict[str, DataFrame]) -> DataFrame:
        return S.refresh_silver(spark, t["stg_prices"], path("silver"), full_refresh=full_refresh)

    models: list[tuple[str, tuple[str, ...], Build, bool]] = [
        # (name, deps, build, materialise)
        ("raw", (), lambda t: t["raw"], False),
        ("stg_prices", ("raw",), lambda t: S.stg_prices(t["raw"], S.source_columns(raw)), False),
        ("silver", ("stg_prices",), silver_build, False),
        # silver is a written table here: top-1 by hash aggregate + join back
        ("latest", ("silver",), lambda t: G.latest(t["silver"], method="join"), True),
        ("latest_by_source", ("silver",), lambda t: G.latest_by_source(t["silver"], method="join"), True),
        ("daily", ("silver",), lambda t: G.daily(t["silver"]), True),
        ("changes", ("silver",), lambda t: G.changes(t["silver"]), True),
        ("comparison", ("latest_by_source",), lambda t: G.comparison(t["latest_by_source"]), True),
        ("freshness", ("latest_by_source",), lambda t: G.freshness(t["latest_by_source"], as_of=as_of), True),
        ("zone_volume", ("raw", "silver", "latest_by_source"),
         lambda t: G.zone_volume(t["raw"], t["silver"], t["latest_by_source"], as_of=as_of), True),
        ("sanity", ("latest", "comparison"), lambda t: G.sanity(t["latest"], t["comparison"]), True),
    ]
    blocked: set[str] = set()
    for name, deps, build, materialise in models:
        if any(d in blocked for d in deps):
            out.skipped.append(name)
            blocked.add(name)
            continue
        df = build(tables)
        if materialise:
            # gold tables are full refreshes of small marts (and the change fact)
            df.write.mode("overwrite").parquet(path(name))
            df = spark.read.parquet(path(name))
        tables[name] = df
        if name != "raw":
            out.built.append(name)
        for zone, rules in _tests_for(name):
            # a row a rule: evaluated once, for the gate and the results alike
            found = C.run_checks(df, zone, rules, as_of=as_of)
            tested = found.collect()
            results.append(spark.createDataFrame(tested, found.schema))
            if name not in gate_off and not all(r["success"] for r in tested):
                out.failed.append(name)
                blocked.add(name)
    if results:
        res = results[0]
        for r in results[1:]:
            res = res.unionByName(r)
        out.results = res
    return out
