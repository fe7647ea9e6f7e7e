"""The price-event contract as native column rules.

``with_contract`` checks JSON text (types come from VARIANT);
``typed_violations`` checks an already-typed EVENT frame. Both add
``violations`` (array<string>, empty when valid) in a fixed rule order:
missing required keys, unexpected keys, then one entry per failing field.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions import jsonx
from ticklake.functions.timefmt import parse_event_time
from ticklake.schemas import (CONTRACT_FIELDS, CONTRACT_REQUIRED, SOURCES, SYMBOL_MAX_LEN, SYMBOL_MIN_LEN,
                              TRACKED_COINS)

NOT_OBJECT = "not_an_object"


def _arr(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _flags(pairs: list[tuple[Column, str]]) -> Column:
    """array of rule names whose condition is true (NULL conditions are false)."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for c, name in pairs]))


def json_violations(raw: Column, *, coins: Sequence[str] = TRACKED_COINS, sources: Sequence[str] = SOURCES,
                    strict_time: bool = False, parsed: Column | None = None) -> Column:
    """Violations of the contract for JSON text ``raw`` (array<string>).
    ``parsed``: the text's VARIANT when it is already projected as a column."""
    v = parsed if parsed is not None else jsonx.parse(raw)
    keys = jsonx.keys(raw)
    missing = F.transform(F.array_except(_arr(CONTRACT_REQUIRED), keys), lambda k: F.concat(F.lit("missing:"), k))
    extra = F.transform(F.array_except(keys, _arr(CONTRACT_FIELDS)), lambda k: F.concat(F.lit("extra:"), k))

    def t(name: str) -> Column:
        return jsonx.type_of(v, f"$.{name}")

    def present(name: str) -> Column:
        return t(name).isNotNull()

    def text(name: str) -> Column:
        return F.try_variant_get(v, f"$.{name}", "string")

    is_str = {n: t(n) == "STRING" for n in CONTRACT_FIELDS}
    rules = [
        (present("coin_id") & ~(is_str["coin_id"] & text("coin_id").isin(*coins)), "coin_id"),
        (present("symbol") & ~(is_str["symbol"] & F.char_length(text("symbol")).between(SYMBOL_MIN_LEN, SYMBOL_MAX_LEN)), "symbol"),
        (present("price_usd") & ~(jsonx.is_number(t("price_usd"))
                                  & (F.try_variant_get(v, "$.price_usd", "double") > 0)), "price_usd"),
        (present("market_cap") & ~(jsonx.is_number(t("market_cap")) | (t("market_cap") == "VOID")), "market_cap"),
        (present("change_24h") & ~(jsonx.is_number(t("change_24h")) | (t("change_24h") == "VOID")), "change_24h"),
        (present("event_time") & ~is_str["event_time"], "event_time"),
        (present("source") & ~(is_str["source"] & text("source").isin(*sources)), "source"),
    ]
    if strict_time:
        rules.append((is_str["event_time"] & parse_event_time(text("event_time")).isNull(), "event_time:format"))
    checked = F.concat(missing, extra, _flags(rules))
    return F.when(jsonx.is_object(v), checked).otherwise(F.array(F.lit(NOT_OBJECT)))


def with_contract(df: DataFrame, raw_col: str, **kw) -> DataFrame:
    """Add ``violations`` for the JSON text in ``raw_col``; valid = empty."""
    return (jsonx.with_variant(df, raw_col, "_v_contract")
            .withColumn("violations", json_violations(F.col(raw_col), parsed=F.col("_v_contract"), **kw))
            .drop("_v_contract"))


def typed_violations(*, coins: Sequence[str] = TRACKED_COINS, sources: Sequence[str] = SOURCES) -> Column:
    """Violations of a typed EVENT row (columns coin_id .. source). Every key
    is present in a typed row, so a NULL fails its field's type rule."""
    ok = [
        (F.col("coin_id").isin(*coins), "coin_id"),
        (F.char_length("symbol").between(SYMBOL_MIN_LEN, SYMBOL_MAX_LEN), "symbol"),
        ((F.col("price_usd") > 0) & ~F.isnan("price_usd"), "price_usd"),
        (F.col("event_time").isNotNull(), "event_time"),
        (F.col("source").isin(*sources), "source"),
    ]
    return _flags([(~F.coalesce(c, F.lit(False)), name) for c, name in ok])


def is_valid(violations: Column) -> Column:
    return F.size(violations) == 0
