"""JSON text helpers built on VARIANT: one parse per message, then typed reads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")


def parse(text: Column) -> Column:
    """Whole-document parse; NULL for invalid JSON (so a broken object never
    yields the fields that precede the error)."""
    return F.try_parse_json(text)


def with_variant(df, text_col: str, name: str = "_v"):
    """Project the parsed document once as a column. Expressions that read
    fields must use this column: Spark keeps a multiply-referenced,
    non-trivial projection instead of inlining (and re-parsing) it per use."""
    return df.withColumn(name, parse(F.col(text_col)))


def type_of(v: Column, path: str) -> Column:
    """Variant type name at ``path`` ('STRING', 'BIGINT', 'DECIMAL(3,2)', 'VOID',
    'OBJECT<..>', ...) or NULL when the key is absent."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def is_number(type_name: Column) -> Column:
    return type_name.isin(*NUMBER_TYPES) | type_name.startswith("DECIMAL")


def is_scalar(type_name: Column) -> Column:
    return ~(type_name.startswith("OBJECT") | type_name.startswith("ARRAY"))


def scalar_text(v: Column, path: str) -> Column:
    """JSON_VALUE semantics: text of a scalar at ``path``; NULL for a missing
    key, JSON null, an object or an array."""
    t = type_of(v, path)
    return F.when(is_scalar(t), F.try_variant_get(v, path, "string"))


def scalar_double(v: Column, path: str) -> Column:
    """Scalar text then TRY_CAST to DOUBLE: integers and quoted numbers pass."""
    return scalar_text(v, path).try_cast("double")


def keys(text: Column) -> Column:
    """Top-level keys of a JSON object text, NULL otherwise."""
    return F.json_object_keys(text)


def filter_parsed(df, cond: Column):
    """Rows of ``df`` where ``cond`` holds, for conditions over fields read
    from a projected VARIANT.

    A plain ``where`` would be pushed below the projection that parses the
    document, with the parse substituted into every predicate reference
    (one JSON parse per reference). Predicates are never pushed through a
    generator, so the rows are kept by exploding a one-element array that
    is NULL (no row) when ``cond`` is false: every document is parsed once.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    kept = df.select(F.explode(F.when(F.coalesce(cond, F.lit(False)), F.array(row))).alias("_row"))
    return kept.select("_row.*")


def explode_parsed(values: Column) -> Column:
    """One row per element of an array computed from a projected VARIANT (none
    for an empty or NULL array).

    For an exploded column Spark adds a filter on its size, which is pushed
    below the projection that parses the document, as in ``filter_parsed``.
    It adds none for an expression, so the array is wrapped in one.
    """
    return F.explode(F.when(F.size(values) > 0, values))
