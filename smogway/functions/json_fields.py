"""Reading polymorphic JSON through VARIANT, where a missing key and an explicit null differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Append columns so that later filters refer to their values.

    A filter on the result of a projection is pushed down by copying the whole expression into it, and
    so on through every projection below. A one-element generator stops that.
    """
    values = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(values)))


def _wrapped(text: Column) -> Column:
    # Alone, both JSON readers would accept a record followed by other text.
    return F.concat(F.lit('{"r":'), text, F.lit("}"))


def parse_lenient(text: Column) -> Column:
    """JSON text to VARIANT, NULL when invalid.

    A bare NaN is not JSON but occurs in feeds; the JSON reader accepts it and hands it back quoted.
    """
    rewritten = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")
    single = F.when(F.size(rewritten) == 1, F.get(rewritten, F.lit(0)))
    strict = F.try_variant_get(F.try_parse_json(_wrapped(text)), "$.r", "variant")
    return F.coalesce(strict, F.try_parse_json(single))


def parse_typed(text: Column, schema: str) -> Column:
    """JSON text to (r STRUCT, damaged STRING); `damaged` is set unless the text has exactly these types.

    Several times faster than VARIANT, but a missing key and an explicit null look the same.
    """
    options = {"columnNameOfCorruptRecord": "damaged"}
    return F.from_json(_wrapped(text), f"r struct<{schema}>, damaged string", options)


def is_finite(number: Column) -> Column:
    return number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))


def members(value: Column) -> Column:
    """The members of a JSON object as a map; NULL for anything else.

    Looking a key up here is much cheaper than a path query when the key is often missing.
    """
    return F.try_variant_get(value, "$", "map<string, variant>")


def member(object_members: Column, key: str) -> Column:
    """Sub-value as VARIANT: NULL when the key is missing, a variant null when it is null."""
    return F.try_element_at(object_members, F.lit(key))


def first_element(value: Column) -> Column:
    """First element of a JSON array; NULL for anything else."""
    return F.try_variant_get(value, "$[0]", "variant")


def as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def as_number(value: Column) -> Column:
    """Number of a JSON number, boolean or quoted number; NULL otherwise."""
    return F.try_variant_get(value, "$", "double")


def json_type(value: Column) -> Column:
    """STRING, BIGINT, DECIMAL(..), DOUBLE, BOOLEAN, VOID, OBJECT<..>, ARRAY<..>; NULL when missing."""
    return F.schema_of_variant(value)


def is_text(value: Column) -> Column:
    return F.coalesce(json_type(value) == "STRING", F.lit(False))


def is_blank(value: Column) -> Column:
    """Missing, null, false, zero or empty."""
    rendered = as_text(value)
    return rendered.isNull() | rendered.isin("", "{}", "[]", "false", "0")


def non_empty(text: Column) -> Column:
    return F.when(text != "", text)


def strict_number(value: Column) -> Column:
    """A JSON number as DOUBLE; quoted numbers are rejected, a rewritten bare NaN stays NaN."""
    quoted = F.when(as_text(value) == "NaN", F.lit(float("nan")))
    return F.when(is_text(value), quoted).otherwise(as_number(value))
