"""JSON access on JSON-text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _in_path(key: str) -> bool:
    """Whether a JSON path can name the key."""
    return bool(key) and not set(key) & set("'?*\\")


def field_text(json_text: Column, key: str) -> Column:
    """``json ->> key``: the field as text; nested values come back as JSON
    text, a missing key or non-object -> NULL."""
    if _in_path(key):
        return F.get_json_object(json_text, f"$['{key}']")
    return F.from_json(json_text, "map<string, string>")[key]


def field_value(json_text: Column, key: str) -> Column:
    """``json -> key``: the field as a VARIANT sub-value."""
    if _in_path(key):
        return F.try_variant_get(F.try_parse_json(json_text), f"$['{key}']", "variant")
    return F.from_json(json_text, "map<string, variant>")[key]


def json_kind(v: Column) -> Column:
    """``jsonb_typeof`` analogue on a VARIANT: object/array/string/number/
    boolean/null (NULL for SQL NULL)."""
    s = F.schema_of_variant(v)
    return (
        F.when(v.isNull(), F.lit(None).cast("string"))
        .when(s.startswith("OBJECT"), "object")
        .when(s.startswith("ARRAY"), "array")
        .when(s == "STRING", "string")
        .when(s == "BOOLEAN", "boolean")
        .when(s == "VOID", "null")
        .otherwise("number")
    )


def array_elements(json_text: Column) -> Column:
    """``array<variant>`` of a JSON array; NULL for NULL, bad text, objects and
    scalars, so ``explode`` of it yields no rows for those (J5 guard)."""
    return F.try_variant_get(F.try_parse_json(json_text), "$", "array<variant>")
