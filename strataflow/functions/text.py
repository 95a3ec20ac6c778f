"""Text and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: previews are cut after this many characters.
PREVIEW_CHARS = 500


def json_text(payload: Column, *path: str | int) -> Column:
    """Text at a JSON path; names step into objects and integers into arrays."""
    steps = "".join(f"[{p}]" if isinstance(p, int) else f".{p}" for p in path)
    return F.get_json_object(payload, "$" + steps)


def inner_or_self(field: Column, inner: str) -> Column:
    """`field.inner` where the JSON text of the field is an object that has it, else the field itself."""
    return F.coalesce(F.get_json_object(field, f"$.{inner}"), field)


def json_inner_or_self(payload: Column, field: str, inner: str) -> Column:
    """`payload.field.inner` where the field is an object that has it, else the field itself."""
    return inner_or_self(json_text(payload, field), inner)


def namespace_id(namespace: Column) -> Column:
    """Namespace number from a JSON text that is an object with `id`, a bare number, or absent."""
    return F.coalesce(
        F.get_json_object(namespace, "$.id").try_cast("int"),
        namespace.try_cast("int"),
        F.lit(0),
    )


def json_kind(payload: Column) -> Column:
    """Type name of a JSON text: object, array, string, boolean, null or number."""
    first = F.substring(F.ltrim(payload), 1, 1)
    return (
        F.when(payload.isNull() | (first == ""), F.lit(None).cast("string"))
        .when(first == "{", "object")
        .when(first == "[", "array")
        .when(first == '"', "string")
        .when(first.isin("t", "f"), "boolean")
        .when(first == "n", "null")
        .otherwise("number")
    )


def slug(title: Column) -> Column:
    return F.replace(title, F.lit(" "), F.lit("_"))


def preview(text: Column, limit: int = PREVIEW_CHARS) -> Column:
    """The text itself, or its first `limit` characters and an ellipsis."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def utf8_bytes(text: Column) -> Column:
    return F.octet_length(text)


def filled(value: Column) -> Column:
    """The value, with empty text turned into NULL."""
    return F.nullif(value, F.lit(""))


def first_filled(*values: Column) -> Column:
    return F.coalesce(*[filled(v) for v in values])


def join_filled(separator: str, *values: Column) -> Column:
    """Join the values that are neither NULL nor empty."""
    return F.concat_ws(separator, *[filled(v) for v in values])


def same_ignoring_case(a: Column, b: Column) -> Column:
    return F.lower(a) == F.lower(b)
