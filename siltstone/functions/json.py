"""JSON documents as variants: parsed once, then asked by path. Malformed documents and missing paths are null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parsed(text: Column) -> Column:
    return F.try_parse_json(text)


def at(document: Column, path: str) -> Column:
    """The value at a path (``$.a.b[0]``), as a variant; a JSON null is a value."""
    return F.try_variant_get(document, path, "variant")


def text_at(document: Column, path: str) -> Column:
    """The value at a path as text: strings bare, arrays and objects as JSON; null for a JSON null."""
    return F.try_variant_get(document, path, "string")


def kind(value: Column) -> Column:
    """``object``, ``array``, ``string``, ``number``, ``boolean`` or ``null`` for a value; null for none."""
    schema = F.schema_of_variant(value)
    found = F.when(schema.startswith("OBJECT"), "object").when(schema.startswith("ARRAY"), "array").when(schema == "STRING", "string").when(schema == "BOOLEAN", "boolean").when(schema == "VOID", "null").otherwise("number")
    return F.when(value.isNotNull(), found)


def array_length(value: Column) -> Column:
    """The number of elements of an array; null for any other value."""
    return F.when(kind(value) == "array", F.size(F.try_variant_get(value, "$", "array<variant>")))
