"""JSON text, arrays and structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.functions.text import column


def json_scalar(value, path: str) -> Column:
    """Scalar at a JSON path as text; null for objects, arrays and bad JSON."""
    text = F.get_json_object(column(value), path)
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(column(value)), path, "variant"))
    # only texts that look like a container need the second parse
    return F.when(~text.rlike(r"^\s*[\[{]"), text).when(~kind.rlike("^(OBJECT|ARRAY)"), text)


def json_array(value, path: str) -> Column:
    """Array at a JSON path as an array of texts; null when it is not an array."""
    return F.from_json(F.get_json_object(column(value), path), "array<string>")
