"""Lenient JSON payloads as typed structs (``struct<key: variant, ...>``).

Each known top-level key becomes a variant field that keeps its JSON type:
an absent key is SQL null, an explicit JSON null is a VOID variant, and a
duplicated key keeps its last value. With that, the defaults and failures of
a dynamically typed consumer (absent vs null, truthiness, text vs object)
are plain column expressions. Object-ness and size of the whole payload come
from ``json_object_keys``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MAP_SCHEMA = "map<string,variant>"


def struct_schema(keys: Sequence[str]) -> str:
    return "struct<" + ", ".join(f"`{k}`: variant" for k in keys) + ">"


def payload_struct(data: Column, keys: Sequence[str]) -> Column:
    return F.from_json(data, struct_schema(keys))


def payload_keys(data: Column) -> Column:
    """Distinct top-level keys of an object payload; null for anything else."""
    return F.array_distinct(F.json_object_keys(data))


def payload_kind(data: Column, keys: Column) -> Column:
    """missing / invalid / object / array / null / scalar."""
    v = F.try_parse_json(data)
    return (F.when(data.isNull(), "missing")
             .when(keys.isNotNull(), "object")
             .when(v.isNull(), "invalid")
             .when(F.is_variant_null(v), "null")
             .when(F.schema_of_variant(v).startswith("ARRAY"), "array")
             .otherwise("scalar"))


def payload_truthy(data: Column, kind: Column, keys: Column) -> Column:
    """Python truthiness of the decoded payload (invalid/missing decode to ``{}``)."""
    return (F.when(kind == "object", F.size(keys) > 0)
             .when(kind.isin("missing", "invalid", "null"), F.lit(False))
             .otherwise(truthy(F.try_parse_json(data))))


def vtype(v: Column) -> Column:
    """JSON type name of a variant: OBJECT, ARRAY, VOID (null), BOOLEAN, STRING, BIGINT, ..."""
    # "OBJECT<a: BIGINT>" -> OBJECT, "DECIMAL(3,1)" -> DECIMAL, "BIGINT" -> BIGINT
    return F.substring_index(F.substring_index(F.schema_of_variant(v), "<", 1), "(", 1)


def truthy(v: Column) -> Column:
    """Python truthiness of a decoded JSON value (SQL null = absent = falsy)."""
    t = vtype(v)
    return (F.when(v.isNull() | (t == "VOID"), F.lit(False))
             .when(t == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
             .when(t == "STRING", F.length(F.try_variant_get(v, "$", "string")) > 0)
             .when(t == "OBJECT", F.size(F.json_object_keys(F.to_json(v))) > 0)
             .when(t == "ARRAY", F.json_array_length(F.to_json(v)) > 0)
             .otherwise(F.try_variant_get(v, "$", "double") != 0))


def vstring(v: Column) -> Column:
    """Text of a scalar value (JSON null -> null)."""
    return F.try_variant_get(v, "$", "string")


def as_map(v: Column) -> Column:
    """A JSON object value as ``map<string, variant>`` (null if it is not an object)."""
    return F.from_json(F.to_json(v), MAP_SCHEMA)


def has(p: Column, key: str) -> Column:
    return p[key].isNotNull()


def get_or(p: Column, key: str, default: Column) -> Column:
    """``dict.get(key, default)``: the default only when the key is absent."""
    return F.when(has(p, key), p[key]).otherwise(default)
