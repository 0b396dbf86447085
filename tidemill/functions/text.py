"""Small column expressions over text: UUIDs, PostgreSQL boolean text, source paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# PostgreSQL boolean input (case-insensitive, unique prefixes of
# true/yes/false/no, and on/off from two letters, 1/0 exactly).
PG_TRUE_TEXT = r"^(t|tr|tru|true|y|ye|yes|on|1)$"
PG_FALSE_TEXT = r"^(f|fa|fal|fals|false|n|no|of|off|0)$"

# Fixed value: PostgreSQL uuid input: 32 hex digits, optional hyphen after any
# group of four, optionally inside braces.
PG_UUID_TEXT = r"^(\{[0-9a-f]{4}(-?[0-9a-f]{4}){7}\}|[0-9a-f]{4}(-?[0-9a-f]{4}){7})$"


def bool_text(text: Column) -> Column:
    """PostgreSQL ``text::boolean``; text it would reject gives null."""
    t = F.lower(F.trim(text))
    return F.when(t.rlike(PG_TRUE_TEXT), F.lit(True)).when(t.rlike(PG_FALSE_TEXT), F.lit(False))


_HEX32_GROUPS = r"^([0-9a-f]{8})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{12})$"


def _hyphenate(h: Column) -> Column:
    """32 hex digits -> 8-4-4-4-12 (one regex pass over ``h``)."""
    return F.regexp_replace(h, _HEX32_GROUPS, "$1-$2-$3-$4-$5")


def canonical_uuid(text: Column) -> Column:
    """Lenient UUID parse -> lower-case 8-4-4-4-12 form, else null.

    Like the consumer: drop ``urn:`` then ``uuid:``, strip ``{``/``}`` from both
    ends, drop hyphens, then require 32 hex digits.
    """
    h = F.regexp_replace(F.regexp_replace(F.lower(text), "urn:", ""), "uuid:", "")
    h = F.regexp_replace(h, r"^[{}]+|[{}]+$|-", "")
    return F.when(h.rlike("^[0-9a-f]{32}$"), _hyphenate(h))


def pg_uuid(text: Column) -> Column:
    """PostgreSQL uuid input -> canonical form, else null (a query error in the database)."""
    t = F.lower(text)
    return F.when(t.rlike(PG_UUID_TEXT), _hyphenate(F.regexp_replace(t, r"[{}-]", "")))


def source_path(path: Column) -> Column:
    """Path from the first ``src`` segment on, else the base name."""
    parts = F.split(path, "/")
    pos = F.array_position(parts, "src")
    return F.when(pos > 0, F.array_join(F.slice(parts, pos.cast("int"), F.size(parts)), "/")) \
            .otherwise(F.element_at(parts, -1))
