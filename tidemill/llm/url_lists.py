"""Temporal list join: every capture judged by the list entries that were active when it was fetched.

A list is a log of dated entries ``(kind, pattern, effective, action, seq)``: ``kind`` is ``domain``
(a registered domain or any parent of a host), ``host`` or ``prefix`` (host plus leading path
segments); ``action`` is ``block``, ``allow`` or ``remove``. ``validity`` turns the log into
half-open intervals, of two entries with one date the larger ``seq`` wins. Patterns are compared in one
spelling (``spelled``): hosts and domains in lower case, the path as it is, a prefix ending in a slash;
``host/a`` means ``host/a/`` and what lies below, ``host/`` (or ``host``) every capture of the host. ``judge`` looks every
capture's keys up as of its fetch time; the most specific active entry decides (the longest
prefix, then host, then the longest domain). Prefix keys are made for every depth that the list names.

Scale: intervals are cut into time slices, so the join's key is (kind, pattern, slice) and a host or
domain with a third of all captures, or with a very long history, is spread over the slices and split
further by the skew-join rule; each capture and key meets at most one interval. Only built-in
functions run.

Defined cases: a null or unparsable URL has no keys and is ``unlisted``; user
names and ports are not part of the host; a null fetch time matches
nothing; entries with a null pattern, date or action are ignored; repeated captures are judged each
on its own; an empty list leaves every capture ``unlisted``. Extra columns of the captures are not
carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Seconds in one time slice.
SLICE = 30 * 86_400
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?+([^/?#:@]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^?#]*)"


def spelled(entries: DataFrame) -> DataFrame:
    """``entries`` with patterns as the captures' keys spell them."""
    host, path = F.lower(F.substring_index("pattern", "/", 1)), F.regexp_extract("pattern", r"^[^/]*/?(.*?)/?$", 1)
    prefix = F.concat(host, F.lit("/"), F.when(path != "", F.concat(path, F.lit("/"))).otherwise(F.lit("")))
    return entries.withColumn("pattern", F.when(F.col("kind") == "prefix", prefix).otherwise(F.lower("pattern")))


def validity(entries: DataFrame, slice_seconds: int = SLICE) -> DataFrame:
    """(kind, pattern, action, valid_from, valid_to) from the dated entries; ``valid_to`` null: still active.

    The next date is found in two steps, inside a (pattern, slice) and between the slices' first
    dates, so one pattern's whole history never has to be one group.
    """
    key = ["kind", "pattern"]
    one = (entries.where("kind is not null and pattern is not null and effective is not null and action is not null")
           .groupBy(*key, "effective").agg(F.max(F.struct(F.coalesce("seq", F.lit(-1)).alias("seq"), "action")).alias("last"))
           .select(*key, "effective", F.col("last.action").alias("action"),
                   F.floor(F.col("effective") / slice_seconds).alias("part")))
    inside = one.withColumn("next_in", F.lead("effective").over(Window.partitionBy(*key, "part").orderBy("effective")))
    heads = (one.groupBy(*key, "part").agg(F.min("effective").alias("head"))
             .withColumn("next_head", F.lead("head").over(Window.partitionBy(*key).orderBy("part"))).drop("head"))
    return (inside.join(heads, [*key, "part"])
            .select(*key, "action", F.col("effective").alias("valid_from"),
                    F.coalesce("next_in", "next_head").alias("valid_to")))


def prefix_depths(entries: DataFrame) -> list[int]:
    """The numbers of path segments that the list's prefix entries name."""
    found = entries.where("kind = 'prefix' and pattern is not null").select((F.size(F.split("pattern", "/")) - 2).alias("depth")).distinct()
    return sorted(r["depth"] for r in found.collect())


def keys_of(captures: DataFrame, depths: list[int]) -> DataFrame:
    """Every capture once for each key that a list entry could name, prefixes of the ``depths``; ``level`` grows with specificity."""
    host = F.lower(F.regexp_extract("url", _HOST, 1))
    labels = F.split("host", r"\.")
    path = F.split(F.regexp_extract("url", _PATH, 1), "/")
    domains = F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(labels))), lambda n: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(labels, -n, n), ".").alias("pattern"), n.cast("int").alias("level")))
    prefixes = F.transform(F.array(*map(F.lit, depths)).cast("array<int>"), lambda n: F.struct(
        F.lit("prefix").alias("kind"),
        F.concat(F.col("host"), F.lit("/"), F.when(n > 0, F.concat(F.array_join(F.slice(path, F.lit(1), n), "/"), F.lit("/")))
                 .otherwise(F.lit(""))).alias("pattern"),
        (n + 1000).cast("int").alias("level")))
    own = F.array(F.struct(F.lit("host").alias("kind"), F.col("host").alias("pattern"), F.lit(500).alias("level")))
    none = F.array(F.struct(F.lit("none").alias("kind"), F.col("capture").cast("string").alias("pattern"), F.lit(0).alias("level")))
    usable = F.filter(F.concat(F.when(F.size(labels) >= 2, domains).otherwise(F.slice(domains, 1, 0)), own,
                               F.filter(prefixes, lambda p: p["level"] - 1000 < F.size(path))), lambda k: k["pattern"].isNotNull())
    return (captures.select("page_id", "url", "fetch_time")
            .withColumn("capture", F.monotonically_increasing_id())
            .withColumn("host", F.coalesce(F.when(host != "", host), F.lit("")))
            .withColumn("key", F.explode(F.when(F.col("host") != "", usable).otherwise(none)))
            .select("capture", "page_id", "url", "host", "fetch_time", "key.*"))


def judge(captures: DataFrame, entries: DataFrame, slice_seconds: int = SLICE) -> DataFrame:
    """One row per capture: ``verdict`` (block, allow, unlisted) and the entry that decided.

    ``captures``: page_id, url, fetch_time (seconds); ``entries``: see the module.
    """
    entries = spelled(entries)
    spans = validity(entries, slice_seconds).where("action <> 'remove'")
    low, high = captures.agg(F.min("fetch_time"), F.max("fetch_time")).first()
    low, high = low or 0, high or 0
    part = lambda c: F.floor(c / slice_seconds)
    spans = (spans.where((F.col("valid_from") <= high) & (F.col("valid_to").isNull() | (F.col("valid_to") > low)))
             .withColumn("part", F.explode(F.sequence(
                 part(F.greatest("valid_from", F.lit(low))), part(F.least(F.coalesce(F.col("valid_to") - 1, F.lit(high)), F.lit(high)))))))
    asked = keys_of(captures, prefix_depths(entries)).withColumn("part", part(F.col("fetch_time")))
    hits = (asked.join(spans, ["kind", "pattern", "part"], "left")
            .withColumn("hit", F.when((F.col("valid_from") <= F.col("fetch_time"))
                                      & (F.col("valid_to").isNull() | (F.col("fetch_time") < F.col("valid_to"))),
                                      F.struct("level", "kind", "pattern", "action", "valid_from"))))
    return (hits.groupBy("capture", "page_id", "url", "host", "fetch_time").agg(F.max("hit").alias("hit"))
            .select("page_id", "url", "host", "fetch_time", F.coalesce("hit.action", F.lit("unlisted")).alias("verdict"),
                    F.col("hit.kind").alias("rule_kind"), F.col("hit.pattern").alias("rule_pattern"),
                    F.col("hit.valid_from").alias("rule_from")))
