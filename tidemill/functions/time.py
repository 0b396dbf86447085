"""Time helpers: ISO parsing, month keys, and range predicates that prune partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: partition names and month keys follow the reference's layout.
MONTH_NAME_FORMAT = "yyyy_MM"

ISO_DATE_PREFIX = r"^\s*\d{4}-\d{2}-\d{2}"
ISO_ZONE_SUFFIX = r"(?i)\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*(z|[+-]\d{2}(:?\d{2})?)$"


def _iso_extended(t: Column) -> Column:
    """Rewrite the ISO forms Python's ``fromisoformat`` also accepts into extended form.

    * week dates ``YYYY-Www[-D]`` / ``YYYYWww[D]`` -> the calendar date (Monday
      of ISO week 1 is 4 January minus its weekday);
    * compact dates ``YYYYMMDD`` -> ``YYYY-MM-DD``;
    * any single separator character before the time -> ``T``;
    * compact times ``HHMM[SS]`` -> ``HH:MM[:SS]``, decimal comma -> point.
    """
    week = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?(?=$|[^0-9])"
    y = F.regexp_extract(t, week, 1).cast("int")
    wk = F.regexp_extract(t, week, 2).cast("int")
    dd = F.coalesce(F.nullif(F.regexp_extract(t, week, 3), F.lit("")).cast("int"), F.lit(1))
    jan4 = F.make_date(y, F.lit(1), F.lit(4))
    week_date = F.date_add(F.date_sub(jan4, F.weekday(jan4)), (wk - 1) * 7 + dd - 1)
    rest = F.regexp_replace(t, week, "")
    t = F.when(t.rlike(week), F.concat(F.date_format(week_date, "yyyy-MM-dd"), rest)).otherwise(t)
    t = F.regexp_replace(t, r"^(\d{4})(\d{2})(\d{2})(?=$|[^0-9])", "$1-$2-$3")
    t = F.regexp_replace(t, r"^(\d{4}-\d{2}-\d{2})[^0-9](?=\d)", "$1T")
    t = F.regexp_replace(t, r"T(\d{2})(\d{2})(\d{2})(?=$|[.,+\-Zz])", "T$1:$2:$3")
    t = F.regexp_replace(t, r"T(\d{2})(\d{2})(?=$|[+\-Zz])", "T$1:$2")
    t = F.regexp_replace(t, r"(T\d{2}:\d{2}:\d{2}),(\d)", "$1.$2")      # decimal comma
    # HH or HH:MM directly followed by a zone needs minutes and seconds for the parser
    t = F.regexp_replace(t, r"T(\d{2})(?=[+\-Zz])", "T$1:00:00")
    return F.regexp_replace(t, r"T(\d{2}):(\d{2})(?=[+\-Zz])", "T$1:$2:00")


def parse_iso_timestamp(text: Column) -> Column:
    """RFC 3339 / ISO text -> UTC wall-clock ``timestamp_ntz``; empty or invalid -> null.

    Accepts the forms of Python's ``datetime.fromisoformat`` (week and compact
    dates and times included, see ``_iso_extended``). Text with ``Z`` or an
    offset is converted to UTC; text without one is taken as UTC already (how
    the reference's database stores naive times). The result does not depend
    on the session time zone. ``try_to_timestamp`` alone also accepts a bare
    time of day (it means "today"), which the reference rejects, so a date
    prefix is required.
    """
    t = _iso_extended(F.trim(text))
    parsed = F.try_to_timestamp(t)
    zoned = t.rlike(ISO_ZONE_SUFFIX)
    wall = F.when(zoned, utc_wall_clock(parsed)).otherwise(parsed.cast("timestamp_ntz"))
    return F.when(t.rlike(ISO_DATE_PREFIX), wall)


def utc_wall_clock(ts: Column) -> Column:
    """An instant (``timestamp``) as its UTC wall-clock time (``timestamp_ntz``), whatever
    the session time zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def month_key(ts: Column) -> Column:
    """First day of the month of ``ts`` (date): the partition value of a month-partitioned table."""
    return F.trunc(F.to_date(ts), "month")


def time_range(df: DataFrame, ts_col: str, lo: Column | None, hi: Column | None,
               month_col: str | None = None) -> DataFrame:
    """Half-open ``[lo, hi)`` on ``ts_col``; with a month partition column also on it.

    The second predicate is implied by the first, but only it lets Parquet
    partition pruning skip whole months (a filter on ``ts`` alone prunes nothing).
    """
    ts = F.col(ts_col)
    if lo is not None:
        df = df.filter(ts >= lo)
        if month_col:
            df = df.filter(F.col(month_col) >= month_key(lo))
    if hi is not None:
        df = df.filter(ts < hi)
        if month_col:
            df = df.filter(F.col(month_col) <= month_key(hi))
    return df
