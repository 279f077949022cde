"""Timestamps, week labels and period starts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_DAY_FIRST = (
    "d/M/yyyy HH:mm:ss", "d/M/yyyy HH:mm", "d/M/yyyy", "d-M-yyyy", "d.M.yyyy",
    "d MMMM yyyy HH:mm", "d MMMM yyyy", "d MMM yyyy HH:mm", "d MMM yyyy",
    "MMMM d, yyyy HH:mm", "MMMM d, yyyy", "MMM d, yyyy",
)
_PERIOD_FORMAT = {"day": "yyyy-MM-dd", "week": "yyyy-MM-dd", "month": "yyyy-MM"}


def ts_from_epoch(col: Column) -> Column:
    return F.timestamp_seconds(col.try_cast("double"))


def ts_from_iso(col: Column) -> Column:
    return col.try_cast("timestamp")


def ts_dayfirst(col: Column) -> Column:
    """Day-first text; ISO text is still read as ISO."""
    text = F.trim(col)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in _DAY_FIRST], ts_from_iso(text))


def coalesce_ts(iso: Column, fallback: Column | None = None) -> Column:
    first = ts_from_iso(iso)
    return first if fallback is None else F.coalesce(first, ts_dayfirst(fallback))


def week_label(ts: Column, undated: str | None = None) -> Column:
    """``Monday/Sunday`` of the week; a null date gives ``undated`` (null by default)."""
    monday = F.date_trunc("week", ts).cast("date")
    text = F.concat(monday.cast("string"), F.lit("/"), F.date_add(monday, 6).cast("string"))
    return text if undated is None else F.coalesce(text, F.lit(undated))


def day_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def period_start(ts: Column, grain: str) -> Column:
    return F.date_trunc(grain, ts)


def period_label(ts: Column, grain: str) -> Column:
    return F.date_format(F.date_trunc(grain, ts), _PERIOD_FORMAT[grain])
