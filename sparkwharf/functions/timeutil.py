"""Civil days, epochs, buckets and source time formats as column expressions.

Days are civil days of a fixed offset (eight hours ahead of UTC by default), half open.
Times may be TIMESTAMP_NTZ (taken as UTC) or TIMESTAMP; no expression depends on the session's time zone for NTZ input.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFSET_HOURS = 8
ROC_EPOCH = 1911


def shifted(ts: Column, hours: float) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(hours * 60)))


def local_time(ts: Column, offset_hours: float = OFFSET_HOURS) -> Column:
    """The civil time, offset hours ahead."""
    return shifted(ts, offset_hours)


def local_date(ts: Column, offset_hours: float = OFFSET_HOURS) -> Column:
    return F.to_date(local_time(ts, offset_hours))


def day_bounds(day: date | str, offset_hours: float = OFFSET_HOURS, widen_hours: float = 0) -> tuple[datetime, datetime]:
    """UTC bounds [start, end) of a civil day, widened on both sides."""
    start = datetime.fromisoformat(str(day)) - timedelta(hours=offset_hours)
    return start - timedelta(hours=widen_hours), start + timedelta(days=1, hours=widen_hours)


def in_local_day(ts: Column, day: date | str, offset_hours: float = OFFSET_HOURS, widen_hours: float = 0) -> Column:
    """Constant bounds on the bare column, so that the scan prunes by them."""
    low, high = (F.lit(x.isoformat(sep=" ")).cast("timestamp_ntz") for x in day_bounds(day, offset_hours, widen_hours))
    return (ts >= low) & (ts < high)


def refresh_days(as_of: datetime, offset_hours: float = OFFSET_HOURS) -> list[date]:
    """Yesterday and today in civil time: both are always rebuilt, for late rows."""
    today = (as_of + timedelta(hours=offset_hours)).date()
    return [today - timedelta(days=1), today]


def epoch_micros(ts_ntz: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts_ntz)


def epoch_seconds(ts_ntz: Column) -> Column:
    """Seconds since 1970, rounded half up as a database cast does, not cut off."""
    return F.floor((epoch_micros(ts_ntz) + 500_000) / F.lit(1_000_000.0)).cast("long")


def floor_minutes(ts: Column, minutes: int) -> Column:
    """The start of the bucket of whole ``minutes`` since the hour."""
    hour = F.date_trunc("hour", ts)
    return hour + F.make_dt_interval(F.lit(0), F.lit(0), (F.floor(F.minute(ts) / minutes) * minutes).cast("int"))


def time_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm")


def thinned(ts_ntz: Column, step_minutes: int | None) -> Column:
    """Keeps minutes divisible by the step; all without a step."""
    return F.lit(True) if step_minutes is None else F.floor(epoch_seconds(ts_ntz) / 60) % step_minutes == 0


def first_parsed(text: Column, formats: list[str]) -> Column:
    """The first format that fits; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def roc_date(text: Column) -> Column:
    """Dates of the Minguo calendar: ``113.05.02``, ``1130502`` or ``113/5/2``; null if none."""
    parts = F.split(F.regexp_replace(F.trim(text), "[./年月]", "-"), "-")
    split = F.when(F.size(parts) >= 3, F.struct(*[F.get(parts, F.lit(i)).try_cast("int").alias(n) for i, n in enumerate("ymd")]))
    packed = F.when(
        F.trim(text).rlike("^[0-9]{6,7}$"),
        F.struct(
            F.regexp_extract(F.trim(text), "^([0-9]{2,3})[0-9]{4}$", 1).try_cast("int").alias("y"),
            F.regexp_extract(F.trim(text), "^[0-9]{2,3}([0-9]{2})[0-9]{2}$", 1).try_cast("int").alias("m"),
            F.regexp_extract(F.trim(text), "^[0-9]{2,3}[0-9]{2}([0-9]{2})$", 1).try_cast("int").alias("d"),
        ),
    )
    p = F.coalesce(split, packed)
    return F.to_date(F.try_to_timestamp(F.format_string("%04d-%02d-%02d", p["y"] + ROC_EPOCH, p["m"], p["d"]), F.lit("yyyy-MM-dd")))


def roc_year_month(text: Column) -> Column:
    """The date of Minguo years: first of the month for three digits of the year and two of the month, or four and two; the day for three, two and two."""
    t = F.trim(text)
    n = F.when(t.rlike("^[0-9]+$"), F.length(t))
    wide = F.when(n == 6, 4).otherwise(3)
    part = lambda at, size: F.try_to_number(F.substr(t, at, F.lit(size) if isinstance(size, int) else size), F.lit("9999")).cast("int")
    day = F.when(n == 7, part(F.lit(6), 2)).otherwise(F.lit(1))
    whole = F.format_string("%04d-%02d-%02d", part(F.lit(1), wide) + ROC_EPOCH, part(wide + 1, 2), day)
    return F.when(n.isin(5, 6, 7), whole.try_cast("date"))


def clock_seconds(text: Column, after: Column | None = None) -> Column:
    """Seconds of ``HH:mm[:ss]``; a day later if before ``after`` seconds."""
    p = F.split(text, ":")
    s = F.get(p, F.lit(0)).try_cast("int") * 3600 + F.get(p, F.lit(1)).try_cast("int") * 60 + F.coalesce(F.get(p, F.lit(2)).try_cast("int"), F.lit(0))
    return s if after is None else F.when(s < after, s + 86400).otherwise(s)


def period_end(start: Column, month: Column, day: Column) -> Column:
    """The end of a period named by month and day only: next year's if it would lie before the start."""
    same = F.make_date(F.year(start), month, day)
    return F.when(same < start, F.make_date(F.year(start) + 1, month, day)).otherwise(same)


def day_hour_minute(group: Column, reference: Column) -> Column:
    """``ddHHmmZ`` in the month of ``reference``, or the month before if that lies over 20 days ahead or has no such day."""
    part = lambda i: F.regexp_extract(group, "^([0-9]{2})([0-9]{2})([0-9]{2})Z?$", i).try_cast("int")
    at = lambda month: F.try_to_timestamp(
        F.concat(F.date_format(month, "yyyy-MM"), F.format_string("-%02d %02d:%02d", part(1), part(2), part(3))), F.lit("yyyy-MM-dd HH:mm")
    )
    this, last = at(reference), at(F.add_months(reference, -1))
    return F.when(this.isNull() | (this > reference.cast("timestamp") + F.expr("INTERVAL 20 DAYS")), last).otherwise(this)


def model_cycle(as_of: Column, lag_hours: int = 4, every_hours: int = 6) -> Column:
    """The latest model run that is out: back by the lag, then down to the cycle."""
    late = shifted(as_of, -lag_hours)
    return F.date_trunc("day", late) + F.make_dt_interval(F.lit(0), (F.floor(F.hour(late) / every_hours) * every_hours).cast("int"))
