"""Date column functions: part extraction, invalid-date cleanup, relative ranges."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date parts a document carries and the names queries use.
DATE_PARTS = ["year", "month", "week", "dayofyear", "day", "dayofweek",
              "dayofweek_iso", "hour", "minute", "second", "m"]

# Accepted textual date formats (ISO family only).
DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm",
                "yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd"]


def part(col: Column, name: str) -> Column:
    """One date part with the document conventions.

    year, month, ISO week, 0-based day of year, day of month, 0=Sunday weekday,
    ISO weekday 1=Monday..7, hour, minute, second, yyyymm.
    """
    if name == "year":
        return F.year(col)
    if name in ("month", "monthnum"):
        return F.month(col)
    if name in ("week", "w"):
        return F.weekofyear(col)
    if name == "dayofyear":
        return F.dayofyear(col) - 1
    if name == "day":
        return F.dayofmonth(col)
    if name == "dayofweek":
        return F.dayofweek(col) - 1
    if name == "dayofweek_iso":
        return F.weekday(col) + 1
    if name == "hour":
        return F.hour(col)
    if name == "minute":
        return F.minute(col)
    if name == "second":
        return F.second(col)
    if name == "m":
        return F.year(col) * 100 + F.month(col)
    raise ValueError(f"unknown date part {name!r}")


def date_terms(col: Column) -> Column:
    """DOC-3: struct of all date parts of a timestamp column."""
    return F.struct(*[part(col, p).cast("int").alias(p) for p in DATE_PARTS])


def parse_datetime(col: Column) -> Column:
    """Parse a string in any accepted ISO format; NULL when none applies."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in DATE_FORMATS])


def clean_date(col: Column) -> Column:
    """DOC-2: unparsable or zero dates become NULL (timestamp_ntz)."""
    c = col.cast("string")
    zero = c.startswith("0000-00-00")
    ts = parse_datetime(c).cast("timestamp_ntz")
    return F.when(zero | c.isNull(), F.lit(None).cast("timestamp_ntz")).otherwise(ts)


def to_datetime_literal(value, end_of_period: bool = False) -> _dt.datetime:
    """Expand a partial date argument (year / year-month / date / datetime) to a datetime.

    ``end_of_period`` picks the last second of the period (used by inclusive
    ``before`` bounds on partial dates).
    """
    if isinstance(value, _dt.datetime):
        return value
    if isinstance(value, _dt.date):
        value = {"year": value.year, "month": value.month, "day": value.day}
    if isinstance(value, str):
        for fmt in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d", "%Y-%m", "%Y"):
            try:
                d = _dt.datetime.strptime(value, fmt)
            except ValueError:
                continue
            if fmt in ("%Y-%m-%d",) and end_of_period:
                return d.replace(hour=23, minute=59, second=59)
            if fmt == "%Y-%m":
                value = {"year": d.year, "month": d.month}
                break
            if fmt == "%Y":
                value = {"year": d.year}
                break
            return d
        else:
            raise ValueError(f"unparsable date {value!r}")
    y = int(value["year"])
    if end_of_period:
        m = int(value.get("month", 12))
        if "day" in value:
            d = int(value["day"])
        else:
            nxt = _dt.date(y + (m == 12), m % 12 + 1, 1)
            d = (nxt - _dt.timedelta(days=1)).day
        return _dt.datetime(y, m, d, int(value.get("hour", 23)), int(value.get("minute", 59)),
                            int(value.get("second", 59)))
    return _dt.datetime(y, int(value.get("month", 1)), int(value.get("day", 1)),
                        int(value.get("hour", 0)), int(value.get("minute", 0)), int(value.get("second", 0)))


def relative_range(kind: str, as_of: _dt.datetime, start=None, end=None) -> tuple[_dt.datetime, _dt.datetime]:
    """DATE-7: closed range for 'last-3-months', 'last-6-months', 'last-12-months' or 'custom'.

    Start is at 00:00:00 and end at 23:59:59; ``as_of`` replaces "now" so results
    are deterministic.
    """
    def add_months(d: _dt.datetime, n: int) -> _dt.datetime:
        y, m = divmod(d.month - 1 + n, 12)
        y += d.year
        m += 1
        last = (_dt.date(y + (m == 12), m % 12 + 1, 1) - _dt.timedelta(days=1)).day
        return d.replace(year=y, month=m, day=min(d.day, last))

    if kind == "custom":
        s = to_datetime_literal(start) if start else _dt.datetime(1970, 1, 1)
        e = to_datetime_literal(end) if end else as_of
    else:
        months = {"last-3-months": 3, "last-6-months": 6, "last-12-months": 12}[kind]
        s, e = add_months(as_of, -months), as_of
    return (s.replace(hour=0, minute=0, second=0, microsecond=0),
            e.replace(hour=23, minute=59, second=59, microsecond=0))
