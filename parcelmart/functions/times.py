"""Time expressions: epoch milliseconds in, IST text, dates and day counts out.

All of them expect ``spark.sql.session.timeZone=UTC`` (see :mod:`parcelmart.session`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IST_MS = 19_800_000
DAY_MS = 86_400_000

# Output formats (fixed values).
ISO_TIME = "yyyy-MM-dd HH:mm:ss"
ISO_DAY = "yyyy-MM-dd"
DAY_TIME = "dd-MM-yyyy HH:mm:ss"
DAY = "dd-MM-yyyy"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ms_of(c: Column | str) -> Column:
    """Epoch milliseconds held as text (also ``1.6E12``); NULL when it is not a number."""
    return _col(c).try_cast("double").try_cast("bigint")


def ist_ms(c: Column | str) -> Column:
    return _col(c) + F.lit(IST_MS)


def ist_format(c: Column | str, fmt: str = ISO_TIME) -> Column:
    """Epoch milliseconds as IST text."""
    return F.from_unixtime((ist_ms(c) / 1000).cast("bigint"), fmt)


def ist_format_s(c: Column | str, fmt: str = DAY_TIME) -> Column:
    """Epoch seconds as IST text."""
    return F.from_unixtime(_col(c) + F.lit(IST_MS // 1000), fmt)


def ist_date(c: Column | str) -> Column:
    """IST calendar day of epoch milliseconds, as DATE."""
    return F.to_date(F.timestamp_millis(ist_ms(c)))


def ist_midnight(c: Column | str) -> Column:
    """Start of the IST day, on the IST-shifted millisecond scale."""
    shifted = ist_ms(c)
    return shifted - F.pmod(shifted, F.lit(DAY_MS))


def ntz_ms(c: Column | str) -> Column:
    """Epoch milliseconds of a timestamp without time zone, read as UTC."""
    return F.unix_millis(_col(c).cast("timestamp"))


def parse_time(c: Column | str, fmt: str) -> Column:
    """Text to TIMESTAMP; NULL when it does not parse."""
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def parse_seconds(c: Column | str, fmt: str) -> Column:
    return F.unix_timestamp(parse_time(c, fmt))


def days_ms(days: Column | str) -> Column:
    """A number of days in milliseconds."""
    return _col(days).cast("bigint") * F.lit(DAY_MS)


def days_between(end_ms: Column | str, start_ms: Column | str) -> Column:
    """Elapsed time in days, with fraction."""
    return (_col(end_ms) - _col(start_ms)) / F.lit(DAY_MS)


def whole_days(end_ms: Column | str, start_ms: Column | str) -> Column:
    """Elapsed time rounded half up to days."""
    return F.round(days_between(end_ms, start_ms), 0)


def floor_zero(c: Column) -> Column:
    """Negative values become 0 and NULL stays NULL (``greatest`` would turn NULL into 0)."""
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def month_day_label(c: Column | str) -> Column:
    """``MM/ dd`` label of a date."""
    part = lambda value: F.lpad(value.cast("string"), 2, "0")
    return F.concat(part(F.month(_col(c))), F.lit("/ "), part(F.dayofmonth(_col(c))))
