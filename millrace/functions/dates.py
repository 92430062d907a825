"""Dates, time zones and the banking calendar as column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Business zone, wire formats and the fixed-date closing days of the calendar.
BUSINESS_ZONE = "Europe/Vilnius"
WIRE_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ssX"
WIRE_DATE = "yyyy-MM-dd"
WIRE_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
CLOSING_DAYS = ["01-01", "05-01", "12-25", "12-26"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_date(ts: Column | str, zone: str = BUSINESS_ZONE, ntz_utc: bool = False) -> Column:
    """Business date of an instant. `ntz_utc`: the column is TIMESTAMP_NTZ holding UTC.

    convert_timezone names both zones, so the result does not depend on the session zone.
    """
    source = F.lit("UTC") if ntz_utc else F.current_timezone()
    return F.to_date(F.convert_timezone(source, F.lit(zone), _col(ts)))


def day_end(day: Column | str, zone: str = BUSINESS_ZONE) -> Column:
    """The last microsecond of a local day as an instant, whatever the session zone."""
    following = F.date_add(_col(day), 1).cast("timestamp_ntz")
    return (F.convert_timezone(F.lit(zone), F.current_timezone(), following).cast("timestamp")
            - F.expr("INTERVAL '0.000001' SECOND"))


def parse_timestamp(text: Column | str, fmt: str = WIRE_TIMESTAMP) -> Column:
    """NULL where the text does not follow the wire format."""
    return F.try_to_timestamp(_col(text), F.lit(fmt))


def parse_date(text: Column | str, fmt: str = WIRE_DATE) -> Column:
    text = _col(text)
    parsed = F.try_to_date(text, fmt)
    return F.when(text.rlike(WIRE_DATE_PATTERN), parsed) if fmt == WIRE_DATE else parsed


def parse_date_or_instant(text: Column | str, zone: str = BUSINESS_ZONE) -> Column:
    """A plain date, or the UTC instant of local midnight, as the same local date."""
    return F.coalesce(parse_date(text), local_date(parse_timestamp(text), zone))


def date_format_kind(text: Column | str) -> Column:
    """'date' | 'utc_instant' | 'invalid' | NULL: flags which contract a date text follows."""
    text = _col(text)
    return (F.when(text.isNull(), F.lit(None).cast("string"))
            .when(parse_date(text).isNotNull(), F.lit("date"))
            .when(parse_timestamp(text).isNotNull(), F.lit("utc_instant"))
            .otherwise(F.lit("invalid")))


def is_business_day(day: Column | str) -> Column:
    day = _col(day)
    return (F.weekday(day) < 5) & ~F.date_format(day, "MM-dd").isin(CLOSING_DAYS)


def date_key(day: Column | str) -> Column:
    """yyyymmdd as INT."""
    day = _col(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_text(day: Column | str) -> Column:
    return F.date_format(_col(day), "yyyy-MM")


def month_key(day: Column | str) -> Column:
    day = _col(day)
    return (F.year(day) * 100 + F.month(day)).cast("int")


def report_month(day: Column | str) -> Column:
    """The month a report delivered on `day` is about: the one before."""
    return F.date_format(F.add_months(F.trunc(_col(day), "MM"), -1), "yyyy-MM")


def days_late(paid: Column | str, due: Column | str) -> Column:
    """Negative when paid early."""
    return F.datediff(_col(paid), _col(due))


# Fixed value: room for 9,999,999 changes per feed and day in a change sequence.
SEQUENCE_DAY_FACTOR = 10_000_000


def change_sequence(day: Column | str, n: Column | str) -> Column:
    return date_key(day).cast("bigint") * F.lit(SEQUENCE_DAY_FACTOR).cast("bigint") + _col(n).cast("bigint")


def sequence_day(seq: Column | str) -> Column:
    """The date a change sequence carries in its leading digits; NULL if they are no date."""
    digits = (F.floor(_col(seq) / F.lit(SEQUENCE_DAY_FACTOR)).cast("bigint")).cast("string")
    return F.try_to_date(digits, "yyyyMMdd")
