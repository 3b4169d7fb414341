"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDER_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
_ISO_SHAPE = r"^\d{4}-\d\d-\d\d([ T]\d\d:\d\d:\d\d(\.\d{1,9})?)?$"

# Month abbreviations of the calendar table.
MONTH_ABBREVIATIONS = {
    1: "Jan", 2: "Feb", 3: "Mar", 4: "Apr", 5: "Mei", 6: "Jun",
    7: "Jul", 8: "Agt", 9: "Sep", 10: "Okt", 11: "Nov", 12: "Des",
}

# National holidays of 2024.
HOLIDAYS_2024 = (
    "2024-01-01", "2024-02-08", "2024-02-09", "2024-02-10", "2024-03-11", "2024-03-29", "2024-04-10",
    "2024-04-11", "2024-04-12", "2024-05-01", "2024-05-09", "2024-05-23", "2024-06-01", "2024-06-17",
    "2024-06-18", "2024-08-17", "2024-09-16", "2024-12-25", "2024-12-26",
)

# Display order of the weekday axis.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def parse_timestamp(col: Column, fmt: str = ORDER_TIME_FORMAT) -> Column:
    """A date or time, or its text, as a zone-less timestamp; what cannot be read is null.

    The default reads timestamps of either kind as they are, and ISO text: a date, with or without a time behind a space or T, with or
    without a fraction. Other formats are read in the session time zone, which should be UTC so that no wall-clock time
    falls into a daylight-saving gap.
    """
    if fmt == ORDER_TIME_FORMAT:
        return F.when(col.cast("string").rlike(_ISO_SHAPE), col.try_cast("timestamp_ntz"))
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")


def date_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd").cast("int")


def date_from_id(col: Column) -> Column:
    return F.to_date(col.cast("string"), "yyyyMMdd")


def iso_weekday(ts: Column) -> Column:
    return F.weekday(ts) + 1


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def month_name(ts: Column) -> Column:
    return F.date_format(ts, "MMMM")


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def weekday_rank(name: Column) -> Column:
    """Position of a day name on the Monday-to-Sunday axis."""
    return F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), name).cast("int")


def hour_floor(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def hour_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHH")


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(60_000_000.0)


def day_type(weekend_flag: Column) -> Column:
    return F.when(weekend_flag == 1, "Weekend").when(weekend_flag == 0, "Weekday")


def hour_label(hour: Column) -> Column:
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def month_abbreviation(ts: Column) -> Column:
    names = F.array(*[F.lit(MONTH_ABBREVIATIONS[m]) for m in range(1, 13)])
    return F.element_at(names, F.month(ts))
