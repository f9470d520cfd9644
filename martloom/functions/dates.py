"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted text layouts, tried in this order; the fraction of a second is optional. Fixed values.
TEXT_LAYOUTS = [
    (r"^\d{4}-\d{1,2}-\d{1,2} ", "yyyy-M-d H:mm:ss[.SSSSSS]"),
    (r"^\d{4}-\d{1,2}-\d{1,2}T", "yyyy-M-d'T'H:mm:ss[.SSSSSS]"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2} ", "yyyy/M/d H:mm:ss[.SSSSSS]"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2}/\d{1,2}/\d{4} ", "M/d/yyyy H:mm:ss[.SSSSSS]"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4} ", "d/M/yyyy H:mm:ss[.SSSSSS]"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
]
SERIAL_RANGE = (20000, 80000)  # spreadsheet day numbers taken as dates
SERIAL_EPOCH = 25569  # day number of 1970-01-01

WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def parse_mixed_ts(c: Column) -> Column:
    """Timestamp from a spreadsheet day number or the first text layout that fits; else null.

    The layout is chosen per row: 02/03/2024 is the second of March only where month-first fails.
    """
    raw = F.trim(c.cast("string"))
    serial = raw.try_cast("double")
    low, high = SERIAL_RANGE
    from_serial = F.when((serial > low) & (serial < high), F.timestamp_seconds((serial - SERIAL_EPOCH) * 86400))
    text = F.regexp_replace(raw, "Z$", "")
    # the shape test keeps failing parses, which raise inside the parser, off most rows
    tries = [F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(layout))) for shape, layout in TEXT_LAYOUTS]
    return F.coalesce(from_serial, *tries)


def parse_iso_date(c: Column) -> Column:
    """Date from the first ten characters of an ISO text; anything else is null."""
    head = F.substring(F.trim(c), 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.to_date(F.try_to_timestamp(head, F.lit("yyyy-MM-dd"))))


def parse_compact(c: Column) -> Column:
    """Date from `yyyymmdd…`."""
    head = F.substring(F.trim(c), 1, 8)
    return F.when(head.rlike(r"^\d{8}$"), F.to_date(F.try_to_timestamp(head, F.lit("yyyyMMdd"))))


def review_date(c: Column) -> Column:
    """Date of "Reviewed in <place> on <Month d, yyyy>"; a plain date text is parsed as it is."""
    said = F.when(c.rlike(r"Reviewed in .* on .+"), F.regexp_extract(c, r"Reviewed in .* on (.+)$", 1)).otherwise(c)
    long = F.when(said.rlike(r"^[A-Z][a-z]+ \d{1,2}, \d{4}$"), F.try_to_timestamp(said, F.lit("MMMM d, yyyy")))
    return F.to_date(F.coalesce(long, parse_mixed_ts(said)))


def month_to_date(c: Column) -> Column:
    """`YYYY-MM` becomes the first of the month; full dates stay."""
    return parse_iso_date(F.when(c.rlike(r"^\d{4}-\d{2}$"), F.concat(c, F.lit("-01"))).otherwise(c))


def date_parts(df: DataFrame, col: str, prefix: str = "order_") -> DataFrame:
    return df.withColumns(
        {
            f"{prefix}year": F.year(col),
            f"{prefix}month": F.month(col),
            f"{prefix}quarter": F.quarter(col),
            f"{prefix}day": F.dayofmonth(col),
            f"{prefix}weekday": F.date_format(col, "EEEE"),
        }
    )


def calendar_dummies(df: DataFrame, col: str) -> DataFrame:
    """month_1..month_12 and monday..sunday as 0/1 doubles, plus year and day."""
    months = {f"month_{m}": (F.month(col) == m).cast("double") for m in range(1, 13)}
    days = {name: (F.weekday(col) == i).cast("double") for i, name in enumerate(WEEKDAYS)}
    return df.withColumns({"year": F.year(col).cast("double"), "day": F.dayofmonth(col).cast("double"), **months, **days})


def month_index(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c)


def months_span(first: Column, last: Column) -> Column:
    """Months from first to last, both included."""
    return month_index(last) - month_index(first) + 1


def period_bounds(df: DataFrame, year: str, month: str) -> DataFrame:
    """First day, last day and length of the year (no month given) or of the month."""
    start = F.make_date(F.col(year), F.coalesce(F.col(month), F.lit(1)), F.lit(1))
    end = F.when(F.col(month).isNull(), F.make_date(F.col(year), F.lit(12), F.lit(31))).otherwise(F.last_day(start))
    return df.withColumns({"date_start": start, "date_end": end, "period_days": F.datediff(end, start) + 1})
