"""Time helpers. Timestamps are zone-free wall-clock values (TIMESTAMP_NTZ) throughout."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed value: batch folders are named YYYY-MM-DD_HHMMSS.
BATCH_ID_PATTERN = r"^(\d{4}-\d{2}-\d{2})_(\d{2})(\d{2})(\d{2})$"


def is_time_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType))


def stamp(as_of: datetime) -> Column:
    """A pinned clock reading as a column."""
    return F.expr(f"TIMESTAMP_NTZ'{as_of.isoformat(sep=' ')}'")


def day(as_of: datetime | date) -> Column:
    d = as_of.date() if isinstance(as_of, datetime) else as_of
    return F.lit(d)


def epoch_ns_to_ts(ns: Column) -> Column:
    """Epoch nanoseconds to a timestamp, floored to microseconds, without a session time zone."""
    whole_micros = (ns - F.pmod(ns, F.lit(1000))).cast("decimal(19,0)")
    seconds = (whole_micros * F.lit(Decimal("0.000000001"))).cast("decimal(18,6)")
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds
    )


def parse_batch_id(batch_id: Column) -> Column:
    """Batch folder name to its time; NULL for names of another form and for impossible dates."""
    text = F.regexp_replace(batch_id, BATCH_ID_PATTERN, "$1 $2:$3:$4")
    return F.when(batch_id.rlike(BATCH_ID_PATTERN), text.try_cast("timestamp_ntz"))


def day_diff(end: Column, start: Column) -> Column:
    """Calendar days from start to end."""
    return F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")


def hour_boundaries(start: Column, end: Column) -> Column:
    """Number of full-hour marks crossed from start to end (10:59 to 11:00 is one)."""
    return day_diff(end, start) * 24 + F.hour(end) - F.hour(start)


def first_whole_day(start: Column) -> Column:
    """First date whose midnight is not before ``start``."""
    d = F.to_date(start)
    return F.when(start > d.cast("timestamp_ntz"), F.date_add(d, 1)).otherwise(d)


def calendar_parts(d: Column) -> dict[str, Column]:
    """Calendar attributes of a date; weeks are ISO weeks, and Sunday is day 0."""
    parts = {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.day(d),
        "day_of_week": F.dayofweek(d) - 1,
        "day_of_year": F.dayofyear(d),
        "quarter": F.quarter(d),
        "week_of_year": F.weekofyear(d),
    }
    return {name: c.cast("bigint") for name, c in parts.items()}


# What the time column of an entity without a declared one is called.
DATE_SUFFIX, STAMP_SUFFIX, NO_DATE = "_DATE", "_ts", "generic_date_ts"


def first_date_field(df: DataFrame) -> Column:
    """The first column whose name ends in ``_DATE`` as a timestamp named ``<column>_ts``.

    Integer columns hold epoch nanoseconds. Without such a column: NULL as ``generic_date_ts``.
    """
    for field in df.schema.fields:
        if field.name.upper().endswith(DATE_SUFFIX):
            value = F.col(field.name)
            if isinstance(field.dataType, (T.LongType, T.IntegerType)):
                value = epoch_ns_to_ts(value.cast("bigint"))
            else:
                value = value.cast("timestamp_ntz")
            return value.alias(f"{field.name.lower()}{STAMP_SUFFIX}")
    return F.lit(None).cast("timestamp_ntz").alias(NO_DATE)
