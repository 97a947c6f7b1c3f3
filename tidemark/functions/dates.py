"""Explicit parsers for the date dialects the feeds use.

Every one returns NULL on text it cannot read. Sorting the raw text would be wrong
for most of these formats, so operators parse first and sort dates.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalar import col

# The format of each feed.
DAY_MON_YEAR = "d-MMM-yyyy"
DAY_MON_YEAR_TIME = "d-MMM-yyyy HH:mm:ss"
DAYMONYEAR = "ddMMMyyyy"
US_SLASHED = "M/d/yyyy"
UK_SLASHED = "d/M/yyyy"
MONTH_DAY_YEAR = "MMM d, yyyy"
DAY_MONTH_YEAR = "d-M-yyyy"
COMPACT = "yyyyMMdd"


def parse(c: str | Column, fmt: str) -> Column:
    """Date in ``fmt``; month names may be in any case."""
    return F.try_to_date(F.trim(col(c)), fmt)


def parse_time(c: str | Column, fmt: str = DAY_MON_YEAR_TIME) -> Column:
    return F.try_to_timestamp(F.trim(col(c)), F.lit(fmt))


def epoch_ms(c: str | Column) -> Column:
    return F.timestamp_millis(col(c).try_cast("bigint"))


def ist_date(ms: str | Column) -> Column:
    """Calendar date in India of an epoch-millisecond instant."""
    return F.to_date(F.from_utc_timestamp(epoch_ms(ms), "Asia/Kolkata"))


def iso_or_epoch(c: str | Column) -> Column:
    """A field that carries epoch milliseconds or ISO text, as a date."""
    text = col(c).cast("string")
    return F.when(text.rlike(r"^-?\d+(\.0*)?$"), F.to_date(F.timestamp_millis(text.try_cast("double").cast("bigint")))) \
        .otherwise(F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"))


def days_since_1900_end(c: str | Column) -> Column:
    """Day counts that start at 1900-12-31."""
    return F.date_add(F.to_date(F.lit("1900-12-31")), col(c).cast("int"))


def as_date(value: str | date | None, name: str = "as_of") -> date | None:
    """Validate an ISO date argument; anything else raises."""
    if value is None:
        return None
    if isinstance(value, date) and not hasattr(value, "hour"):
        return value
    if isinstance(value, str):
        try:
            return date.fromisoformat(value)
        except ValueError:
            pass
    raise ValueError(f"{name} must be an ISO date like 2026-08-31, got {value!r}")


# -- calendar helpers -------------------------------------------------------------

def previous_quarter(c: str | Column) -> Column:
    """struct(year, quarter) of the quarter before the one holding the date."""
    back = F.add_months(col(c), -3)
    return F.struct(F.year(back).alias("year"), F.quarter(back).alias("quarter"))


def completed_frame(c: str | Column) -> Column:
    """Frame label such as CY2025Q2, two quarters behind the date."""
    back = F.add_months(col(c), -6)
    return F.concat(F.lit("CY"), F.year(back).cast("string"), F.lit("Q"), F.quarter(back).cast("string"))


def fiscal_start_year(c: str | Column) -> Column:
    d = col(c)
    return F.when(F.month(d) >= 4, F.year(d)).otherwise(F.year(d) - 1)


def fiscal_year_label(c: str | Column) -> Column:
    """FYyy-yy of an April-to-March year."""
    y = fiscal_start_year(c)
    return F.concat(F.lit("FY"), F.substring(y.cast("string"), 3, 10), F.lit("-"),
                    F.substring((y + 1).cast("string"), 3, 10))


def fiscal_quarter_label(c: str | Column) -> Column:
    """Qn FYyy-yy, with April to June as Q1."""
    q = F.floor(F.pmod(F.month(col(c)) - 4, F.lit(12)) / 3).cast("int") + 1
    return F.concat(F.lit("Q"), q.cast("string"), F.lit(" "), fiscal_year_label(c))
