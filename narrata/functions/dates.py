"""Tolerant date parsing and calendar periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date spellings, tried in this order.
DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]",
    "MM/dd/yyyy",
    "M/d/yyyy",
    "yyyy/MM/dd",
    "MMMM d, yyyy",
    "MMM d, yyyy",
    "d MMM yyyy",
    "yyyyMMdd",
)


def parse_date(value: Column, formats=DATE_FORMATS) -> Column:
    """The date, or null where no format fits."""
    text = F.trim(value)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]).cast("date")


def day_number(date: Column) -> Column:
    return F.unix_date(date)


def month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def quarter(date: Column) -> Column:
    return F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string"))
