"""Dates and times.  Bad text gives null: one bad message must not stop a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelflow.vocabulary import DATE_FORMAT, RECORD_TIME_FORMAT


def parse_date(text: Column) -> Column:
    return F.try_to_date(text, DATE_FORMAT)


def format_date(value: Column) -> Column:
    return F.date_format(value, DATE_FORMAT)


def parse_record_time(text: Column) -> Column:
    """The record's own time.  It is UTC, whatever the session's zone is."""
    zoned = F.concat(text, F.lit(" +00:00"))
    return F.try_to_timestamp(zoned, F.lit(RECORD_TIME_FORMAT + " XXX"))


def format_record_time(value: Column) -> Column:
    return F.date_format(value, RECORD_TIME_FORMAT)


def days_on_market(listing_date: Column, as_of: Column) -> Column:
    """Whole days from the listing date (text) to ``as_of``."""
    return F.datediff(as_of, parse_date(listing_date))


def years_since(year: Column, as_of: Column) -> Column:
    """In a wider type, so that no year overflows it."""
    return F.year(as_of).cast("bigint") - year
