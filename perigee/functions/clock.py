"""Spacecraft time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_SECONDS = 946_684_800  # 2000-01-01T00:00:00Z

# Days (UTC) from which one more leap second counts after the epoch.
LEAP_DAYS = ("2006-01-01", "2009-01-01", "2012-07-01", "2015-07-01", "2017-01-01")


def combine_time(coarse: Column, fine: Column) -> Column:
    """Seconds since the epoch of whole seconds and milliseconds.

    Null if the seconds are negative or not finite, or the milliseconds are no whole number from 0 to 999.
    """
    coarse, fine = coarse.cast("double"), fine.cast("double")
    finite = ~F.isnan(coarse) & (F.abs(coarse) < float("inf"))
    return F.when(finite & (coarse >= 0) & (fine >= 0) & (fine <= 999) & (fine == F.floor(fine)), coarse + fine / 1000)


def leap_seconds(seconds: Column) -> Column:
    """Leap seconds to add to spacecraft seconds: the k-th day counts if it is reached with the k - 1 before it."""
    count = F.lit(0)
    for k, day in enumerate(LEAP_DAYS):
        reached = F.lit(EPOCH_SECONDS) + seconds + k >= F.unix_timestamp(F.lit(day), "yyyy-MM-dd")
        count = count + reached.cast("int")
    return count


def spacecraft_seconds(utc: Column) -> Column:
    """Spacecraft seconds of UTC seconds since 1970, the inverse of adding leap_seconds."""
    count = F.lit(0)
    for day in LEAP_DAYS:
        count = count + (utc >= F.unix_timestamp(F.lit(day), "yyyy-MM-dd")).cast("int")
    return utc - F.lit(EPOCH_SECONDS) - count


def utc_text(seconds: Column, with_leap_seconds: bool = True) -> Column:
    """ISO text of spacecraft seconds in UTC, with milliseconds only where there are any."""
    shifted = seconds + (leap_seconds(seconds) if with_leap_seconds else F.lit(0))
    micros = F.round(shifted * 1_000_000).cast("long") + F.lit(EPOCH_SECONDS * 1_000_000)
    moment = F.timestamp_micros(micros)
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    part = F.date_format(moment, ".SSS")
    return F.concat(whole, F.when(micros % 1_000_000 != 0, part).otherwise(F.lit("")), F.lit("Z"))


def packet_time(secondary_present: Column, secondary: Column, named: list[tuple[str, Column]], received: Column) -> Column:
    """STRUCT(seconds, source): a packet's time and where it comes from.

    A secondary header counts first, and gives NaN if it is there but not valid; then the first named field that has
    a value; then the time of receipt.
    """
    choice = F.when(secondary_present, F.struct(F.coalesce(secondary, F.lit(float("nan"))).alias("seconds"), F.lit("ccsds_secondary_header").alias("source")))
    for name, value in named:
        choice = choice.when(value.isNotNull(), F.struct(value.cast("double").alias("seconds"), F.lit(name).alias("source")))
    return choice.otherwise(F.struct(received.cast("double").alias("seconds"), F.lit("received_wall_time").alias("source")))


def merge_key(apid: Column, packet_bytes: Column, secondary_flag: Column, coarse: Column, fine: Column, row_apid: int = 536) -> Column:
    """STRUCT(coarse, fine) to merge by; null for rows of images, short packets and those without a secondary header."""
    timed = (apid != row_apid) & (packet_bytes >= 12) & (secondary_flag == 1) & (fine <= 999)
    return F.when(timed, F.struct(coarse.alias("coarse"), fine.alias("fine")))
