"""Service-day clock: departure texts such as ``530a``, ``1215p`` or ``130x`` (after midnight)."""

from pyspark.sql import functions as F

from ..fixed_values import DEPARTURE_PATTERN


def with_split_departure(df):
    """Add ``time`` and ``meridian``; both null where ``departure`` is not digits + lower case.

    One regular expression per row: it gives the time, and where there is one, the meridian is
    what remains behind the digits.
    """
    digits = F.nullif(F.regexp_extract("departure", DEPARTURE_PATTERN, 1), F.lit(""))
    return df.withColumn("time", digits.try_cast("double")).withColumn(
        "meridian", F.when(F.col("time").isNotNull(), F.ltrim("departure", F.lit("0123456789")))
    )


def dep_time_24h(time, meridian, strict_midnight=False):
    """Sortable *hhmm* number that runs past 2400 for departures after midnight.

    By default 1200x stays 1200 and 12xxa stays 12xx, as printed timetables have always been
    sorted; ``strict_midnight`` moves them to 2400 and 00xx.
    """
    afternoon = (meridian == "p") & (time < 1200)
    past_midnight = (meridian == "x") & (time > 1200)
    small_hours = (meridian == "x") & (time < 1200)
    if strict_midnight:
        past_midnight = (meridian == "x") & (time >= 1200)
        first_hour = (meridian == "a") & (time >= 1200)
        return F.when(first_hour, time - 1200).otherwise(
            time + F.when(afternoon | past_midnight, 1200).when(small_hours, 2400).otherwise(0)
        )
    return time + F.when(afternoon | past_midnight, 1200).when(small_hours, 2400).otherwise(0)


def display_time(departure):
    """Departure as printed: the first ``x`` reads ``a``; unreadable texts are printed as they are."""
    first = F.instr(departure, "x")
    return F.when(first > 0, F.overlay(departure, F.lit("a"), first, F.lit(1))).otherwise(departure)
