"""The base table: every timed stop of every trip that the stop-order sheet lists."""

from pyspark.sql import functions as F

from ..fixed_values import NO_EVENT
from ..functions import dep_time_24h, display_time, paste, to_number, with_split_departure
from ..operators import attach_stop_order, clean_trip_stops, fill_placeholder
from ..schemas import BASE, STOP_KEY
from ..sources import Staging


def with_clock(trip_stops, strict_midnight=False):
    """Add ``time``, ``meridian`` and the sortable ``dep_time_24h``."""
    clock = dep_time_24h(F.col("time"), F.col("meridian"), strict_midnight)
    return with_split_departure(trip_stops).withColumn("dep_time_24h", clock)


def with_display(trip_stops):
    """Add the printed departure."""
    return trip_stops.withColumn("departure_save", display_time(F.col("departure")))


def label_stops(df):
    return df.withColumn("stop_info", paste("stop_name", "stop"))


def label_trips(df):
    return df.withColumn("trp_op_day", paste("trp_number_trim", "op_day"))


def numeric_sheet(stop_order, staging):
    """The stop-order sheet with numbers, without copies.

    Base rows are distinct in the end; copies in the sheet would only multiply rows in the join.
    Staged, the sheet is read and made distinct once, then measured and joined.
    """
    return staging.table(stop_order.select(*STOP_KEY, to_number(F.col("stop_order")).alias("stop_order")).distinct(), "sheet")


def _timed_stops(trip_stops, stop_order, strict_midnight, staging):
    timed = with_display(with_clock(clean_trip_stops(trip_stops), strict_midnight))
    sheet = numeric_sheet(stop_order, staging or Staging(trip_stops.sparkSession))
    return fill_placeholder(attach_stop_order(timed, sheet), NO_EVENT, ["evt_sta"])


def base_rows(trip_stops, stop_order, strict_midnight=False, staging=None):
    """Base rows, repeated where trip stops repeat. Trip stops are not shuffled while the sheet is small."""
    timed = _timed_stops(trip_stops, stop_order, strict_midnight, staging)
    return label_trips(label_stops(timed)).select(*BASE)


def timetable_base(trip_stops, stop_order, strict_midnight=False, staging=None):
    """Distinct base rows. The two labels follow from other columns, so they are made afterwards."""
    labels = {"trp_op_day", "stop_info"}
    timed = _timed_stops(trip_stops, stop_order, strict_midnight, staging)
    distinct = timed.select(*[c for c in BASE if c not in labels]).distinct()
    return label_trips(label_stops(distinct)).select(*BASE)
