"""What a timetable silently leaves out or cannot read, as tables."""

from pyspark.sql import functions as F

from ..fixed_values import DIRECTIONS, ROUTE_GROUPS
from ..operators import clean_trip_stops, natural_left_join
from ..schemas import STOP_KEY
from .base import with_clock


def unparsed_departures(trip_stops):
    """Departure texts without a readable time, and how many rows have them."""
    timed = with_clock(clean_trip_stops(trip_stops))
    unread = timed.filter(F.col("departure").isNotNull() & F.col("time").isNull())
    return unread.groupBy("route", "direction", "departure").agg(F.count(F.lit(1)).alias("row_count"))


def coverage_gaps(trip_stops, stop_order, groups=ROUTE_GROUPS, directions=DIRECTIONS):
    """Stops whose rows reach no grid, with the reasons; rows without a route are among them.

    Rows are counted per stop first, so only a small table meets the stop-order sheet.
    """
    routes = sorted({route for members in groups.values() for route in members})
    counted = trip_stops.groupBy(*STOP_KEY).agg(F.count(F.lit(1)).alias("row_count"))
    listed = stop_order.select(*STOP_KEY).distinct().withColumn("listed", F.lit(True))
    checked = natural_left_join(counted, listed).select(
        *STOP_KEY, "row_count",
        F.col("listed").isNull().alias("not_in_stop_order"),
        (~F.coalesce(F.col("route").isin(routes), F.lit(False))).alias("route_not_grouped"),
        (~F.coalesce(F.col("direction").isin(list(directions)), F.lit(False))).alias("direction_not_printed"),
    )
    return checked.filter("not_in_stop_order or route_not_grouped or direction_not_printed")
