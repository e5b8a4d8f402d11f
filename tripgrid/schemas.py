"""Column names of the two inputs and of the tables derived from them."""

from pyspark.sql import types as T

TRIP_STOPS = [
    "trp_number_trim", "route", "direction", "place", "stop", "stop_name",
    "op_day", "departure", "evt_sta",
]
STOP_ORDER = ["route", "direction", "stop", "stop_order"]
STOP_KEY = ["route", "direction", "stop"]

BASE = [
    "trp_op_day", "trp_number_trim", "route", "direction", "place", "stop_info", "stop",
    "op_day", "stop_name", "departure_save", "dep_time_24h", "stop_order", "evt_sta",
]

GRID = ["route_group", "direction"]
# What identifies one timetable row, and one cell of it. The most selective column leads, so that
# sort-based steps settle nearly every comparison on their first eight bytes.
TRIP = ["trp_op_day", "route", "evt_sta", *GRID]
CELL = ["trp_op_day", "stop_info", "route", "evt_sta", *GRID]
WIDE_IDS = ["trp_op_day", "route", "direction", "evt_sta"]

# Headers of the export and of the stop-order sheet, as the scheduling system writes them.
SOURCE_NAMES = {
    "Route": "route",
    "Direction": "direction",
    "Place": "place",
    "Stop": "stop",
    "Stop Name": "stop_name",
    "Op Day": "op_day",
    "Departure": "departure",
    "Evt, Sta": "evt_sta",
    "Stop Order": "stop_order",
}


def text_schema(columns):
    """Every input column is nullable text; types are assigned later, never inferred."""
    return T.StructType([T.StructField(name, T.StringType(), True) for name in columns])


def with_spark_names(df):
    """Rename the source headers to the names used here; other columns keep theirs."""
    return df.withColumnsRenamed(SOURCE_NAMES)
