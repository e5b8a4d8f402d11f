"""Every operator as a query over the given tables."""

from pyspark.sql import functions as F

from tripgrid.fixed_values import DIRECTIONS, EMPTY_CELL, NO_EVENT, ROUTE_GROUPS
from tripgrid.functions import dep_time_24h, to_number
from tripgrid.operators import (
    attach_stop_order, clean_trip_stops, fill_placeholder, filter_route_group, natural_left_join,
    pivot_grid, select_columns, stack, unpivot_grid,
)
from tripgrid.plans import (
    Timetable, coverage_gaps, label_stops, label_trips, route_groups, timetable_base,
    unparsed_departures, with_clock, with_display,
)
from tripgrid.schemas import BASE, GRID, STOP_KEY, TRIP_STOPS, WIDE_IDS
from tripgrid.sources import (
    Staging, scan_folder, scan_text_dir, write_csv, write_timetable, write_timetable_lines,
)

from .adapter import ALL_ROUTES, ROUTES, stop_order, trip_stops

# The grid that the one-grid operators (wide tables) are shown on: two merged routes.
GROUP, DIRECTION = "24", "East"


def _timetable(spark, sf_dir, routes=ROUTES, **options):
    return Timetable(trip_stops(spark, sf_dir, routes), stop_order(spark, sf_dir, routes), **options)


def _one_grid(spark, sf_dir):
    return _timetable(spark, sf_dir, groups={GROUP: ROUTE_GROUPS[GROUP]}, directions=[DIRECTION])


def _base(spark, sf_dir):
    return timetable_base(trip_stops(spark, sf_dir), stop_order(spark, sf_dir))


def _clean(spark, sf_dir):
    return clean_trip_stops(trip_stops(spark, sf_dir))


# Sources and sinks

def scan_text_dir_query(spark, sf_dir):
    """The export as text files and back, with quotes in the stop names."""
    folder = Staging(spark).path("export")
    export = trip_stops(spark, sf_dir).withColumn("stop_name", F.replace("stop_name", F.lit("St."), F.lit('"St."')))
    write_csv(export.select(*TRIP_STOPS), folder)
    return scan_text_dir(spark, folder, TRIP_STOPS).select(*TRIP_STOPS)


def scan_provenance(spark, sf_dir):
    """Rows of each file of the folder."""
    return scan_folder(spark, sf_dir, []).groupBy("id").agg(F.count(F.lit(1)).alias("row_count"))


def stack_files(spark, sf_dir):
    """One export per operating day and one of rows without a day, stacked."""
    export = trip_stops(spark, sf_dir).select(*TRIP_STOPS)
    days = ["Weekday", "Saturday", "Sunday"]
    other = ~F.coalesce(F.col("op_day").isin(days), F.lit(False))
    return stack({f"{day}.csv": export.filter(F.col("op_day") == day) for day in days} | {"other.csv": export.filter(other)})


def write_timetable_query(spark, sf_dir):
    """All grids written as partitioned Parquet and read back."""
    rows = _timetable(spark, sf_dir).rows
    folder = Staging(spark).path("timetable")
    write_timetable(rows, folder)
    return _printed(spark.read.schema(rows.schema).parquet(folder))


def write_timetable_csv(spark, sf_dir):
    """All grids written as CSV text, header line first, and read back."""
    folder = Staging(spark).path("timetable_csv")
    write_timetable_lines(_timetable(spark, sf_dir).lines, folder, in_order=True)
    return spark.read.schema("value string, route_group string, direction string").text(folder).select(
        *GRID, F.col("value").alias("line")
    )


def base_csv(spark, sf_dir):
    """The base table written as CSV and read back; blank cells come back null."""
    folder = Staging(spark).path("base_csv")
    write_csv(_base(spark, sf_dir).select(*BASE), folder)
    numbers = {"dep_time_24h", "stop_order"}
    back = scan_text_dir(spark, folder, BASE)
    return back.select(*[F.col(c).cast("double") if c in numbers else F.col(c) for c in BASE])


# Filters, projections and joins

def clean_trip_stops_query(spark, sf_dir):
    return _clean(spark, sf_dir).select(*TRIP_STOPS)


def filter_route_group_query(spark, sf_dir):
    return filter_route_group(trip_stops(spark, sf_dir), ROUTE_GROUPS[GROUP], DIRECTION).select(*TRIP_STOPS)


def select_columns_query(spark, sf_dir):
    """Source names with blanks and commas."""
    source = trip_stops(spark, sf_dir).withColumnsRenamed(
        {"op_day": "Op Day", "stop_name": "Stop Name", "evt_sta": "Evt, Sta"}
    )
    return select_columns(source, "trp_number_trim", "Op Day", "Stop Name", "Evt, Sta")


def attach_stop_order_query(spark, sf_dir):
    return attach_stop_order(_clean(spark, sf_dir), stop_order(spark, sf_dir)).select(*TRIP_STOPS, "stop_order")


def restore_display(spark, sf_dir):
    """Printed times of all grids, found again by joining their long form to the base table."""
    timetable = _timetable(spark, sf_dir)
    long = natural_left_join(
        timetable.timetable_cells.select(*GRID, "trp_op_day", "route", "evt_sta", "stop_info"),
        timetable.cells.select(*GRID, "trp_op_day", "route", "evt_sta", "stop_info", "dep_time_24h"),
    )
    shown = natural_left_join(long.select(*WIDE_IDS, "stop_info", "dep_time_24h"), _base(spark, sf_dir))
    return shown.select(*WIDE_IDS, "stop_info", "departure_save").distinct()


# Distinct, counts and reshaping

def distinct_base(spark, sf_dir):
    """Trips and their stop times, as a grid takes them from the base table."""
    return _base(spark, sf_dir).select(*WIDE_IDS, "stop_info", "dep_time_24h").distinct()


def stop_service_counts(spark, sf_dir):
    return _timetable(spark, sf_dir).stops.select(*GRID, "stop_info", "cnt")


def anchor_stop(spark, sf_dir):
    return _timetable(spark, sf_dir).stops.filter("is_anchor").select(*GRID, "stop_info", "cnt")


def pivot_times(spark, sf_dir):
    timetable = _one_grid(spark, sf_dir)
    return pivot_grid(
        timetable.cells, WIDE_IDS, "stop_info", "dep_time_24h", timetable.header(GROUP, DIRECTION)
    )


def unpivot_times(spark, sf_dir):
    return unpivot_grid(pivot_times(spark, sf_dir), WIDE_IDS, "stop_info", "dep_time_24h")


def pivot_display(spark, sf_dir):
    timetable = _one_grid(spark, sf_dir)
    texts = pivot_grid(timetable.cells, WIDE_IDS, "stop_info", "display", timetable.header(GROUP, DIRECTION))
    return fill_placeholder(texts, EMPTY_CELL)


# Order

def stop_positions(spark, sf_dir):
    return _timetable(spark, sf_dir).stops.select(*GRID, "stop_info", "stop_pos")


def trip_ranks(spark, sf_dir):
    return _timetable(spark, sf_dir).trips


# Scalar functions

def split_departure(spark, sf_dir):
    timed = with_clock(_clean(spark, sf_dir))
    return timed.groupBy("departure", "time", "meridian").agg(F.count(F.lit(1)).alias("row_count"))


def normalize_clock(spark, sf_dir):
    timed = with_clock(_clean(spark, sf_dir))
    strict = dep_time_24h(F.col("time"), F.col("meridian"), strict_midnight=True)
    return timed.select(
        "trp_number_trim", "stop", "departure", "dep_time_24h", strict.alias("strict_time_24h")
    )


def display_time(spark, sf_dir):
    return with_display(_clean(spark, sf_dir)).select("trp_number_trim", "stop", "departure", "departure_save")


def number_stop_order(spark, sf_dir):
    """Stop order as a number; texts that are not numbers are null."""
    joined = attach_stop_order(_clean(spark, sf_dir), stop_order(spark, sf_dir))
    return joined.select(
        "trp_number_trim", *STOP_KEY, to_number(F.col("stop_order")).alias("stop_order"),
        to_number(F.col("departure")).alias("departure_number"),
    )


def trip_stop_labels(spark, sf_dir):
    labelled = label_trips(label_stops(trip_stops(spark, sf_dir)))
    return labelled.select("trp_op_day", "stop_info", "route")


def fill_placeholder_query(spark, sf_dir):
    """Missing events as empty text; then any missing text as an empty cell."""
    events = fill_placeholder(trip_stops(spark, sf_dir).select(*TRIP_STOPS), NO_EVENT, ["evt_sta"])
    return fill_placeholder(events, EMPTY_CELL)


# Composite operators

def timetable_base_query(spark, sf_dir):
    return _base(spark, sf_dir).select(*BASE)


def route_groups_query(spark, sf_dir):
    """Rows of every printed route, none included."""
    counted = _clean(spark, sf_dir).groupBy("route").agg(F.count(F.lit(1)).alias("row_count"))
    return route_groups(spark).join(counted, "route", "left").select(
        "route_group", "route", F.coalesce("row_count", F.lit(0)).alias("row_count")
    )


def timetable_cells(spark, sf_dir):
    return _timetable(spark, sf_dir).timetable_cells


def _printed(rows):
    return rows.select(
        *GRID, "trip_rank", "trp_op_day", "route", "evt_sta", F.array_join("cells", "|").alias("cells")
    )


def timetable_rows(spark, sf_dir):
    """The array of each row is joined here only to compare it as one value."""
    return _printed(_timetable(spark, sf_dir).rows)


def timetable_wide(spark, sf_dir):
    return _one_grid(spark, sf_dir).wide(GROUP, DIRECTION)


def timetable_merged_routes(spark, sf_dir):
    """Grids that merge two routes."""
    merged = {group: routes for group, routes in ROUTE_GROUPS.items() if len(routes) > 1}
    return _printed(_timetable(spark, sf_dir, groups=merged).rows)


# All 45 groups in both directions

def route_groups_all(spark, sf_dir):
    counted = clean_trip_stops(trip_stops(spark, sf_dir, ALL_ROUTES)).groupBy("route").agg(
        F.count(F.lit(1)).alias("row_count"))
    return route_groups(spark).join(counted, "route", "left").select(
        "route_group", "route", F.coalesce("row_count", F.lit(0)).alias("row_count"))


def trip_ranks_all(spark, sf_dir):
    return _timetable(spark, sf_dir, ALL_ROUTES).trips


def timetable_rows_all(spark, sf_dir):
    return _printed(_timetable(spark, sf_dir, ALL_ROUTES).rows)


# Audits

def cell_conflicts(spark, sf_dir):
    return _timetable(spark, sf_dir).conflicts


def unparsed_departures_query(spark, sf_dir):
    return unparsed_departures(trip_stops(spark, sf_dir))


def coverage_gaps_query(spark, sf_dir):
    return coverage_gaps(trip_stops(spark, sf_dir), stop_order(spark, sf_dir), ROUTE_GROUPS, DIRECTIONS)


QUERIES = {
    "scan_text_dir": scan_text_dir_query,
    "scan_provenance": scan_provenance,
    "stack_files": stack_files,
    "write_timetable": write_timetable_query,
    "write_timetable_csv": write_timetable_csv,
    "base_csv": base_csv,
    "route_groups_all": route_groups_all,
    "trip_ranks_all": trip_ranks_all,
    "timetable_rows_all": timetable_rows_all,
    "clean_trip_stops": clean_trip_stops_query,
    "filter_route_group": filter_route_group_query,
    "select_columns": select_columns_query,
    "attach_stop_order": attach_stop_order_query,
    "restore_display": restore_display,
    "distinct_base": distinct_base,
    "stop_service_counts": stop_service_counts,
    "anchor_stop": anchor_stop,
    "pivot_times": pivot_times,
    "unpivot_times": unpivot_times,
    "pivot_display": pivot_display,
    "stop_positions": stop_positions,
    "trip_ranks": trip_ranks,
    "split_departure": split_departure,
    "normalize_clock": normalize_clock,
    "display_time": display_time,
    "number_stop_order": number_stop_order,
    "trip_stop_labels": trip_stop_labels,
    "fill_placeholder": fill_placeholder_query,
    "timetable_base": timetable_base_query,
    "route_groups": route_groups_query,
    "timetable_cells": timetable_cells,
    "timetable_rows": timetable_rows,
    "timetable_wide": timetable_wide,
    "timetable_merged_routes": timetable_merged_routes,
    "cell_conflicts": cell_conflicts,
    "unparsed_departures": unparsed_departures_query,
    "coverage_gaps": coverage_gaps_query,
}
