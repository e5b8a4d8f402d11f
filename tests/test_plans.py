"""What reaches the scan, and how often rows are shuffled."""

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tripgrid import Timetable, timetable_base
from tripgrid.plans import base_rows, printed_rows
from tripgrid.schemas import TRIP_STOPS, text_schema


@pytest.fixture(scope="module")
def export(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("export") / "trip_stops")
    fx.trip_stops(spark, fx.GRID_TRIPS).withColumn("tstp_pass_time_min", F.lit("1")).write.parquet(path)
    return spark.read.schema(text_schema([*TRIP_STOPS, "tstp_pass_time_min"])).parquet(path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _scan(df):
    return [line for line in _plan(df).splitlines() if "FileScan" in line and "departure" in line][0]


def test_filters_and_columns_reach_the_scan(spark, export, setting):
    setting("spark.sql.maxMetadataStringLength", "10000")
    scan = _scan(printed_rows(base_rows(export, fx.stop_order(spark, fx.GRID_ORDER))).drop("place"))
    assert "In(direction, [East,West])" in scan
    assert "Not(EqualTo(route,Car))" in scan
    columns = scan.partition("ReadSchema")[0]
    assert "place" not in columns and "tstp_pass_time_min" not in columns


def test_base_is_one_shuffle_with_map_side_combine(spark, export):
    plan = _plan(timetable_base(export, fx.stop_order(spark, fx.GRID_ORDER)))
    steps = [line for line in plan.splitlines() if "trp_number_trim" in line]
    assert sum("Exchange hashpartitioning" in line for line in steps) == 1
    assert sum("HashAggregate" in line for line in steps) == 2 and "BroadcastHashJoin" in plan


def test_cells_are_merged_before_their_shuffle(spark, export):
    grid = Timetable(export, fx.stop_order(spark, fx.GRID_ORDER))
    plan = _plan(grid._cells_by_trip().agg(F.count("*")))
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_cells_need_no_sort_before_their_shuffle(spark, export):
    grid = Timetable(export, fx.stop_order(spark, fx.GRID_ORDER))
    plan = _plan(grid._numbered_cells())
    assert "Sort" not in plan
    steps = [line for line in plan.splitlines() if "trp_op_day" in line]
    assert sum("HashAggregate" in line for line in steps) == 2
    assert sum("Exchange hashpartitioning" in line for line in steps) == 1


def test_ranking_reads_no_cells(spark, export):
    """The sort sees keys only, and cells are read once for the rows."""
    grid = Timetable(export, fx.stop_order(spark, fx.GRID_ORDER))
    assert not {"entries", "display", "cells"} & set(grid._trips.columns)
    plan = _plan(grid._printed_trips())
    assert sum("FileScan" in line and "display" in line for line in plan.splitlines()) == 1
    assert "rangepartitioning" not in _plan(grid.rows)
