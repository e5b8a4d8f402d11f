"""Grids: golden result, edge cases, properties."""

import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks.adapter import stop_order as adapter_order, trip_stops as adapter_stops
from tests import fixtures as fx
from tripgrid import ConflictingCells, Timetable
from tripgrid.operators import attach_stop_order, joining
from tripgrid.plans import coverage_gaps, unparsed_departures


def _grid(spark, rows=None, order=None, **options):
    return Timetable(
        fx.trip_stops(spark, rows or fx.GRID_TRIPS), fx.stop_order(spark, order or fx.GRID_ORDER), **options
    )


def _rows(timetable):
    rows = timetable.rows.orderBy("route_group", "direction", "trip_rank").collect()
    return [(r.trip_rank, r.trp_op_day, r.route, r.evt_sta, r.cells) for r in rows]


def test_golden_grid(spark):
    grid = _grid(spark)
    assert _rows(grid) == fx.GRID_ROWS
    assert grid.header("24", "East") == fx.GRID_HEADER
    stops = {r.stop_info: (r.cnt, r.stop_pos, r.is_anchor) for r in grid.stops.collect()}
    assert stops == {
        "Depot - 30": (3, 1, True), "Main St. - 10": (3, 2, False), "Elm, N - 20": (2, 3, False),
    }


def test_golden_wide(spark):
    wide = _grid(spark).wide("24", "East").orderBy("trip_rank")
    assert wide.columns == ["trip_rank", "trp_op_day", "route", "direction", "evt_sta", *fx.GRID_HEADER]
    assert [tuple(r) for r in wide.collect()] == [
        (rank, trip, route, "East", event, *cells) for rank, trip, route, event, cells in fx.GRID_ROWS
    ]


def test_empty_grid(spark):
    grid = _grid(spark)
    assert grid.header("1", "West") == []
    assert grid.wide("1", "West").count() == 0


def test_no_rows_at_all(spark):
    grid = _grid(spark, rows=fx.trip("T1", "Car", [("10", "500a")]))
    assert grid.rows.count() == 0 and grid.stops.count() == 0


@pytest.mark.parametrize("partitions", ["1", "13"])
def test_row_order_and_partitions_do_not_matter(spark, setting, partitions):
    setting("spark.sql.shuffle.partitions", partitions)
    shuffled = fx.GRID_TRIPS * 3
    random.Random(7).shuffle(shuffled)
    assert _rows(_grid(spark, rows=shuffled)) == fx.GRID_ROWS


def test_conflicting_cell_keeps_the_earliest(spark):
    rows = fx.trip("T1", "24", [("10", "100p"), ("10", "1159a"), ("10", "noon")])
    grid = _grid(spark, rows=rows)
    assert _rows(grid) == [(1, "T1 - Weekday", "24", "", ["1159a"])]
    conflict = grid.conflicts.collect()
    assert [tuple(c)[5:] for c in conflict] == [("Main St. - 10", 1159.0, None, "1159a", "noon")]
    with pytest.raises(ConflictingCells):
        _grid(spark, rows=rows, on_conflict="error").cells
    assert _grid(spark, on_conflict="error").rows.count() == 5


@pytest.mark.parametrize("first, second, shown", [
    ("500a", "noon", (500.0, None, "500a", "noon")), ("0530a", "530a", (530.0, 530.0, "0530a", "530a")),
    ("5:30p", "noon", (None, None, "5:30p", "noon")), ("500a", None, (500.0, None, "500a", None)),
])
def test_no_text_of_a_cell_is_lost_silently(spark, first, second, shown):
    for pair in ([("10", first), ("10", second)], [("10", second), ("10", first)]):
        rows = fx.trip("T1", "24", [*pair, ("20", "600a")])
        assert [tuple(c)[6:] for c in _grid(spark, rows=rows).conflicts.collect()] == [shown]
        with pytest.raises(ConflictingCells):
            _grid(spark, rows=rows, on_conflict="error").cells


def test_trips_and_lines_share_one_table_of_trips(spark):
    """Whatever is asked first, trips are aggregated once and ranked once."""
    for names in (["trips", "rows", "lines"], ["lines", "rows", "trips"]):
        grid = _grid(spark)
        for name in names:
            getattr(grid, name).collect()
        root = Path(grid._staging.root.removeprefix("file:"))
        assert len(list(root.glob("trips-*"))) == len(list(root.glob("sorted_by_trip_rank-*"))) == 1


def test_zero_is_not_counted_and_leftmost_wins_without_counts(spark):
    rows = [*fx.trip("T1", "24", [("10", "0a"), ("20", "0a")]), *fx.trip("T2", "24", [("20", "0a")])]
    stops = {r.stop_info: (r.cnt, r.is_anchor) for r in _grid(spark, rows=rows).stops.collect()}
    assert stops == {"Main St. - 10": (0, True), "Elm, N - 20": (0, False)}


def test_missing_departure_is_an_empty_cell_and_missing_labels_read_na(spark):
    rows = [(None, "24", "East", None, "10", None, None, None, None), *fx.trip("T2", "24", [("20", "500a")])]
    assert _rows(_grid(spark, rows=rows)) == [
        (1, "T2 - Weekday", "24", "", ["500a", "....."][::-1]), (2, "NA - NA", "24", "", [".....", "....."]),
    ]


def test_unreadable_stop_order_comes_last(spark):
    order = [("24", "East", "10", "first"), ("24", "East", "20", "9")]
    rows = fx.trip("T1", "24", [("10", "500a"), ("20", "600a")])
    assert _grid(spark, rows=rows, order=order).header("24", "East") == ["Elm, N - 20", "Main St. - 10"]


def test_null_matches_null(spark):
    order = [("24", "East", None, "1")]
    rows = [("T1", "24", "East", None, None, "Nowhere", "Weekday", "500a", None)]
    assert _rows(_grid(spark, rows=rows, order=order)) == [(1, "T1 - Weekday", "24", "", ["500a"])]


def test_a_sheet_that_lists_a_stop_twice(spark):
    order = [*fx.GRID_ORDER, ("24", "East", "10", "7")]
    assert _rows(_grid(spark, order=order)) == fx.GRID_ROWS


def test_custom_groups_and_directions(spark):
    grid = _grid(spark, groups={"x": ["24"], "y": ["24", "18"]}, directions=["North", "East"])
    found = {(r.route_group, r.direction): r.n for r in grid.trips.groupBy("route_group", "direction").agg(
        F.count("*").alias("n")).collect()}
    assert found == {("x", "North"): 1, ("x", "East"): 4, ("y", "North"): 1, ("y", "East"): 5}


def test_a_wide_grid_of_any_width(spark, setting):
    setting("spark.sql.pivotMaxValues", "2")
    stops = [str(n) for n in range(100, 400)]
    rows = fx.trip("T1", "24", [(stop, "500a") for stop in stops])
    wide = _grid(spark, rows=rows, order=[("24", "East", stop, stop) for stop in stops]).wide("24", "East")
    assert wide.columns[5:] == [f"Stop {stop} - {stop}" for stop in stops]
    assert wide.first()[5:] == ("500a",) * 300


def test_no_groups(spark):
    grid = _grid(spark, groups={})
    assert grid.rows.count() == 0 and grid.headers.count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_large_sheet_takes_the_shuffled_join(spark, setting, monkeypatch):
    monkeypatch.setattr(joining, "BROADCAST_ROWS", -1)
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    grid = _grid(spark)
    assert _rows(grid) == fx.GRID_ROWS
    assert "SortMergeJoin" in _plan(attach_stop_order(grid.trip_stops, grid.stop_order))


def test_a_hot_stop_is_split_by_the_shuffled_join(spark, setting, monkeypatch):
    """Half of all rows call at one stop, and the sheet is too large to broadcast."""
    monkeypatch.setattr(joining, "BROADCAST_ROWS", -1)
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100KB")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50KB")
    number = F.col("id").cast("string")
    stops = spark.range(0, 100_000, 1, 8).select(
        number.alias("trp_number_trim"), F.lit("24").alias("route"), F.lit("East").alias("direction"),
        F.when(F.col("id") % 2 == 0, "10").otherwise((F.col("id") % 97).cast("string")).alias("stop"),
    )
    sheet = spark.range(97).select(
        F.lit("24").alias("route"), F.lit("East").alias("direction"), number.alias("stop"),
        number.alias("stop_order"),
    )
    joined = attach_stop_order(stops, sheet).agg(F.count("*"), F.countDistinct("trp_number_trim"))
    assert tuple(joined.collect()[0]) == (100_000, 100_000)
    assert "SortMergeJoin(skew=true)" in _plan(joined)


def test_a_small_sheet_is_broadcast(spark):
    grid = _grid(spark)
    assert "BroadcastHashJoin" in _plan(attach_stop_order(grid.trip_stops, grid.stop_order))


def test_a_hot_grid_is_sorted_by_many_tasks(spark, setting):
    """One grid holds all trips, most without a time at the anchor stop, and one trip many copies."""
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    trips = spark.range(30_000).select(
        F.col("id").cast("string").alias("trp_number_trim"), F.lit("24").alias("route"),
        F.lit("East").alias("direction"), F.lit("P").alias("place"),
        F.when(F.col("id") % 3 == 0, "10").otherwise("20").alias("stop"), F.lit("S").alias("stop_name"),
        F.lit("Weekday").alias("op_day"),
        F.when(F.col("id") % 3 == 0, "500a").otherwise(F.lit(None)).alias("departure"),
        F.lit(None).cast("string").alias("evt_sta"),
    )
    copies = trips.unionByName(trips.filter("trp_number_trim = '7'").join(spark.range(10_000)).drop("id"))
    grid = Timetable(copies, fx.stop_order(spark, fx.GRID_ORDER))
    ranks = grid.trips.agg(
        F.count("*"), F.min("trip_rank"), F.max("trip_rank"), F.countDistinct("trip_rank")
    ).first()
    assert tuple(ranks) == (30_000, 1, 30_000, 30_000)
    assert grid.cells.count() == 30_000
    parts = Path(grid._staging.root.removeprefix("file:")).glob("sorted_by_trip_rank-*/*.parquet")
    sizes = [pq.read_metadata(part).num_rows for part in parts]
    assert sum(sizes) == 30_000 and max(sizes) < 10_000


@pytest.fixture(scope="module")
def adapted(spark, sf_dir):
    return Timetable(adapter_stops(spark, sf_dir), adapter_order(spark, sf_dir))


def test_ranks_are_dense_and_follow_the_anchor(adapted):
    trips = adapted.trips.toPandas()
    for _, grid in trips.sort_values("trip_rank").groupby(["route_group", "direction"]):
        assert list(grid["trip_rank"]) == list(range(1, len(grid) + 1))
        times = grid["anchor_time"]
        assert times.dropna().is_monotonic_increasing
        assert not times.isna().any() or times.isna().values.argmax() == times.notna().sum()


def test_every_row_has_the_width_of_its_header(adapted):
    off = adapted.rows.join(adapted.headers, ["route_group", "direction"]).filter(
        F.size("cells") != F.size("stop_infos")
    )
    assert adapted.headers.count() == 10 and off.count() == 0


def test_known_sizes(spark, adapted, sf_dir):
    if not sf_dir.endswith("sf0.01"):
        pytest.skip("sizes are known for one scale")
    assert adapted.timetable_cells.count() == 111_636
    assert adapted.trips.count() == 9_303
    assert adapted.conflicts.count() == 527


def test_audits(spark):
    rows, order = fx.trip_stops(spark, fx.GRID_TRIPS), fx.stop_order(spark, fx.GRID_ORDER)
    assert [tuple(r) for r in unparsed_departures(rows).collect()] == [("24", "East", "5:30p", 1)]
    gaps = {(r.route, r.direction, r.stop): tuple(r)[3:] for r in coverage_gaps(rows, order).collect()}
    assert gaps == {
        ("24", "East", "40"): (1, True, False, False), ("24", "North", "10"): (1, False, False, True),
        ("Car", "East", "10"): (1, True, True, False), (None, "East", "10"): (1, True, True, False),
    }
    ungrouped = coverage_gaps(rows, order, groups={"24": ["24"]}).filter("route_not_grouped")
    assert {(r.route, r.stop) for r in ungrouped.collect()} == {
        ("18", "30"), ("18", "10"), ("Car", "10"), (None, "10")}


def test_staged_tables_can_be_removed(spark, tmp_path):
    with _grid(spark) as grid:
        root = grid._staging.root.removeprefix("file:")
        assert grid.rows.count() == 5
        assert Path(root).is_dir()
    assert not Path(root).exists()


def test_trips_are_the_same_before_and_after_rows(spark):
    first, second = _grid(spark), _grid(spark)
    before = list(map(tuple, first.trips.collect()))
    assert second.rows.count() == len(before) == 5
    assert sorted(map(tuple, second.trips.collect()), key=repr) == sorted(before, key=repr)


def test_many_departures_take_the_plain_aggregate(spark, monkeypatch):
    """Results are the same where departures are too many to number."""
    numbered = _grid(spark)
    monkeypatch.setattr(joining, "BROADCAST_ROWS", -1)
    plain = _grid(spark)
    assert plain._numbered_cells() is None
    columns = [c for c in numbered.cells.columns if c != "seen"]
    assert sorted(map(tuple, plain.cells.select(columns).collect()), key=repr) == sorted(
        map(tuple, numbered.cells.select(columns).collect()), key=repr)
    assert _rows(plain) == _rows(numbered) == fx.GRID_ROWS
    assert [tuple(r) for r in plain.lines.collect()] == [tuple(r) for r in numbered.lines.collect()]


def test_rows_and_lines_come_in_printing_order(spark, monkeypatch):
    """Also where grids are spread over many partitions."""
    monkeypatch.setattr("tripgrid.plans.timetable._LEAST_ROWS", 1)
    rows = [r for n in range(40) for r in fx.trip(f"T{n:02d}", "24", [("10", f"{n % 12 + 1}00a"), ("20", "1100p")], ["East", "West"][n % 2])]
    order = [("24", d, s, s) for d in ("East", "West") for s in ("10", "20")]
    grid = _grid(spark, rows=rows, order=order)
    found = [(r.direction, r.trip_rank) for r in grid.rows.collect()]
    assert found == sorted(found) and len(found) == 40 and grid.rows.rdd.glom().filter(len).count() > 2
    lines = [r.direction for r in grid.lines.collect()]
    assert lines == sorted(lines) and len(lines) == 42 and grid.lines.first().line.startswith('"trp_op_day"')
