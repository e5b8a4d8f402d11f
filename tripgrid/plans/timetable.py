"""All timetable grids of all route groups and directions in one go."""

from functools import cached_property

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..fixed_values import DIRECTIONS, EMPTY_CELL, NO_EVENT, ROUTE_GROUPS
from ..functions import aligned_cells
from ..operators import attach_stop_order, bounded, clean_trip_stops, fill_placeholder, fits, ranked
from ..schemas import CELL, GRID, TRIP, WIDE_IDS
from ..sources import Staging, csv_line
from .base import base_rows, label_stops, label_trips, numeric_sheet, with_clock, with_display
from .groups import printed_rows, with_route_group

# A sort key of two numbers below this one is a single long.
_HALF = 1 << 31
# Partitions in printing order have so many rows at least.
_LEAST_ROWS = 1000


class ConflictingCells(ValueError):
    """A trip has several times or texts at the same stop."""


class Timetable:
    """Lazily built tables of the grids, which share one staged table of cells.

    ``cells`` is aggregated from the inputs once, with partial aggregation before its shuffle, so
    repeated rows collapse where they are read. Everything else derives from it:

    * ``stops``: header of each grid, with position, number of trips served and the anchor stop;
    * ``trips``: trips of each grid, ranked by their time at the anchor stop;
    * ``rows``: one row per trip with a header-aligned array of printed times;
    * ``timetable_cells``: the same, one row per cell; ``wide``: one grid, one column per stop.

    A cell with several times or texts keeps the earliest (``conflicts`` lists them), unless
    ``on_conflict`` is ``"error"``. Use it as a context manager to remove the staged tables at the end.
    """

    def __init__(self, trip_stops, stop_order, groups=ROUTE_GROUPS, directions=DIRECTIONS,
                 on_conflict="earliest", strict_midnight=False):
        if on_conflict not in ("earliest", "error"):
            raise ValueError(f"on_conflict is 'earliest' or 'error', not {on_conflict!r}")
        self.trip_stops, self.stop_order = trip_stops, stop_order
        self.groups, self.directions = groups, directions
        self.on_conflict, self.strict_midnight = on_conflict, strict_midnight
        self._staging = Staging(trip_stops.sparkSession)

    def __enter__(self):
        return self

    def __exit__(self, *failure):
        self._staging.remove()

    @cached_property
    def cells(self):
        """One row per trip and stop: earliest and latest time and printed text, where the header first has it.

        ``seen`` only sorts: the place in the sheet, then the time, missing ones last.
        """
        merged = self._numbered_cells()
        if merged is None:
            merged = self._plain_cells()
        cells = self._staging.table(
            with_route_group(merged, self.groups).select(
                *CELL, "dep_time_24h", "display", "seen", "latest_time", "latest_display"),
            "cells",
        )
        if self.on_conflict == "error":
            example = _conflicts(cells).first()
            if example:
                raise ConflictingCells(f"several times or texts in one cell, for example {example}")
        return cells

    def _printed(self, rows):
        return printed_rows(rows, self.groups, self.directions)

    def _numbered_cells(self):
        """Cells merged by a hash aggregate; None if there are too many departures or stops to broadcast.

        A minimum of time and text needs a sort, one of numbers does not. So departures are numbered in
        the order in which a cell prefers them, as are the places of the sheet. There are few different
        departures; reading their clock there spares a regular expression per row, too.
        """
        texts = self._printed(clean_trip_stops(self.trip_stops)).select("departure").distinct()
        known = self._staging.table(
            with_display(with_clock(texts, self.strict_midnight)).select("departure", "dep_time_24h", "departure_save"), "departures")
        sheet = numeric_sheet(self.stop_order, self._staging)
        if not (fits(known) and fits(sheet)):
            return None
        # Windows over measured tables.
        time = _null_last("dep_time_24h")
        text = F.col("departure_save")
        known = self._staging.table(known.select(
            "*", F.dense_rank().over(Window.orderBy(time, text.isNull(), text)).cast("long").alias("entry"),
            F.dense_rank().over(Window.orderBy(time)).cast("long").alias("time_no")), "entries")
        sheet = self._staging.table(sheet.withColumn(
            "stop_order", F.dense_rank().over(Window.orderBy(_null_last("stop_order"))).cast("long")), "places")
        rows = clean_trip_stops(self.trip_stops).alias("l").join(
            F.broadcast(known.select(F.col("departure").alias("_departure"), "entry", "time_no")),
            F.col("l.departure").eqNullSafe(F.col("_departure")))
        rows = fill_placeholder(attach_stop_order(rows, sheet), NO_EVENT, ["evt_sta"])
        merged = self._printed(label_trips(label_stops(rows))).groupBy(*[c for c in CELL if c != "route_group"]).agg(
            F.min("entry").alias("first"), F.max("entry").alias("last"),
            F.min(F.col("stop_order") * _HALF + F.col("time_no")).alias("seen"))
        entries = known.select("entry", "dep_time_24h", F.col("departure_save").alias("display")).distinct()
        shown = F.broadcast(entries.withColumnRenamed("entry", "first"))
        latest = F.broadcast(entries.select(
            F.col("entry").alias("last"), F.col("dep_time_24h").alias("latest_time"), F.col("display").alias("latest_display")))
        return merged.join(shown, "first").join(latest, "last")

    def _plain_cells(self):
        """The same by a sort aggregate, for any number of departures and stops."""
        base = self._printed(base_rows(self.trip_stops, self.stop_order, self.strict_midnight, self._staging))
        text, time = F.col("departure_save"), _null_last("dep_time_24h")
        entry = F.struct(time.alias("time"), text.isNull(), text.alias("text"))
        merged = base.groupBy(*[c for c in CELL if c != "route_group"]).agg(
            F.min(entry).alias("shown"), F.max(entry).alias("last"),
            F.min(F.struct(_null_last("stop_order").alias("order"), time.alias("time"))).alias("seen"),
        )
        return merged.select(
            *[c for c in CELL if c != "route_group"], _no_nan("shown.time").alias("dep_time_24h"),
            F.col("shown.text").alias("display"), "seen", _no_nan("last.time").alias("latest_time"),
            F.col("last.text").alias("latest_display"))

    @cached_property
    def conflicts(self):
        """Cells with more than one pair of time and text, a missing one included."""
        return _conflicts(self.cells)

    @cached_property
    def _header(self):
        # Only numbers are aggregated where cells are numbered: a hash aggregate shrinks them to about
        # one row per stop and route before anything is shuffled.
        served = F.count(F.when(F.col("dep_time_24h") > 0, 1))
        per_key = self.cells.groupBy(*GRID, "stop_info", "route").agg(served.alias("cnt"), F.min("seen").alias("seen"))
        per_stop = per_key.groupBy(*GRID, "stop_info").agg(
            F.sum("cnt").alias("cnt"), F.min(F.struct("route", "seen")).alias("first_seen"))
        # One row per header column: as many as one output row has cells.
        grid = Window.partitionBy(*GRID)
        placed = per_stop.withColumn(
            "stop_pos", F.row_number().over(grid.orderBy("first_seen", "stop_info"))
        ).withColumn("width", F.count(F.lit(1)).over(grid))
        busiest = F.row_number().over(grid.orderBy(F.col("cnt").desc(), "stop_pos"))
        return self._staging.table(
            placed.select(*GRID, "stop_info", "cnt", "stop_pos", (busiest == 1).alias("is_anchor"), "width"),
            "stops",
        )

    @cached_property
    def stops(self):
        return self._header.drop("width")

    @cached_property
    def headers(self):
        """One row per grid: its stops in printing order."""
        ordered = F.array_sort(F.collect_list(F.struct("stop_pos", "stop_info")))
        return self._header.groupBy(*GRID).agg(
            F.transform(ordered, lambda s: s["stop_info"]).alias("stop_infos")
        )

    @property
    def _placed_cells(self):
        """Cells with their place in the header."""
        return self.cells.join(bounded(self._header.drop("cnt")), [*GRID, "stop_info"])

    def _cells_by_trip(self):
        """Those of a trip together.

        Cells are merged already, so a trip has at most one per header column, and a partial
        aggregate would only sort rows that do not meet before the shuffle.
        """
        return self._placed_cells.repartition(*TRIP).groupBy(*TRIP)

    @cached_property
    def _trips(self):
        """Sort keys of all trips, staged: the sort reads them twice, and no cell of theirs."""
        keys = self._placed_cells.groupBy(*TRIP).agg(
            F.max(F.when(F.col("is_anchor"), F.col("dep_time_24h"))).alias("anchor_time"), F.min("seen").alias("first_seen"))
        return self._staging.table(keys, "trips")

    @cached_property
    def _ranked_trips(self):
        return self._staging.table(ranked(self._trips, self._staging, GRID, _trip_order(), "trip_rank").select(
            *TRIP, "anchor_time", "trip_rank"), "ranks")

    @cached_property
    def _filled_trips(self):
        """Ranked trips with their cells, which are collected as they are read: in no order, and never staged."""
        # A trip has at most one entry per header column, which bounds what is collected for it.
        entry = F.when(F.col("display").isNotNull(), F.struct("stop_pos", "display"))
        trips = self._cells_by_trip().agg(F.collect_list(entry).alias("entries"), F.max("width").alias("width"))
        return trips.join(bounded(self._ranked_trips), TRIP)

    def _in_printing_order(self, rows, rank):
        """Rows of grids (``rank`` 0 for header lines), sorted across partitions of about the same size.

        Ranks are dense, so a row's place among all follows from its grid's; nothing is sampled.
        """
        parts = int(self.trip_stops.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        sizes = self._ranked_trips.groupBy(*GRID).agg((F.count(F.lit(1)) + 1).alias("_n"))
        earlier = Window.orderBy(*GRID).rowsBetween(Window.unboundedPreceding, -1)
        # One row per grid, as in the route groups given.
        starts = sizes.select(*GRID, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"), F.sum("_n").over(
            Window.partitionBy()).alias("_all"))
        size = F.greatest(F.ceil(F.col("_all") / parts), F.lit(_LEAST_ROWS))
        place = F.floor((F.col("_start") + F.col(rank)) / size).cast("int")
        placed = rows.join(F.broadcast(starts), GRID).repartitionById(parts, F.least(place, F.lit(parts - 1)))
        return placed.sortWithinPartitions(*GRID, rank).drop("_start", "_all")

    @cached_property
    def trips(self):
        """Trips of each grid, ranked; those that miss the anchor stop come last."""
        return self._ranked_trips.select(*GRID, "trp_op_day", "route", "evt_sta", "anchor_time", "trip_rank")

    @cached_property
    def rows(self):
        """Ranked trips with ``cells``, an array of printed times aligned to the grid's header; in printing order."""
        return self._in_printing_order(self._printed_trips(), "trip_rank")

    def _printed_trips(self):
        return self._filled_trips.select(*GRID, "trip_rank", "trp_op_day", "route", "evt_sta", _printed_cells())

    @cached_property
    def lines(self):
        """Printed CSV lines of all grids in printing order, header lines first."""
        trips = self._printed_trips().select(
            *GRID, "trip_rank", csv_line(F.concat(F.array(*WIDE_IDS), "cells")).alias("line"))
        titles = self.headers.select(*GRID, F.lit(0).alias("trip_rank"), csv_line(
            F.concat(F.array(*map(F.lit, WIDE_IDS)), "stop_infos")).alias("line"))
        return self._in_printing_order(titles.unionByName(trips), "trip_rank").select(*GRID, "line")

    @cached_property
    def timetable_cells(self):
        """The grids in long form, empty cells included."""
        titled = self._printed_trips().join(bounded(self.headers), GRID)
        return titled.select(
            *GRID, "trip_rank", "trp_op_day", "route", "evt_sta",
            F.posexplode(F.arrays_zip("stop_infos", "cells")).alias("place", "cell"),
        ).select(
            *GRID, "trip_rank", "trp_op_day", "route", "evt_sta", (F.col("place") + 1).alias("stop_pos"),
            F.col("cell.stop_infos").alias("stop_info"), F.col("cell.cells").alias("display"),
        )

    def header(self, group, direction):
        """Stops of one grid as a list, from its one row of ``headers``."""
        one = self.headers.filter((F.col("route_group") == group) & (F.col("direction") == direction)).first()
        return list(one["stop_infos"]) if one else []

    def wide(self, group, direction):
        """One grid with one text column per stop; no rows where the grid is empty."""
        stops = self.header(group, direction)
        one = self._printed_trips().filter((F.col("route_group") == group) & (F.col("direction") == direction))
        return one.select(
            "trip_rank", *WIDE_IDS, *[F.get("cells", F.lit(i)).alias(stop) for i, stop in enumerate(stops)]
        )


def _null_last(number):
    """A sort key in which null is NaN, which Spark sorts behind every number."""
    return F.coalesce(F.col(number), F.lit(float("nan")))


def _no_nan(number):
    """The number behind such a sort key."""
    return F.when(~F.isnan(number), F.col(number))


def _trip_order():
    """What trips of a grid are sorted by; the keys are unique within it."""
    return [F.col("anchor_time").asc_nulls_last(), "route", "first_seen", "trp_op_day", "evt_sta"]


def _printed_cells():
    return aligned_cells(F.col("entries"), F.col("width").cast("int"), EMPTY_CELL).alias("cells")


def _conflicts(cells):
    same = F.col("dep_time_24h").eqNullSafe(F.col("latest_time")) & F.col("display").eqNullSafe(F.col("latest_display"))
    return cells.filter(~same).select(
        *GRID, "trp_op_day", "route", "evt_sta", "stop_info",
        F.col("dep_time_24h").alias("earliest_time"), "latest_time",
        F.col("display").alias("earliest_display"), "latest_display",
    )
