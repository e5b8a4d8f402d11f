from .audit import coverage_gaps, unparsed_departures
from .base import base_rows, label_stops, label_trips, timetable_base, with_clock, with_display
from .groups import printed_rows, route_groups, with_route_group
from .timetable import ConflictingCells, Timetable

__all__ = [
    "ConflictingCells", "Timetable", "base_rows", "coverage_gaps", "label_stops",
    "label_trips", "printed_rows", "route_groups", "timetable_base", "unparsed_departures", "with_clock",
    "with_display", "with_route_group",
]
