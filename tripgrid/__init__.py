"""Public-transit timetables as Spark jobs."""

from .plans import ConflictingCells, Timetable, timetable_base

__all__ = ["ConflictingCells", "Timetable", "timetable_base"]
