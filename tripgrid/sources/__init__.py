from .folders import scan_folder, scan_text_dir
from .sinks import csv_line, timetable_lines, write_csv, write_timetable, write_timetable_lines
from .staging import Staging

__all__ = [
    "Staging", "csv_line", "scan_folder", "scan_text_dir", "timetable_lines", "write_csv", "write_timetable",
    "write_timetable_lines",
]
