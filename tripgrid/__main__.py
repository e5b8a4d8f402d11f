"""All timetables of two folders of CSV files: ``python -m tripgrid exports sheets output``."""

import argparse

from pyspark.sql import SparkSession

from .plans import Timetable
from .sources import scan_text_dir, write_timetable_lines


def print_timetables(spark, exports, sheets, output, **options):
    """Read the exports and stop-order sheets, and write one folder of CSV text per grid.

    A full rebuild: grids without rows do not stay from earlier runs.
    """
    with Timetable(scan_text_dir(spark, exports), scan_text_dir(spark, sheets), **options) as timetable:
        write_timetable_lines(timetable.lines, output, rebuild=True, in_order=True)


def main():
    parser = argparse.ArgumentParser(prog="tripgrid", description=__doc__)
    parser.add_argument("exports", help="folder of trip-stop exports")
    parser.add_argument("sheets", help="folder of stop-order sheets")
    parser.add_argument("output", help="folder for the timetables")
    parser.add_argument("--strict-midnight", action="store_true", help="sort 1200x and 12xxa around midnight")
    parser.add_argument("--on-conflict", choices=["earliest", "error"], default="earliest")
    asked = parser.parse_args()
    spark = SparkSession.builder.appName("tripgrid").getOrCreate()
    print_timetables(
        spark, asked.exports, asked.sheets, asked.output,
        strict_midnight=asked.strict_midnight, on_conflict=asked.on_conflict,
    )


if __name__ == "__main__":
    main()
