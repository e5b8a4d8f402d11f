"""Timetable outputs: one folder per route group and direction, all written by one job."""

from pyspark.sql import functions as F

from ..schemas import GRID, WIDE_IDS


def _overwrite(writer, rebuild):
    return writer.mode("overwrite").option("partitionOverwriteMode", "static" if rebuild else "dynamic")


def write_timetable(rows, path, file_format="parquet", rebuild=False):
    """Write timetable rows; grids present in ``rows`` replace theirs, other grids stay.

    With ``rebuild`` the folder holds nothing but these grids afterwards.

    Rows arrive range-sorted by grid, so a task writes few grids, and a grid of any size is spread
    over many tasks.
    """
    sorted_rows = rows.sortWithinPartitions(*GRID, "trip_rank")
    _overwrite(sorted_rows.write, rebuild).partitionBy(*GRID).format(file_format).save(path)


def write_csv(df, path):
    """Plain CSV with a header line in each file; a quote in a cell is doubled."""
    df.write.mode("overwrite").options(header=True, escape='"').csv(path)


def csv_line(texts):
    """An array of texts as one CSV line, all quoted."""
    return F.array_join(
        F.transform(texts, lambda t: F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"'))),
        ",",
    )


def timetable_lines(rows, headers):
    """Printable CSV lines of all grids: the header line has ``trip_rank`` 0, trips follow from 1."""
    trips = rows.select(
        *GRID, "trip_rank", csv_line(F.concat(F.array(*WIDE_IDS), "cells")).alias("line")
    )
    titles = headers.select(
        *GRID, F.lit(0).cast("long").alias("trip_rank"),
        csv_line(F.concat(F.array(*map(F.lit, WIDE_IDS)), "stop_infos")).alias("line"),
    )
    return titles.unionByName(trips)


def write_timetable_lines(lines, path, rebuild=False, in_order=False):
    """One folder of CSV text per grid, in printing order: file by file, header line first.

    ``in_order`` lines, like those of ``Timetable.lines``, are sorted as they are; others are sorted
    by grid and ``trip_rank`` here. With ``rebuild`` the folder holds nothing else afterwards.
    """
    lines = lines if in_order else lines.orderBy(*GRID, "trip_rank")
    _overwrite(lines.select(*GRID, "line").write, rebuild).partitionBy(*GRID).text(path)
