"""Header-aligned arrays."""

from pyspark.sql import functions as F


def aligned_cells(entries, width, empty):
    """Array of ``width`` texts with each entry's ``display`` at its 1-based ``stop_pos``.

    ``entries`` is an array of struct(stop_pos, display) with distinct positions. Every entry
    brings the gap before it, filled with ``empty``, so the work is linear in the grid's width.
    """
    def mark(position):
        return F.array(F.struct(position.cast("int").alias("stop_pos"), F.lit(empty).alias("display")))

    in_order = F.array_sort(entries)
    pieces = F.zip_with(
        F.concat(mark(F.lit(0)), in_order),
        F.concat(in_order, mark(width + 1)),
        lambda before, cell: F.array_append(
            F.array_repeat(F.lit(empty), cell["stop_pos"] - before["stop_pos"] - 1), cell["display"]
        ),
    )
    return F.slice(F.flatten(pieces), F.lit(1), width)
