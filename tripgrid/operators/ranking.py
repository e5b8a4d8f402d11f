"""Row numbers within groups of any size."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .joining import bounded

_SLOT, _PART, _SHIFT = "_slot", "_part", "_shift"
_PART_BITS = 33


def ranked(df, staging, groups, order, name):
    """Number rows 1..n in each group, in the given order, without bringing a group into one task.

    One global sort range-partitions all rows by group and order; its keys must identify a row, so
    that a group of any size splits evenly. ``df`` is read twice, for the range bounds and for the
    sort, so pass a scan or a staged table. ``monotonically_increasing_id`` then holds each row's
    partition (upper bits) and place in it (lower bits). The sorted table is staged, so these stay
    as they are, and a table with one row per partition and group says how far to shift the places.
    Only that table meets a window: since the rows are sorted, it has at most as
    many rows as there are partitions and groups together. ``groups`` must be few, like grids.
    """
    placed = staging.table(
        df.orderBy(*groups, *order).withColumn(_SLOT, F.monotonically_increasing_id()), f"sorted_by_{name}"
    ).withColumn(_PART, F.shiftright(_SLOT, _PART_BITS))
    runs = placed.groupBy(*groups, _PART).agg(F.min(_SLOT).alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*groups).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select(
        *groups, _PART,
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias(_SHIFT),
    )
    numbered = placed.join(bounded(shifts), [*groups, _PART])
    return numbered.withColumn(name, F.col(_SLOT) + F.col(_SHIFT)).drop(_SLOT, _PART, _SHIFT)
