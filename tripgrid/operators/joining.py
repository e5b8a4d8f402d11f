"""Null-safe joins."""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from ..functions import quoted
from ..schemas import STOP_KEY

# A table is broadcast only when a full count of its rows and bytes stays below both.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def bounded(df):
    """``df`` marked for broadcast if its measured size allows it, else as it is.

    Where it is too large the join becomes a sort-merge join, whose hot keys adaptive execution
    splits over several tasks. Measuring computes ``df`` once, so pass a scan or a staged table.
    """
    return F.broadcast(df) if fits(df) else df


def fits(df):
    """Whether a full count of the table's rows and bytes stays below the limits of a broadcast."""
    size = sum((_bytes(quoted(name), kind) for name, kind in df.dtypes), F.lit(0))
    rows, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= BROADCAST_ROWS and total <= BROADCAST_BYTES


def _bytes(column, kind):
    if kind == "string":
        return F.coalesce(F.octet_length(column), F.lit(0))
    if kind.startswith(("array", "map", "struct")):
        return F.coalesce(F.octet_length(F.to_json(column)), F.lit(0))
    return F.lit(16)


def _same(keys):
    return reduce(and_, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in map(_ticked, keys)])


def _ticked(name):
    return "`" + name.replace("`", "``") + "`"


def attach_stop_order(trip_stops, stop_order):
    """Inner many-to-many join on route, direction and stop, in which null matches null."""
    sheet = stop_order.select(*STOP_KEY, "stop_order")
    return (
        trip_stops.alias("l").join(bounded(sheet).alias("r"), _same(STOP_KEY), "inner")
        .select("l.*", "r.stop_order")
    )


def natural_left_join(left, right):
    """Left join on all columns both sides have, null matching null; may fan out."""
    common = [c for c in left.columns if c in right.columns]
    extra = [c for c in right.columns if c not in left.columns]
    return (
        left.alias("l").join(right.alias("r"), _same(common), "left")
        .select("l.*", *[F.col(f"r.{_ticked(c)}") for c in extra])
    )
