"""Route groups: the routes printed together in one grid."""

import pyarrow as pa
from pyspark.sql import functions as F

from ..fixed_values import DIRECTIONS, ROUTE_GROUPS
from ..operators import bounded


def route_groups(spark, groups=ROUTE_GROUPS):
    """(route_group, route) table of a ``{group: [routes]}`` mapping."""
    pairs = [(group, route) for group, members in groups.items() for route in members]
    names, routes = zip(*pairs) if pairs else ((), ())
    columns = {"route_group": pa.array(names, pa.string()), "route": pa.array(routes, pa.string())}
    return spark.createDataFrame(pa.table(columns))


def printed_rows(df, groups=ROUTE_GROUPS, directions=DIRECTIONS):
    """Rows that belong to a grid; literal lists, so the filter reaches the file scan."""
    routes = sorted({route for members in groups.values() for route in members})
    return df.filter(F.col("route").isin(routes) & F.col("direction").isin(list(directions)))


def with_route_group(df, groups=ROUTE_GROUPS):
    """Add ``route_group``; the mapping is broadcast if its size allows it."""
    return df.join(bounded(route_groups(df.sparkSession, groups)), "route")
