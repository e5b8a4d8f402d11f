"""Row filters, selections and placeholders."""

from pyspark.sql import functions as F

from ..fixed_values import NOT_A_ROUTE
from ..functions import quoted


def clean_trip_stops(trip_stops):
    """Drop rows without a route and the rows of non-revenue vehicles."""
    return trip_stops.filter(F.col("route").isNotNull() & (F.col("route") != NOT_A_ROUTE))


def filter_route_group(df, routes, direction):
    """Rows of one grid: one or more routes in one direction."""
    return df.filter(F.col("route").isin(*routes) & (F.col("direction") == direction))


def select_columns(df, *names):
    """Columns by name, whatever signs the names hold."""
    return df.select(*[quoted(name).alias(name) for name in names])


def fill_placeholder(df, value, columns=None):
    """Null texts as ``value``, in the given columns or in every text column."""
    text = [name for name, kind in df.dtypes if kind == "string"]
    chosen = set(text if columns is None else columns)
    return df.select(
        *[F.coalesce(quoted(c), F.lit(value)).alias(c) if c in chosen else quoted(c) for c in df.columns]
    )
