"""Wide grids: one column per stop. The stop columns are known, never discovered."""

from pyspark.sql import functions as F

from ..functions import quoted


def stop_columns(df, ids):
    """All columns but the identifying ones."""
    return [c for c in df.columns if c not in ids]


def pivot_grid(df, ids, names, values, header):
    """One row per ``ids``, one column per ``header`` entry; the smallest value of a cell, else null."""
    return df.groupBy(*ids).pivot(names, list(header)).agg(F.min(values))


def unpivot_grid(df, ids, names, values):
    """One row per row and stop column, empty cells included."""
    stops = stop_columns(df, ids)
    return df.unpivot([quoted(c) for c in ids], [quoted(c) for c in stops], names, values)
