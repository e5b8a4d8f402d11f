"""Stacking of tables by column position."""

from pyspark.sql import functions as F

from ..functions import quoted


def stack(tables):
    """One table of all ``{name: table}``, with the name as ``id`` and the first one's column names.

    Columns meet by position; a table with another number of columns is an error. Unions are paired
    up, so the plan of many tables stays shallow.
    """
    widths = {name: len(df.columns) for name, df in tables.items()}
    if len(set(widths.values())) != 1:
        raise ValueError(f"tables differ in their number of columns: {widths}")
    level = [df.select(F.lit(name).alias("id"), *map(quoted, df.columns)) for name, df in tables.items()]
    while len(level) > 1:
        pairs = [a.union(b) for a, b in zip(level[::2], level[1::2])]
        level = pairs + level[len(pairs) * 2:]
    return level[0]
