"""Small text expressions."""

from pyspark.sql import functions as F

from ..fixed_values import LABEL_SEPARATOR, MISSING_LABEL

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def paste(*columns):
    """Join texts with `` - ``; a missing text reads ``NA``."""
    texts = [F.coalesce(F.col(c), F.lit(MISSING_LABEL)) for c in columns]
    parts = [texts[0]]
    for text in texts[1:]:
        parts += [F.lit(LABEL_SEPARATOR), text]
    return F.concat(*parts)


def to_number(text):
    """Text as a double; null for anything that is not a plain decimal number (``1d`` is not one)."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def quoted(name):
    """Column reference for a name that may hold dots, commas, blanks or back-ticks."""
    return F.col("`" + name.replace("`", "``") + "`")
