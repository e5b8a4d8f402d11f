"""Words, row numbers and other small pieces that several operators share."""

from pyspark.sql import Window, functions as F

from ..functions import quoted
from ..operators import bounded
from ..sources import Staging

__all__ = ["Staging", "bounded", "ascii_lower", "words", "whole_text", "numbered", "fenced", "matching", "reserved", "ROW"]

# Words are runs of other characters than ASCII signs, blanks and capitals; texts are lower-cased first.
# Cutting at the others is several times faster than extracting the words.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ROW = "_row"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole_text(text):
    """The text, null as empty."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text):
    """A-Z as a-z and nothing else; pure ASCII texts take the faster general function."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _CAPITALS, _SMALL))


def words(text):
    """Array of the lower-cased words of a text; null has none."""
    return F.array_remove(F.split(ascii_lower(whole_text(text)), NO_WORD, -1), "")


def reserved(df, *names):
    """Column names that ``df`` does not use, made from these."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def matching(documents, judged, how):
    """Documents with (``left_semi``) or without (``left_anti``) a judged row of their id and text.

    ``judged`` has ``doc_id`` and ``text_hash``; null ids match. No column of the documents can clash.
    """
    judged_id, judged_hash = reserved(documents, "judged_id", "judged_hash")
    keys = judged.select(F.col("doc_id").alias(judged_id), F.col("text_hash").alias(judged_hash)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(judged_id)) & (F.xxhash64("text") == F.col(judged_hash))
    return documents.join(keys, same, how)


def fenced(df, drop=(), **columns):
    """``df`` with these columns set, each computed once per row whatever is done with it later.

    The optimizer copies a projected expression into every filter on it; it does not look behind a
    generator, so the values come out of one that yields a single row.
    """
    values = F.inline(F.array(F.struct(*[column.alias(name) for name, column in columns.items()])))
    kept = [c for c in df.columns if c not in drop]
    others = [quoted(c) for c in kept if c not in columns]
    order = [*kept, *[c for c in columns if c not in kept]]
    return df.select(*others, values).select(*map(quoted, order))


def numbered(staged, groups, name):
    """Number the rows 0, 1, ... of each group without a gap, whatever share of them it holds.

    ``staged`` must be a staged table with the column ``_row`` of ``monotonically_increasing_id``,
    whose upper bits say which task wrote a row. A group is numbered within each of these parts, and
    a table with one row per part and group says how far to shift the numbers; so no task ever sees
    a whole group.
    """
    parted = staged.withColumn("_part", F.shiftright(ROW, 33))
    within = Window.partitionBy(*groups, "_part").orderBy(ROW)
    counts = parted.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(*groups, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    ranked = parted.withColumn("_place", F.row_number().over(within))
    return (
        ranked.join(bounded(shifts), [*groups, "_part"])
        .withColumn(name, F.col("_place") - 1 + F.col("_shift")).drop("_part", "_place", "_shift")
    )
