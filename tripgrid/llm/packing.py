"""Best-fit packing of tokenized documents by exact-complement hashing.

1. Tokenize: each document's ids, then an end id; longer ones are cut into full pieces, of which the
   first may be shorter. One pass; every piece becomes a thin row in a staged table.
2. Count pieces by length. There are no more lengths than a sequence has tokens, so this histogram is
   small however many pieces there are; only it reaches the driver.
3. Plan on the histogram. The longest length left opens a sequence. An index of single, pair and
   triple sums over the available lengths is asked for an exact complement of its gap, first for
   one that holds the longest length that fits, then for any; without one that length is the best fit,
   and the rest of the gap is asked for again. The combination is used as often as the counts allow, so
   every step uses up a length or closes an odd remainder: a few thousand steps, each standing for any
   number of equal sequences. Complements without the longest fit use up short pieces that fill later
   gaps, so the plan is also made without them, and the shorter one is taken.
4. Number the pieces within their length (split over tasks, whatever share a length has), and join
   them with the plan on length and number.

Null and empty texts have the end id only. Repeated documents are packed as often as they occur.
"""

import re
import sys
import types
from array import array
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import ROW, Staging, numbered

CAPACITY, END_ID = 1024, 2
# A Python worker keeps the ids of so many cuts of either generation: those met lately, and before.
REMEMBERED = 1 << 19

# White space as the tokenizer's pattern has it. A text is cut where that pattern cuts it as well: after
# a word of Latin letters that a blank, the end or a sign other than an apostrophe follows, and around
# white space; what lies between is left to the tokenizer.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_CUT = re.compile(
    rf" ?[{_LATIN}]+(?![^{_WHITE}!-&(-/:-@\[-`{{-~])| ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)


# How byte-level vocabularies spell bytes: printable Latin signs as themselves, the others from 256 on.
_SPELLED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SIGNS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SPELLED)}


class _Ids(dict):
    """Ids of text cuts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path):
        from tokenizers import Tokenizer

        self.before = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # Strings with an id of their own stand in the text as they are and part it.
        self.own = {t.content: np.array([i], "<u4").tobytes() for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(self.own, key=len, reverse=True))) + ")") if self.own else None

    def __missing__(self, cut):
        ids = self.before.pop(cut, None)
        if ids is None:
            word = cut[1:] if cut[0] == " " else cut
            if word.isalpha() and max(word) <= "ÿ":
                # Latin letters are one piece of the tokenizer's pattern, which its model takes as bytes.
                spelled = cut.encode().decode("latin-1").translate(_SIGNS)
                numbers = array("I", [token.id for token in self.model.tokenize(spelled)])
            else:
                numbers = array("I", self.tokenizer.encode(cut, add_special_tokens=False).ids)
            if sys.byteorder == "big":
                numbers.byteswap()
            ids = numbers.tobytes()
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        self[cut] = ids
        return ids

    def of(self, text):
        if self.parts is None or not self.parts.search(text):
            return b"".join(map(self.__getitem__, _CUT.findall(text)))
        return b"".join(self.own[part] if part in self.own else b"".join(map(self.__getitem__, _CUT.findall(part)))
                        for part in self.parts.split(text))


def _ids_of(path):
    """The worker's ids of this tokenizer; they outlive a task, as a worker runs many."""
    kept = sys.modules.setdefault("_tripgrid_worker", types.ModuleType("_tripgrid_worker"))
    if getattr(kept, "path", None) != path:
        kept.path, kept.ids = path, _Ids(path)
    return kept.ids


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(documents, tokenizer, capacity=CAPACITY, end_id=END_ID, with_ids=False):
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``, with ``ids`` if asked for."""
    end = np.array([end_id], "<u4").tobytes()
    schema = PIECES + (", ids array<int>" if with_ids else "")
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    schema = schema.replace("doc_id long", f"doc_id {doc_type}")
    arrow = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]

    def cut(batches):
        ids_of = _ids_of(tokenizer)
        for batch in batches:
            rows, columns, cuts = [], [[], [], [], []], []
            for at, text in enumerate(batch.column(1)):
                data = ids_of.of(text.as_py() or "") + end
                n = len(data) // 4
                start, piece = 0, 0
                while start < n:
                    length = (n % capacity or capacity) if start == 0 else capacity
                    part = data[4 * start:4 * (start + length)]
                    rows.append(at)
                    for column, value in zip(columns, (piece, start, length, crc32(part))):
                        column.append(value)
                    if with_ids:
                        cuts.append(np.frombuffer(part, "<u4").astype(np.int32))
                    start, piece = start + length, piece + 1
            out = [batch.column(0).take(pa.array(rows, pa.int64()))]
            out += [pa.array(column, kind) for column, (_, kind) in zip(columns, arrow)]
            names = ["doc_id", *[name for name, _ in arrow]]
            if with_ids:
                out.append(pa.array(cuts, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    return documents.select("doc_id", "text").mapInArrow(cut, schema)


# The plan

class _Sums:
    """Which sums single, pair and triple lengths have, under how many pieces of each length are left."""

    def __init__(self, counts):
        self.counts, self.known = counts, None

    def _index(self):
        """Lengths that are left, and which sums two of them have; made anew when a length is used up."""
        there = self.counts > 0
        if self.known is None or not np.array_equal(there, self.known):
            self.known = there
            one = there.astype(np.float64)
            self.two = np.convolve(one, one)[:len(one)] > 0.5
        return there

    def _left(self, *lengths):
        return all(self.counts[n] >= lengths.count(n) for n in lengths)

    def pair(self, total, *used):
        """Two lengths of this sum, the first the longest possible, besides those used."""
        lengths = np.flatnonzero(self.counts[:total])
        for a in lengths[(self.counts[total - lengths] > 0) & (2 * lengths >= total)][::-1].tolist():
            if self._left(*used, a, total - a):
                return a, total - a
        return None

    def holding(self, a, gap):
        """An exact complement of ``gap`` by ``a`` and one or two others, if there is one."""
        rest = gap - a
        if not rest:
            return (a,)
        if self._left(a, rest):
            return a, rest
        self._index()
        two = self.pair(rest, a) if self.two[rest] else None
        return two and (a, *two)

    def any(self, gap):
        """Any exact complement of ``gap``, the one with the longest length."""
        there = self._index()
        if self.two[gap]:
            two = self.pair(gap)
            if two:
                return two
        lengths = np.flatnonzero(there[:gap])
        for a in lengths[self.two[gap - lengths]][::-1].tolist():
            two = self.pair(gap - a, a)
            if two:
                return (a, *two)
        return None


def _complement(counts, gap, sums, any_sum):
    """Lengths for ``gap``: an exact complement, or else the longest that fits; None if none does."""
    lengths = np.flatnonzero(counts[:gap + 1])
    if not len(lengths):
        return None
    longest = int(lengths[-1])
    return sums.holding(longest, gap) or (any_sum and sums.any(gap)) or (longest,)


def plan(histogram, capacity=CAPACITY):
    """Patterns ``(lengths, times)`` that use every piece of ``{length: count}`` exactly once."""
    plans = [_plan(histogram, capacity, any_sum) for any_sum in (True, False)]
    return min(plans, key=lambda patterns: sum(times for _, times in patterns))


def _plan(histogram, capacity, any_sum):
    counts = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        counts[length] = count
    patterns, sums = [], _Sums(counts)
    while counts.any():
        longest = int(np.flatnonzero(counts)[-1])
        pattern, gap = [longest], capacity - longest
        counts[longest] -= 1
        while gap:
            chosen = _complement(counts, gap, sums, any_sum)
            if chosen is None:
                break
            for length in chosen:
                pattern.append(length)
                counts[length] -= 1
                gap -= length
        needs = np.bincount(pattern, minlength=capacity + 1)
        used = needs > 0
        more = int((counts[used] // needs[used]).min())
        counts -= more * needs
        patterns.append((tuple(pattern), 1 + more))
    return patterns


def _places(patterns):
    """Rows ``length, first, times, sequence, offset``: which pieces of a length go where.

    Pieces ``first, first + 1, ...`` of a length, ``times`` of them, lie at ``offset`` in the
    sequences ``sequence, sequence + 1, ...``.
    """
    next_piece, sequence, rows = {}, 0, []
    for lengths, times in patterns:
        offset = 0
        for length in lengths:
            first = next_piece.get(length, 0)
            rows.append((length, first, times, sequence, offset))
            next_piece[length] = first + times
            offset += length
        sequence += times
    return rows


def pack(documents, tokenizer, capacity=CAPACITY, end_id=END_ID, with_ids=False, staging=None):
    """Every piece with its place: the columns of ``pieces``, ``sequence_id`` and ``offset``.

    Pieces of a sequence follow each other without a gap from offset 0, at most ``capacity`` tokens
    together.
    """
    spark = documents.sparkSession
    staging = staging or Staging(spark)
    cut = pieces(documents, tokenizer, capacity, end_id, with_ids)
    staged = staging.table(cut.withColumn(ROW, F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["count"] for r in staged.groupBy("length").count().collect()}
    runs = zip(*_places(plan(histogram, capacity))) if histogram else [()] * 5
    table = spark.createDataFrame(pa.table({
        name: pa.array(column, pa.int64()) for name, column in zip(("_length", "_first", "_times", "_sequence", "offset"), runs)}))
    placed = numbered(staged, ["length"], "_nth")
    mine = (F.col("length") == F.col("_length")) & (F.col("_nth") >= F.col("_first")) & (
        F.col("_nth") < F.col("_first") + F.col("_times"))
    # The plan's size depends on the number of lengths, not of pieces.
    return placed.join(F.broadcast(table), mine).select(
        *cut.columns, (F.col("_sequence") + F.col("_nth") - F.col("_first")).alias("sequence_id"), "offset")
