"""Spelling variants grouped by finite-state composition.

Words are the lower-cased runs of letters in all texts that are long and frequent enough. Two words are near if one
inserted, deleted or replaced code point is all they differ by; a word's form is its most frequent near
word, if that one is ``RATIO`` times as frequent; following forms leads to its root.

1. Count. Each task counts its documents' runs in a table of bounded size before the shuffle.
2. Partition by initial state. A pair that differs behind the first ``SHARED`` code points starts in the
   same state, the one these lead to; any other pair shares its last ones, as words are at least twice as
   long, and starts in the same state if words are read backwards. So each word goes to two partitions,
   and a pair is accepted in exactly one of them. A partition of more than ``MOST_WORDS`` words is cut
   by the next code point; pairs that differ exactly there meet in partitions of their own, by what stands behind
   it, which the alphabet bounds. That goes on until all partitions are small; no pair is lost.
3. Compose. Each partition's words become a minimised acceptor A (built word by word from sorted ones). The
   composition A o E o A with a one-edit transducer E has states ``(p, q, edits)``. As A is deterministic,
   before the edit both sides are in the same state, and after it the accepted pairs are the words that two
   states both accept. These sets are kept by pair of states, which minimising makes few, and
   each state's accepted pairs are listed for every prefix that leads to it. States count the words behind
   them, so a pair is two word numbers and no text is built.
4. Per word the partitions report the number of near words and the best one; these are merged, and roots are
   found by doubling the steps along forms.

Null texts have no words, null ids count as an empty id, repeated rows count as often as they occur. Ties between forms go
to the smallest in code-point order. An empty table gives an empty one; other columns are not looked at.
"""

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import Staging, bounded

LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
SHARED = 3
MOST_WORDS = 10_000
DROP_ONE_IN = 199
# A task's table of counts is handed on at this size.
HELD_COUNTS = 500_000
LETTERS = "A-Za-zÀ-ÿ"
_SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Counting

def _counter(least_length, drop_one_in):
    runs = re.compile(f"[{LETTERS}]{{{least_length},}}")

    def batch_of(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(counts, pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches):
        counts = {}
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                here = {}
                # Shorter runs cannot become words.
                for word in runs.findall(text.as_py() or ""):
                    here[word] = here.get(word, 0) + 1
                start = crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in here.items():
                    word = word.translate(_SMALL)
                    h = crc32(word.encode(), start)
                    if h % drop_one_in == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least_length:
                            continue
                    counts[word] = counts.get(word, 0) + n
                if len(counts) > HELD_COUNTS:
                    yield batch_of(counts)
                    counts = {}
        yield batch_of(counts)

    return run


def vocabulary(documents, least_length=LEAST_LENGTH, least_count=LEAST_COUNT, drop_one_in=DROP_ONE_IN):
    """``word, n`` of all words, counted over all documents."""
    counted = documents.select("doc_id", "text").mapInArrow(_counter(least_length, drop_one_in), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# Acceptors

class Acceptor:
    """The minimal acyclic acceptor of some words, given sorted and without repeats.

    ``arcs[s]`` maps labels to states in sorted order, ``final[s]`` says whether a word ends, ``size[s]`` counts
    the words accepted from a state on, and ``skip[s]`` maps labels to how many of these come before.
    """

    def __init__(self, words):
        self.arcs, self.final, register, before = [{}], [False], {}, ""
        path = [0]
        for word in words:
            same = 0
            while same < len(before) and same < len(word) and before[same] == word[same]:
                same += 1
            self._minimise(path, before, same, register)
            for label in word[same:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[path[-1]][label] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final[path[-1]] = True
            before = word
        self._minimise(path, before, 0, register)
        self.size, self.skip = {}, {}
        self._count(0)

    def _minimise(self, path, word, keep, register):
        """Replace the states of the last word behind ``keep`` by equal ones that are known."""
        while len(path) > keep + 1:
            state = path.pop()
            same = (self.final[state], tuple(self.arcs[state].items()))
            known = register.setdefault(same, state)
            if known != state:
                self.arcs[path[-1]][word[len(path) - 1]] = known

    def _count(self, start):
        todo = [start]
        while todo:
            state = todo[-1]
            if state in self.size:
                todo.pop()
                continue
            open_ = [t for t in self.arcs[state].values() if t not in self.size]
            if open_:
                todo += open_
                continue
            total, skip = int(self.final[state]), {}
            for label, target in self.arcs[state].items():
                skip[label] = total
                total += self.size[target]
            self.size[state], self.skip[state] = total, skip
            todo.pop()


class Composition:
    """Pairs of words that A o E o A accepts, E making exactly one edit."""

    def __init__(self, words):
        self.a = Acceptor(words)
        self._both = {}

    def both(self, p, q):
        """Numbers (from ``p``, from ``q``) of the words both states accept, as two arrays."""
        arcs, known, todo = self.a.arcs, self._both, [(p, q)]
        # Words can be far longer than calls can be nested.
        while todo:
            x, y = todo[-1]
            if x == y or (x, y) in known:
                todo.pop()
                continue
            labels = arcs[x].keys() & arcs[y].keys()
            open_ = [t for t in ((arcs[x][label], arcs[y][label]) for label in labels) if t[0] != t[1] and t not in known]
            if open_:
                todo += open_
            else:
                known[x, y] = self._met(x, y, labels)
        return self._all(p) if p == q else known[p, q]

    def _all(self, p):
        every = np.arange(self.a.size[p])
        return every, every

    def _met(self, p, q, labels):
        a, left, right = self.a, [], []
        if a.final[p] and a.final[q]:
            left.append(np.zeros(1, np.int64))
            right.append(np.zeros(1, np.int64))
        for label in labels:
            x, y = a.arcs[p][label], a.arcs[q][label]
            x, y = self._all(x) if x == y else self._both[x, y]
            if len(x):
                left.append(x + a.skip[p][label])
                right.append(y + a.skip[q][label])
        return (np.concatenate(left), np.concatenate(right)) if left else (_NONE, _NONE)

    def edits(self, p):
        """Pairs of words from state ``p`` on that differ by an edit right there."""
        a = self.a
        left, right = [], []

        def add(x, y, skip_x, skip_y):
            if len(x):
                left.append(x + skip_x)
                right.append(y + skip_y)

        arcs, skip = list(a.arcs[p].items()), a.skip[p]
        for n, (label, target) in enumerate(arcs):
            for other, beside in arcs[n + 1:]:
                add(*self.both(target, beside), skip[label], skip[other])
            # One more code point on the left; where the right goes on with the same one the edit can stand later.
            if a.final[target] and a.final[p]:
                add(np.zeros(1, np.int64), np.zeros(1, np.int64), skip[label], 0)
            for other, beside in arcs:
                if other != label and other in a.arcs[target]:
                    add(*self.both(a.arcs[target][other], beside), skip[label] + a.skip[target][other], skip[other])
        return (np.concatenate(left), np.concatenate(right)) if left else (_NONE, _NONE)

    def pairs(self, least=0, most=None):
        """Word numbers of all pairs that agree in at least ``least`` code points first, and at most ``most``."""
        a, known, left, right = self.a, {}, [], []
        todo = [(0, 0, 0)]
        while todo:
            p, start, depth = todo.pop()
            if depth >= least:
                if p not in known:
                    known[p] = self.edits(p)
                x, y = known[p]
                if len(x):
                    left.append(x + start)
                    right.append(y + start)
            if most is None or depth < most:
                todo += [(t, start + a.skip[p][label], depth + 1) for label, t in a.arcs[p].items() if a.size[t] > 1]
        return (np.concatenate(left), np.concatenate(right)) if left else (_NONE, _NONE)


_NONE = np.zeros(0, np.int64)


# Partitions

def partitions(words, staging, most_words=MOST_WORDS, shared=SHARED):
    """``backward, depth, exact, members`` (of ``text, n``): partitions that hold every near pair exactly once.

    Pairs count where they agree in ``depth`` code points at least, or exactly if ``exact``. Backward ones
    hold reversed words, and only pairs that differ among their first ``shared`` code points count there.
    """
    both = [words.select(F.lit(back).alias("backward"), (F.reverse("word") if back else F.col("word")).alias("text"), "n")
            for back in (False, True)]
    open_, depth, out = both[0].unionByName(both[1]), shared, None
    member = F.struct("text", "n")
    while True:
        keyed = open_.withColumn("start", F.substring("text", 1, depth))
        sizes = staging.table(keyed.groupBy("backward", "start").agg(F.count(F.lit(1)).alias("size")), f"sizes{depth}")
        large = sizes.filter(F.col("size") > most_words).select("backward", "start")
        none_left = large.isEmpty()
        small = keyed if none_left else keyed.join(bounded(large), ["backward", "start"], "left_anti")
        parts = [small.groupBy("backward", "start").agg(F.collect_list(member).alias("members")).select(
            "backward", F.lit(depth).alias("depth"), F.lit(False).alias("exact"), "members")]
        if not none_left:
            open_ = staging.table(keyed.join(bounded(large), ["backward", "start"], "left_semi"), f"large{depth}")
            # What stands behind the place of the edit, with and without the code point there.
            rests = F.array(F.substr("text", F.lit(depth + 1)), F.when(
                F.char_length("text") > depth, F.substr("text", F.lit(depth + 2))))
            behind = open_.select("backward", "start", "text", "n", F.explode(F.array_compact(rests)).alias("rest"))
            parts.append(behind.groupBy("backward", "start", "rest").agg(F.collect_list(member).alias("members")).select(
                "backward", F.lit(depth).alias("depth"), F.lit(True).alias("exact"), "members"))
            # A word that ends here has no further code points; its pairs are among those just made.
            open_ = open_.filter(F.char_length("text") > depth).drop("start")
        for part in parts:
            out = part if out is None else out.unionByName(part)
        if none_left:
            return out.filter(F.size("members") > 1)
        depth += 1


def _near(shared):
    def run(batches):
        for batch in batches:
            rows = [[], [], [], []]
            members = batch.column(3)
            flat, offsets = members.flatten(), members.offsets.to_numpy()
            offsets = offsets - offsets[0]
            texts, counts = flat.field("text"), flat.field("n")
            for at, (backward, depth, exact) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(3)))):
                part = slice(int(offsets[at]), int(offsets[at + 1]))
                mine = texts[part].to_pylist()
                order = sorted(range(len(mine)), key=mine.__getitem__)
                # Both rests of a word can be the same, as in a doubled letter.
                order = [i for k, i in enumerate(order) if k == 0 or mine[order[k - 1]] != mine[i]]
                words = [mine[i] for i in order]
                n = counts[part].to_numpy()[order]
                i, j = Composition(words).pairs(depth, depth if exact else None)
                if backward:
                    words = [w[::-1] for w in words]
                    early = np.array([words[x][:shared] != words[y][:shared] for x, y in zip(i.tolist(), j.tolist())], bool)
                    i, j = i[early], j[early]
                if not len(i):
                    continue
                # The strongest near word: the most frequent, then the smallest.
                strength = np.empty(len(words), np.int64)
                weakest = sorted(range(len(words)), key=words.__getitem__, reverse=True)
                weakest.sort(key=n.tolist().__getitem__)
                strength[weakest] = np.arange(len(words))
                near = np.bincount(np.concatenate([i, j]), minlength=len(words))
                best = np.full(len(words), -1)
                np.maximum.at(best, i, strength[j])
                np.maximum.at(best, j, strength[i])
                for w in np.flatnonzero(near).tolist():
                    b = weakest[best[w]]
                    for column, value in zip(rows, (words[w], int(near[w]), int(n[b]), words[b])):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(rows, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                names=["word", "near", "best_n", "best"])

    return run


def near_words(words, staging, most_words=MOST_WORDS, shared=SHARED):
    """``word, n_near, best, best_n`` of the words (``word, n``; staged, of 2 * ``shared`` code points at least) that have near ones."""
    found = partitions(words, staging, most_words, shared).mapInArrow(
        _near(shared), "word string, near long, best_n long, best string")
    merged = found.groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first"))
    return merged.select("word", "n_near", F.col("first.best").alias("best"), (-F.col("first.less")).alias("best_n"))


def roots(forms, staging):
    """``word, root`` of words with a form (``word, form``): the last form reached.

    A form is more frequent than its word, so there are no circles; each step doubles the way.
    """
    now = staging.table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        met = staging.table(now.join(bounded(ahead), "root", "left"), "roots")
        if met.filter("beyond is not null").isEmpty():
            return now
        now = staging.table(met.select("word", F.coalesce("beyond", "root").alias("root")), "roots")


def variants(documents, least_length=LEAST_LENGTH, least_count=LEAST_COUNT, ratio=RATIO, drop_one_in=DROP_ONE_IN,
             most_words=MOST_WORDS, staging=None):
    """``word, form, root, n, n_near, form_n`` of every word.

    ``least_length`` must be at least twice ``SHARED``, or pairs could be missed. One run in ``drop_one_in`` loses a
    code point, chosen by a hash of document and run.
    """
    if least_length < 2 * SHARED:
        raise ValueError(f"words need at least {2 * SHARED} code points")
    staging = staging or Staging(documents.sparkSession)
    words = staging.table(vocabulary(documents, least_length, least_count, drop_one_in), "words")
    near = near_words(words, staging, most_words)
    joined = words.join(near, "word", "left")
    better = F.col("best_n") >= ratio * F.col("n")
    judged = staging.table(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(better, F.col("best")).alias("form"),
        F.when(better, F.col("best_n")).alias("form_n")), "judged")
    ends = roots(judged.filter("form is not null"), staging)
    return judged.join(bounded(ends), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
