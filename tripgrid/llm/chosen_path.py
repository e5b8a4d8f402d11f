"""N-gram Jaccard join by chosen paths.

Documents are sets of word shingles (five words; a text of fewer, but not none, is one shingle).
Texts with the same set are copies and form one class at once; the join runs over classes, so a group
of copies of any size costs one row.

1. Embed: each set as ``SKETCH`` minwise hashes. Its tokens are pairs of place and value; two sets of
   similarity ``s`` share a token with probability ``s``.
2. Split: in each run a node samples one place, sometimes two (1.25 on average, 1 / 0.8), and hands
   each class to the child of its token there. A node is split again while it is large and sizes
   fall. One that keeps half of its parent is judged by its sketches: a tight one, whose
   classes agree in ``TIGHT`` of their places on average, holds near copies and is a leaf. A loose
   one holds texts that share a template, which sampled tokens part only slowly; its classes split on
   all their tokens at once, and each of these nodes is small, or tight, or a token of the
   template, which is left. So texts of a template that are not similar never meet all against all;
   similar ones share tokens outside it. Classes with fewer than ``OWN`` tokens outside could be missed
   that way, so they are split further by sampled tokens as well, up to ``DEEPEST`` levels.
   Classes alone in a node are done.
3. Repeat: runs are added until a pair at the threshold shares a leaf with the wanted probability,
   whatever depth the nodes reached. All runs look at the same sketches, so the chance of a miss is
   summed over the number of places in which the two sketches agree.
4. Brute force in the leaves, in squares of blocks where a leaf is large, so no task holds more than
   two blocks. Sketches (one byte of each hash) and sizes find candidate pairs; classes that have one get
   their shingles (from a second look at the texts), and similarity is computed exactly. A pair that shares several
   leaves counts in the first one only, so links are counted without listing pairs: what leaves a leaf
   is one row per class, with its number of links and the smallest class it is connected to there.
5. Connect the classes by star contraction.

Documents without words have no links and are their own class. Repeated rows are copies. Null ids
are kept as they are; a class whose ids are all null has a null id.
"""

import re
from functools import reduce
from hashlib import blake2b
from math import comb
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import Staging, bounded, matching

SHINGLE, THRESHOLD, RECALL = 5, 0.8, 0.9999
SKETCH = 64
# A leaf up to this size is compared in one task; also the size of blocks of larger ones.
LEAF = 512
DEEPEST = 12
LEAST_RUNS = 10
# The share of nodes that sample a second place.
TWICE = 0.25
# Large nodes are judged by about so many of their classes. Below this mean agreement they are loose:
# similar texts then share a token outside the template, unless they have few of these (miss: 2 in 100,000 with OWN).
JUDGED, TIGHT, OWN = 512, 0.6, 16
# Sketches of a pair at the threshold agree in fewer places with a chance below one in a million.
AGREE = 33

_SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Words with their capitals, which are made small where a word is hashed.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(1, 1 << 63, SHINGLE, np.uint64) | np.uint64(1)
_PLACES = _rng.integers(1, 1 << 63, SKETCH, np.uint64) | np.uint64(1)


class _Hashes(dict):
    """64-bit hashes of words with A-Z made small, remembered up to a bound."""

    def __missing__(self, word):
        if len(self) > 1 << 19:
            self.clear()
        h = int.from_bytes(blake2b(word.translate(_SMALL).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        self[word] = h
        return h


def shingle_set(text, hashes):
    """Sorted distinct 64-bit hashes of a text's shingles."""
    found = _WORD.findall(text)
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    if not len(h):
        return h
    if len(h) < SHINGLE:
        whole = blake2b(h.tobytes(), digest_size=8).digest()
        return np.frombuffer(whole, np.uint64)
    n = len(h) - SHINGLE + 1
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        total = (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[k:k + n] * _FACTORS[k]
    return np.unique(total ^ (total >> np.uint64(32)))


def _sketch(shingles):
    """``SKETCH`` minwise hashes of 32 bits."""
    least = np.full(SKETCH, ~np.uint64(0))
    for at in range(0, len(shingles), 512):
        part = _PLACES[:, None] * shingles[None, at:at + 512]
        part ^= part >> np.uint64(31)
        part *= np.uint64(0x94D049BB133111EB)
        least = np.minimum(least, part.min(axis=1))
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _key(shingles):
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def _sets(batches):
    hashes = _Hashes()
    for batch in batches:
        keys, sizes, sketches = [], [], []
        for text in batch.column(1):
            s = shingle_set(text.as_py() or "", hashes)
            keys.append(_key(s) if len(s) else None)
            sizes.append(len(s))
            sketches.append(_sketch(s) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()),
             pa.array(sketches, pa.list_(pa.int32()))],
            names=["doc_id", "text_hash", "key", "n_shingles", "sketch"])


def _shingles(batches):
    hashes = _Hashes()
    for batch in batches:
        keys, sets = [], []
        for text in batch.column(0):
            s = shingle_set(text.as_py() or "", hashes)
            keys.append(_key(s) if len(s) else None)
            sets.append(s.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["key", "shingles"])


# Splitting

def missed(depth, runs, threshold=THRESHOLD):
    """Chance that a pair at the threshold shares no leaf of this depth, or fails the test of ``AGREE``."""
    total, twice = 0, TWICE * (SKETCH - 1) / SKETCH
    for agreeing in range(SKETCH + 1):
        together, same = 1, agreeing / SKETCH
        for _ in range(depth):
            together = (1 - twice) * same * together + twice * (1 - (1 - same * together) ** 2)
        chance = comb(SKETCH, agreeing) * threshold ** agreeing * (1 - threshold) ** (SKETCH - agreeing)
        total += chance * ((1 - together) ** runs if agreeing >= AGREE else 1)
    return total


def runs_for(depth, threshold=THRESHOLD, recall=RECALL):
    """Runs after which a pair at the threshold shares a leaf of this depth with probability ``recall``."""
    if missed(0, 1, threshold) > 1 - recall:
        raise ValueError(f"no number of runs finds pairs of similarity {threshold} with probability {recall}")
    runs = LEAST_RUNS
    while missed(depth, runs, threshold) > 1 - recall:
        runs += 1
    return runs


def _children(rows, depth):
    """Rows one level down: ``rows`` have ``run, node, above, key, sketch``."""
    node = F.col("node")
    place = [F.pmod(F.xxhash64(node, F.lit(i)), F.lit(SKETCH)).cast("int") for i in (1, 2)]
    if depth == 0:
        # The places of the roots are spread over the sketch.
        place = [(F.col("run") % SKETCH).cast("int"), ((F.col("run") + SKETCH // 2) % SKETCH).cast("int")]
    twice = F.pmod(F.xxhash64(node, F.lit(3)), F.lit(round(1 / TWICE))) == 0
    child = [F.xxhash64(node, p, F.get("sketch", p)) for p in place]
    return rows.select("run", "key", "above", F.explode(
        F.when(twice & (place[0] != place[1]), F.array(*child)).otherwise(F.array(child[0]))).alias("child"))


def _sketched(rows, classes, staging):
    """Rows (``run, key, node, above``) with their class's sketch. A class meets its sketch once, however many rows it has."""
    each = rows.groupBy("key").agg(F.collect_list(F.struct("run", "node", "above")).alias("rows"))
    # Few classes go on, so they go to the sketches where they can.
    return classes.select("key", "sketch").join(bounded(staging.table(each, "further")), "key").select("key", "sketch", F.inline("rows"))


def _judged(rows, nodes, classes, staging):
    """``node, tight`` of nodes (``node, size``; staged), whose classes are ``rows`` (``node, key``).

    Tight: the mean share of places in which two classes of the node agree, over a bounded number of random pairs.
    It decides where a node's pairs are looked for, not whether; a node without a pair drawn is tight.
    """
    # The draw is part of the join, so no node yields more than its share of rows.
    draw = F.xxhash64("key", "node")
    some = rows.withColumnRenamed("node", "_node").withColumn("draw", F.xxhash64("key", "_node")).join(
        bounded(nodes), (F.col("_node") == F.col("node")) & (F.pmod("draw", "size") < JUDGED))
    some = classes.select("key", "sketch").join(bounded(staging.table(some.select("node", "key"), "drawn")), "key")
    # Neighbours by hash are pairs drawn at random.
    other = F.lag("sketch").over(Window.partitionBy("node").orderBy(draw, "key"))
    agree = F.size(F.filter(F.zip_with("sketch", "other", lambda x, y: x == y), lambda same: same)) / SKETCH
    pairs = some.withColumn("other", other).filter("other is not null")
    means = pairs.groupBy("node").agg(F.avg(agree).alias("agree"))
    tight = F.coalesce(F.col("agree") >= TIGHT, F.lit(True))
    return staging.table(nodes.join(means, "node", "left").select("node", tight.alias("tight")), "judged")


def _spread(loose, classes, staging, batch):
    """Split classes of loose nodes (``key``) on all their tokens: leaves (``leaf, key, size``), and the keys to split further."""
    tokens = classes.select("key", "sketch").join(bounded(loose), "key").select("key", F.posexplode("sketch").alias("place", "value"))
    tokens = staging.table(tokens.select("key", F.xxhash64(F.lit("token"), F.lit(batch), "place", "value").alias("node")), "tokens")
    sizes = staging.table(tokens.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "token_sizes")
    small = tokens.join(sizes.filter(F.col("size") <= LEAF), "node")
    # Tokens of a template are few; whatever shares one meets it here without a shuffle.
    hubs = sizes.filter(F.col("size") > LEAF)
    large = staging.table(tokens.join(bounded(hubs), "node"), "large_tokens")
    tight = _judged(large.select("node", "key"), hubs, classes, staging).filter("tight").select("node")
    both = small.unionByName(large.join(bounded(tight), "node", "left_semi").select(*small.columns))
    few = large.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SKETCH - OWN).select("key")
    return both.select(F.col("node").alias("leaf"), "key", "size"), staging.table(few, "few_own")


def _descend(rows, level, classes, staging, further):
    """Split ``rows`` (``run, key, sketch, node, above``) down to leaves.

    Returns leaves (``leaf, key, size``), rows of loose nodes (``run, key, node, above``), and the depth reached. Loose
    nodes are split like others if ``further``.
    """
    found, loose = [], []
    while True:
        split = staging.table(_children(rows, level), f"level{level}")
        level += 1
        sizes = staging.table(split.groupBy("child").agg(
            F.count(F.lit(1)).alias("size"), F.any_value("above").alias("above")).filter("size > 1"), f"sizes{level}")
        # Nodes are judged among themselves, so that rows meet one table only: null is to be split, else a leaf or loose.
        last = level >= DEEPEST
        stuck = (F.col("size") > LEAF) & (F.lit(last) | F.coalesce(2 * F.col("size") >= F.col("above"), F.lit(False)))
        met = sizes.filter(stuck).select(F.col("child").alias("node"), "size")
        tight = F.lit(None).cast("boolean")
        if last and further:
            tight = F.lit(True)
        elif not met.isEmpty():
            judged = _judged(split.select(F.col("child").alias("node"), "key"), met, classes, staging)
            sizes = sizes.join(bounded(judged.withColumnRenamed("node", "child")), "child", "left")
            tight = F.col("tight")
        sizes = sizes.select("child", "size", tight.alias("tight"))
        nodes = staging.table(split.drop("above").join(bounded(sizes), "child"), f"nodes{level}")
        found.append(nodes.filter((F.col("size") <= LEAF) | F.col("tight")).select(F.col("child").alias("leaf"), "key", "size"))
        large = nodes.filter(F.col("size") > LEAF).select(
            "run", "key", F.col("child").alias("node"), F.col("size").alias("above"), "tight")
        if last and further:
            return found, loose, level
        rest = large.filter("tight is null").drop("tight")
        if not met.isEmpty():
            slow = large.filter("not tight").drop("tight")
            if further:
                rest = rest.unionByName(slow)
            else:
                loose.append(slow)
        if rest.isEmpty():
            return found, loose, level
        rows = _sketched(rest, classes, staging)


def leaves(classes, staging, threshold=THRESHOLD, recall=RECALL):
    """Leaves of all runs: ``leaf, key, blocks``; those with one class only are left out."""
    kept, staging = staging, Staging(classes.sparkSession)
    found, runs, wanted, depth = [], 0, runs_for(2, threshold, recall), 0
    while runs < wanted:
        rows = classes.select("key", "sketch", F.explode(F.array(*map(F.lit, range(runs, wanted)))).alias("run"))
        rows = rows.withColumn("node", F.xxhash64(F.lit("root"), "run")).withColumn("above", F.lit(None).cast("long"))
        more, loose, level = _descend(rows, 0, classes, staging, False)
        found += more
        if loose:
            loose = staging.table(reduce(DataFrame.unionByName, loose), "loose")
            spread, few = _spread(staging.table(loose.select("key").distinct(), "loose_keys"), classes, staging, runs)
            found.append(spread)
            rest = staging.table(loose.join(bounded(few), "key", "left_semi"), "rest")
            if not rest.isEmpty():
                more, _, level = _descend(_sketched(rest, classes, staging), level, classes, staging, True)
                found += more
        depth = max(depth, level)
        runs, wanted = wanted, max(wanted, runs_for(depth, threshold, recall))
    union = reduce(DataFrame.unionByName, found)
    blocks = F.ceil(F.col("size") / LEAF).cast("int")
    out = kept.table(union.select("leaf", "key", blocks.alias("blocks")).distinct(), "leaves")
    staging.remove()
    return out


# Leaves

def _candidates(sketches, sizes, blocks, paths, leaf, threshold):
    """For each class the later ones it must be compared with here, as ``(i, array of j)``."""
    m = len(sizes)
    earlier = [p[p < leaf] for p in paths]
    number = {v: n for n, v in enumerate(np.unique(np.concatenate(earlier)).tolist())}
    shared = np.zeros((m, len(number)), np.float32)
    for i, p in enumerate(earlier):
        shared[i, [number[v] for v in p.tolist()]] = 1
    square = blocks.max() != blocks.min()
    for i in range(m - 1):
        later = np.arange(i + 1, m)
        small, big = np.minimum(sizes[i], sizes[later]), np.maximum(sizes[i], sizes[later])
        fit = small >= threshold * big
        if square:
            fit &= blocks[later] != blocks[i]
        later = later[fit]
        if len(later):
            later = later[(sketches[later] == sketches[i]).sum(axis=1) >= AGREE]
        if len(later) and shared.shape[1]:
            later = later[shared[later] @ shared[i] == 0]
        if len(later):
            yield i, later


def _groups(batch):
    """Leaves of a batch as dictionaries of numpy columns."""
    members = batch.column("members")
    flat, offsets = members.flatten(), members.offsets.to_numpy()
    offsets = offsets - offsets[0]
    columns = {name: flat.field(name) for name in (f.name for f in flat.type)}

    def lists(name, at, end):
        part = columns[name].slice(at, end - at)
        values, places = part.flatten().to_numpy(zero_copy_only=False), part.offsets.to_numpy()
        return np.split(values, (places - places[0])[1:-1])

    for row, leaf in enumerate(batch.column("leaf").to_pylist()):
        at, end = int(offsets[row]), int(offsets[row + 1])
        if end - at < 2:
            continue
        one = {name: columns[name].slice(at, end - at).to_numpy(zero_copy_only=False)
               for name in ("n_shingles", "block", "copies") if name in columns}
        one |= {name: lists(name, at, end) for name in ("sketch", "paths", "shingles") if name in columns}
        one["key"] = columns["key"].slice(at, end - at).to_pylist()
        yield row, leaf, one


def _pairs(leaf, group, threshold):
    sketches = np.stack(group["sketch"])
    return _candidates(sketches, group["n_shingles"].astype(np.int64), group["block"], group["paths"], leaf, threshold)


def _needed(threshold):
    """Which classes have a candidate in a leaf."""
    def run(batches):
        for batch in batches:
            rows, keys, blocks = [], [], []
            for row, leaf, group in _groups(batch):
                need = set()
                for i, later in _pairs(leaf, group, threshold):
                    need.add(i)
                    need.update(later.tolist())
                rows += [row] * len(need)
                keys += [group["key"][i] for i in sorted(need)]
                blocks += [int(group["block"][i]) for i in sorted(need)]
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n).take(at) for n in ("leaf", "a", "b")), pa.array(keys, pa.binary()),
                 pa.array(blocks, pa.int32())],
                names=["leaf", "a", "b", "key", "block"])

    return run


def _linked(threshold):
    """Links of each class in a leaf: ``key, root, links``, the root being its smallest connection."""
    def run(batches):
        for batch in batches:
            keys, roots, counts = [], [], []
            for _, leaf, group in _groups(batch):
                m, sets = len(group["key"]), group["shingles"]
                links, parent = np.zeros(m, np.int64), list(range(m))
                values, inverse = np.unique(np.concatenate(sets), return_inverse=True)
                ids = np.split(inverse.astype(np.int32), np.cumsum([len(s) for s in sets])[:-1])
                mark = np.zeros(len(values), bool)

                def top(i):
                    while parent[i] != i:
                        parent[i] = parent[parent[i]]
                        i = parent[i]
                    return i

                for i, later in _pairs(leaf, group, threshold):
                    mark[ids[i]] = True
                    lengths = np.array([len(ids[j]) for j in later])
                    hits = mark[np.concatenate([ids[j] for j in later])]
                    both = np.add.reduceat(hits, np.cumsum(lengths) - lengths, dtype=np.int64)
                    mark[ids[i]] = False
                    similar = later[both / (len(ids[i]) + lengths - both) >= threshold]
                    links[i] += group["copies"][similar].sum()
                    links[similar] += group["copies"][i]
                    for j in similar.tolist():
                        x, y = top(i), top(j)
                        if x != y:
                            low, high = (x, y) if group["key"][x] < group["key"][y] else (y, x)
                            parent[high] = low
                for i in range(m):
                    if links[i]:
                        keys.append(group["key"][i])
                        roots.append(group["key"][top(i)])
                        counts.append(int(links[i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(roots, pa.binary()), pa.array(counts, pa.int64())],
                names=["key", "root", "links"])

    return run


def _squares(rows):
    """Leaf rows once for every pair of blocks they belong to: ``leaf, a, b, block`` and the rest."""
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    return rows.withColumn("block", block).withColumn("_other", F.explode(others)).withColumn(
        "a", F.least("block", "_other")).withColumn("b", F.greatest("block", "_other")).drop("_other", "blocks")


def _gathered(rows, *columns):
    return rows.groupBy("leaf", "a", "b").agg(F.collect_list(F.struct(*columns)).alias("members"))


def components(edges, staging):
    """``key, component`` of undirected ``a, b`` edges (binary): star contraction until nothing changes.

    Each step joins nodes with their smallest neighbour. No neighbourhood is gathered in one place: the
    smallest ones are few enough to broadcast, or the edges of a hub are split over tasks by adaptive execution.
    """
    edges = staging.table(edges.filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        for large in (True, False):
            both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
            least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
            least = staging.table(least, "least")
            near = both.join(bounded(least), "a")
            if large:
                new = near.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
            else:
                new = near.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
                    least.select("a", F.col("least").alias("b")))
            edges = staging.table(new.filter("a != b").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            return edges.select(F.col("a").alias("key"), F.col("b").alias("component"))
        before = now


def jaccard_join(documents, threshold=THRESHOLD, recall=RECALL, staging=None):
    """``doc_id, class_id, n_links, n_copies, n_shingles, text_hash, shingle_set, component`` of every document.

    ``class_id`` is the smallest id among the documents connected by links; ``n_links`` counts the
    other documents of at least the threshold's similarity, ``n_copies`` those with the same shingles.
    Ids may repeat or be null, so groups can share a ``class_id``; ``component`` tells them apart. It is
    null for documents without words.
    """
    spark = documents.sparkSession
    staging = staging or Staging(spark)
    # Tables of one step only go as soon as the next one's are written.
    embedded, split, compared = Staging(spark), Staging(spark), Staging(spark)
    kind = documents.schema["doc_id"].dataType.simpleString()
    read = documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    sets = embedded.table(read.mapInArrow(
        _sets, f"doc_id {kind}, text_hash long, key binary, n_shingles int, sketch array<int>"), "sets")
    classes = split.table(sets.filter("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
        F.any_value("n_shingles").alias("n_shingles"), F.any_value("sketch").alias("sketch")), "classes")
    sets = staging.table(sets.drop("sketch"), "documents")
    embedded.remove()
    in_leaves = leaves(classes, split, threshold, recall)
    places = in_leaves.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("leaf", "blocks"))).alias("places"))
    # One byte of each hash tells candidates from others nearly as well, and never hides one.
    byte = F.transform("sketch", lambda x: F.shiftright(F.shiftleft(x, 24), 24).cast("tinyint"))
    known = compared.table(classes.withColumn("sketch", byte).join(places, "key"), "known")
    classes = staging.table(classes.select("key", "first_id", "copies"), "classes")
    split.remove()
    known = known.withColumn("paths", F.col("places.leaf"))
    first = _squares(known.select("key", "n_shingles", "sketch", "paths", F.inline("places")))
    needed = compared.table(_gathered(first, "key", "n_shingles", "block", "paths", "sketch").mapInArrow(
        _needed(threshold), "leaf long, a int, b int, key binary, block int"), "needed")
    # The shingles of classes with a candidate, from their first document.
    wanted = compared.table(known.drop("places").join(bounded(
        compared.table(needed.select("key").distinct(), "needed_keys")), "key"), "wanted")
    one_each = wanted.select(F.col("first_id").alias("_first")).distinct()
    texts = documents.select("doc_id", "text").join(
        bounded(one_each), F.col("doc_id").eqNullSafe(F.col("_first")), "left_semi").select("text")
    shingles = texts.mapInArrow(_shingles, "key binary, shingles array<long>").join(
        bounded(wanted.select("key")), "key", "left_semi").dropDuplicates(["key"])
    full = wanted.drop("first_id").join(shingles, "key").join(bounded(needed), "key")
    linked = staging.table(_gathered(full, "key", "n_shingles", "block", "paths", "sketch", "copies", "shingles").mapInArrow(
        _linked(threshold), "key binary, root binary, links long"), "linked")
    compared.remove()
    links = linked.groupBy("key").agg(F.sum("links").alias("links"))
    edges = components(linked.select(F.col("key").alias("a"), F.col("root").alias("b")), staging)
    # Only classes with links are in groups; the others are their own.
    members = edges.unionByName(edges.select(F.col("component").alias("key"), "component")).distinct()
    members = staging.table(members.join(classes.select("key", "first_id"), "key"), "members")
    ids = staging.table(members.groupBy("component").agg(F.min("first_id").alias("class_id")), "ids")
    grouped = members.join(bounded(ids), "component").select("key", "component", "class_id", F.lit(True).alias("in_group"))
    result = classes.select("key", "first_id", "copies").join(links, "key", "left").join(grouped, "key", "left")
    result = staging.table(result.select(
        "key", F.coalesce("component", "key").alias("component"),
        F.when(F.col("in_group"), F.col("class_id")).otherwise(F.col("first_id")).alias("class_id"), "copies",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "result")
    has_words = F.col("key").isNotNull()
    return sets.join(result, "key", "left").select(
        "doc_id", F.when(has_words, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("copies") - 1, F.lit(0)).cast("long").alias("n_copies"),
        "n_shingles", "text_hash", F.hex("key").alias("shingle_set"),
        F.hex("component").alias("component"))


def one_of_each(documents, threshold=THRESHOLD, recall=RECALL, staging=None):
    """One document of each group of near copies, the one with the smallest id, with all its columns.

    Documents without words are in no group and stay. Of rows that share the smallest id of a group
    one stays, and so does one of a group whose ids are all null. Groups that share an id keep one each.
    """
    staging = staging or Staging(documents.sparkSession)
    judged = staging.table(jaccard_join(documents, threshold, recall, staging), "judged")
    first = judged.filter((F.col("n_shingles") > 0) & F.col("doc_id").eqNullSafe(F.col("class_id")))
    # All of a component's rows here have the same id.
    rows = first.groupBy("component").agg(
        F.min("doc_id").alias("doc_id"), F.min("text_hash").alias("text_hash"), F.count(F.lit(1)).alias("n")).drop("component")
    wordless = judged.filter("n_shingles = 0").select("doc_id", "text_hash", F.lit(1).cast("long").alias("n"))
    single = matching(documents, rows.filter("n = 1").unionByName(wordless), "left_semi")
    # Groups in which several rows have the smallest id are rare, and only these meet a second shuffle.
    shared = matching(documents, rows.filter("n > 1"), "left_semi")
    return single.unionByName(shared.dropDuplicates(["doc_id", "text"]))
