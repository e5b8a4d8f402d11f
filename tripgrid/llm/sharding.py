"""Shards by a hierarchical weighted hash tree: region, rack, shard.

Every key has a stream of attempts in time. An attempt descends the tree: a first draw names a region,
a second one a rack of it, a third one a shard of that rack, and a last one is accepted in proportion
to the shard's weight. The first attempt to be accepted places the key. Draws on each level run over
the *room* there (``RACKS`` racks a region, ``SHARDS`` shards a rack), not over what is used of it,
so an attempt never changes; only whether it is accepted does, and that depends on its shard's weight
alone. If a weight grows, keys move only into that shard; if it falls, only out of it; a new shard
takes keys only into itself. A shard wins in proportion to its weight.

So that any number of regions and any weight have room, regions are taken in blocks that double
(0, 1, 2-3, 4-7, ...) and weights in layers that double (up to 1, 1-2, 2-4, ...). Each block of a layer
is a Poisson process of attempts, faster the larger it is, and the earliest accepted attempt of all
of them counts. The work for a key follows the tree's depth and the logarithm of its width: a tree of
10,000 shards costs some tens of attempts, done by column in the task that reads the rows.

A shard's place is its position in the tree: weight 0 takes it out without moving others. Weights
far below 1 waste attempts; they should be of the order of 1.

Null ids are one id, null texts are empty. Repeated rows go where their id goes, and get their own
slots. An empty table gives an empty one; other columns are not looked at.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import ROW, Staging, numbered, whole_text

# The room of a region and of a rack.
RACKS, SHARDS = 2, 2
_STEP = np.uint64(0x9E3779B97F4A7C15)


def even_tree(shards):
    """``{region: {rack: {shard: weight}}}`` of equal shards, filled rack by rack."""
    tree = {}
    for shard in range(shards):
        rack = shard // SHARDS
        tree.setdefault(rack // RACKS, {}).setdefault(rack, {})[shard] = 1.0
    return tree


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(x):
    """Numbers between 0 and 1, neither included, from 64 random bits."""
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) / float(1 << 52)


def _doubling(end):
    """``(from, to)`` of the intervals 0-1, 1-2, 2-4, ... that cover what lies below ``end``."""
    at, to = 0, 1
    while at < end:
        yield at, to
        at, to = to, 2 * to


class HashTree:
    """A tree's weights by region, rack and shard, and the descent of keys."""

    def __init__(self, tree, racks=RACKS, shards=SHARDS):
        if any(len(r) > racks or any(len(s) > shards for s in r.values()) for r in tree.values()):
            raise ValueError(f"a region has room for {racks} racks and a rack for {shards} shards")
        self.weights = np.zeros((len(tree), racks, shards))
        self.names = np.full((len(tree), racks, shards, 3), -1, np.int64)
        for i, (region, below) in enumerate(tree.items()):
            for j, (rack, leaves) in enumerate(below.items()):
                for k, (shard, weight) in enumerate(leaves.items()):
                    self.weights[i, j, k], self.names[i, j, k] = max(weight, 0), (region, rack, shard)
        if not self.weights.any():
            raise ValueError("the tree has no shard with a positive weight")

    def descend(self, keys):
        """Region, rack and shard (as rows) of keys, which are 64-bit hashes."""
        regions, racks, shards = self.weights.shape
        keys = keys.view(np.uint64)
        best, place = np.full(len(keys), np.inf), np.zeros((len(keys), 3), np.int64)
        for low, high in _doubling(self.weights.max()):
            for first, last in _doubling(regions):
                accepted = np.zeros((last - first, racks, shards))
                used = self.weights[first:last]
                accepted[:len(used)] = np.clip((used - low) / (high - low), 0, 1)
                if accepted.any():
                    rate = float((high - low) * accepted.size)
                    salt = _mixed(np.array([(low << 32) + first + 1], np.uint64))
                    self._attempts(_mixed(keys ^ salt), rate, first, accepted, best, place)
        return self.names[tuple(place.T)]

    @staticmethod
    def _attempts(stream, rate, first, accepted, best, place):
        """Attempts of one process until each key has one accepted, or is later than its best so far."""
        at, time = np.arange(len(stream)), np.zeros(len(stream))
        while len(at):
            draws = []
            for _ in range(5):
                stream = stream + _STEP
                draws.append(_unit(_mixed(stream)))
            time = time - np.log(draws[0]) / rate
            # Down the levels: a region of the block, a rack of it, a shard of the rack, and its weight.
            node = tuple((u * room).astype(np.int64) for u, room in zip(draws[1:4], accepted.shape))
            early = time < best[at]
            hit = early & (draws[4] < accepted[node])
            best[at[hit]] = time[hit]
            place[at[hit]] = np.stack(node, axis=1)[hit] + np.array([first, 0, 0])
            again = early & ~hit
            at, time, stream = at[again], time[again], stream[again]


def _key(column, seed):
    return F.xxhash64(F.lit(seed), F.coalesce(column.cast("string"), F.lit("")))


def placed(key, tree, seed=0, racks=RACKS, shards=SHARDS):
    """``struct(region, rack, shard)`` that the key descends to; weights of 0 or less take nothing.

    ``racks`` and ``shards`` are the room of a region and of a rack; another room places all keys anew.
    """
    nodes = HashTree(tree, racks, shards)

    @F.arrow_udf("struct<region:int,rack:int,shard:int>")
    def descend(keys: pa.Array) -> pa.Array:
        found = nodes.descend(keys.to_numpy(zero_copy_only=False)).astype(np.int32)
        return pa.StructArray.from_arrays([pa.array(found[:, n]) for n in range(3)], ["region", "rack", "shard"])

    return descend(_key(key, seed))


def shard_documents(documents, tree=None, seed=0):
    """The documents with ``region, rack, shard`` added (replacing columns of these names)."""
    at = placed(F.col("doc_id"), tree or even_tree(8), seed)
    kept = [c for c in documents.columns if c not in ("region", "rack", "shard")]
    return documents.select(*[F.col(f"`{c}`") for c in kept], at.alias("_at")).select(
        *[F.col(f"`{c}`") for c in kept], "_at.region", "_at.rack", "_at.shard")


def shard_table(documents, shards=8, seed=0, staging=None):
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, region, rack`` of every document.

    Size is the text's UTF-8 bytes plus 1; slots number each shard's rows without a gap.
    """
    staging = staging or Staging(documents.sparkSession)
    text = whole_text(F.col("text"))
    thin = documents.select(
        F.monotonically_increasing_id().alias(ROW), "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    at = thin.withColumn("_at", placed(F.col("doc_id"), even_tree(shards), seed)).withColumn(
        "_grown", placed(F.col("doc_id"), even_tree(shards + 1), seed))
    rows = at.select(ROW, "doc_id", "size", "text_crc32", "_at.region", "_at.rack", "_at.shard",
                     F.col("_grown.shard").alias("grown_shard"))
    rows = numbered(staging.table(rows, "placed"), ["shard"], "slot")
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "region", "rack")
