"""Merkle manifest of a data set in a van Emde Boas layout.

Every row is a leaf: a hash of its columns. Leaves of a source are ordered, and while several nodes
remain every ``FAN`` consecutive ones become their hash; what remains is the source's subroot. The
subroots, in the order of the sources, form one more tree of the same kind, whose root stands for all
rows.

Layout: the levels of a tree are split at half height (the lower part has the next power of two), the
upper part is stored first, then each of the aligned subtrees below it, all by the same rule. So a
subtree of any height that the rule cuts is one run of addresses, whatever the block size of the
store. Only the last node of a level can have fewer children, so an address follows from the leaf
count, the level and the index by arithmetic (``address``). The recursion ends at blocks of two levels, a node
and its children, at consecutive addresses; a block is one row here.

* Construction recurses over block roots: leaves are grouped into blocks, the roots of ``FAN ** 2``
  blocks into a block of the next two levels, and so on. Groups are bounded, a hot source has more.
* Siblings are fetched the same way downwards: each block computes the addresses of the blocks below
  it and hands each the siblings on its way to the root. Leaves take theirs from their own block, so
  proofs, the longest things here, are made where they are hashed and never shuffled.
* ``nodes`` is the manifest itself, one row per node, written in address order by ``write``; ``proofs``
  asks it for the siblings of some leaves by address alone.

Rows are numbered within their source by one global sort whose keys are unique, so a source with any
share of the rows spreads over tasks. Null values hash as ``-``; a null source comes first and is a
source of its own, null ids come first in their source. Repeated rows are leaves of their own, next
to each other. An empty table has no leaves, no root and no result rows. Columns that are not hashed
are not looked at, whatever their names.
"""

from functools import reduce

from pyspark.sql import functions as F

from ..operators import ranked
from .common import ROW, Staging, bounded

FAN, BITS = 16, 4
HASHED = ("doc_id", "source", "lang", "n_chars", "text")
# Trees of this many levels hold FAN ** 14 leaves, more than a row number can count.
MOST_LEVELS = 15
_PATH = "array<struct<left:string,right:string>>"


# Leaves

def leaf_hash(*columns):
    """Lower-case hex SHA-256 of some columns: of each its UTF-8 byte count, ``:`` and value; null is ``-``."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(
        F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


# Layout

def _lower(levels):
    """Levels of the lower part: the least power of two that is at least half."""
    part = 1
    while 2 * part < levels:
        part *= 2
    return part


def _full(levels):
    return (FAN ** levels - 1) // (FAN - 1)


def _wide(n, level):
    """How many nodes a level has above ``n`` leaves."""
    return F.shiftright(n + (FAN ** level - 1), BITS * level)


def levels_of(n):
    """How many levels a tree of ``n`` leaves has, the leaves' own included."""
    return reduce(lambda known, m: F.when(n <= FAN ** (m - 1), m).otherwise(known), range(MOST_LEVELS - 1, 0, -1), F.lit(MOST_LEVELS))


def _place(n, level, index, levels):
    """Address in a tree of a known number of levels."""
    low, high, root, at = 0, levels - 1, F.lit(0).cast("long"), F.lit(0).cast("long")
    while high > low:
        middle = low + _lower(high - low + 1)
        if level >= middle:
            low = middle
            continue
        mine = F.shiftright(index, BITS * (middle - 1 - level))
        first = F.shiftleft(root, BITS * (high - middle + 1))
        for x in range(middle, high + 1):
            # The last subtree of a level may end early.
            room = FAN ** (high - x)
            at = at + F.least(F.greatest(_wide(n, x) - F.shiftleft(root, BITS * (high - x)), F.lit(0)), F.lit(room))
        at = at + (mine - first) * _full(middle - low)
        root, high = mine, middle - 1
    return at


def address(n, level, index, most=MOST_LEVELS):
    """Where node ``index`` of a level lies in the layout of a tree of ``n`` leaves (columns; the level is a number).

    ``most`` is a bound of the trees' levels, if a lower one is known.
    """
    known = levels_of(n)
    found = F.lit(None).cast("long")
    for levels in range(level + 1, most + 1):
        found = F.when(known == levels, _place(n, level, index, levels)).otherwise(found)
    return found


# Construction

def _joined(hashes):
    return F.sha2(F.array_join(hashes, ""), 256)


def _runs(hashes):
    """Hashes of every ``FAN`` consecutive entries of an array."""
    starts = F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / FAN).cast("int"))
    return F.transform(starts, lambda i: _joined(F.slice(hashes, i * FAN + 1, FAN)))


class Forest:
    """Trees over ``leaves`` (``tree, n, index, digest`` and other columns; staged): blocks of two levels by round.

    ``rounds[r]`` holds the blocks of levels ``2r`` and ``2r + 1``: ``tree, n, block, below, children, root, top,
    address``. ``below`` has the entries the block was made of (leaves as structs with their other
    columns, or roots of blocks), ``top`` says that ``root`` is the tree's.
    """

    def __init__(self, leaves, staging, label):
        self.leaves, self.rounds = leaves, []
        most = leaves.agg(F.max("n")).first()[0] or 0
        self.levels = next(m for m in range(1, MOST_LEVELS + 1) if FAN ** (m - 1) >= most)
        other = [c for c in leaves.columns if c not in ("tree", "n")]
        entries = leaves.select("tree", "n", "index", F.struct("index", *[c for c in other if c != "index"]).alias("entry"))
        for r in range((self.levels + 1) // 2):
            width = BITS if r == 0 else 2 * BITS
            grouped = entries.groupBy("tree", "n", F.shiftright("index", width).alias("block")).agg(
                F.sort_array(F.collect_list("entry")).alias("below"))
            digests = F.transform("below", lambda e: e["digest"])
            blocks = grouped.withColumn("children", digests if r == 0 else _runs(digests))
            single = _wide(F.col("n"), 2 * r) == 1
            blocks = blocks.select(
                "tree", "n", "block", "below", "children",
                F.when(single, F.get("children", F.lit(0))).otherwise(_joined(F.col("children"))).alias("root"),
                (single | (_wide(F.col("n"), 2 * r + 1) == 1)).alias("top"), single.alias("single"),
                F.when(single, address(F.col("n"), 2 * r, F.col("block"), self.levels)).otherwise(
                    address(F.col("n"), 2 * r + 1, F.col("block"), self.levels)).alias("address"))
            self.rounds.append(staging.table(blocks, f"{label}{r}"))
            entries = self.rounds[-1].filter("not top").select(
                "tree", "n", F.col("block").alias("index"), F.struct(F.col("block").alias("index"), F.col("root").alias("digest")).alias("entry"))

    def roots(self):
        """``tree, n, digest`` of every tree."""
        tops = [r.filter("top").select("tree", "n", F.col("root").alias("digest")) for r in self.rounds]
        return reduce(lambda a, b: a.unionByName(b), tops)

    def nodes(self):
        """``tree, n, level, index, address, digest`` of every node."""
        parts = []
        for r, blocks in enumerate(self.rounds):
            inner = blocks.filter("not single").select(
                "tree", "n", F.lit(2 * r + 1).alias("level"), F.col("block").alias("index"), "address", F.col("root").alias("digest"))
            outer = blocks.select("tree", "n", F.lit(2 * r).alias("level"), "block", "address", "single", F.posexplode("children").alias("i", "digest"))
            parts += [inner, outer.select(
                "tree", "n", "level", (F.col("block") * FAN + F.col("i")).alias("index"),
                # A block's children follow its root.
                F.when(F.col("single"), F.col("address")).otherwise(F.col("address") + 1 + F.col("i")).alias("address"), "digest")]
        return reduce(lambda a, b: a.unionByName(b), parts)

    def paths(self, above, staging, label):
        """Leaves with ``path``, the siblings on their way up as ``(left, right)``, and the columns of ``above``.

        ``above`` has ``tree``, ``path`` (how a tree's root goes on) and other columns, which go along.
        """
        carried = [c for c in above.columns if c not in ("tree", "path")]
        down = None
        for r in range(len(self.rounds) - 1, -1, -1):
            blocks = self.rounds[r]
            met = blocks.filter("top").join(bounded(above), "tree").select(*blocks.columns, "path", *carried)
            if down is not None:
                inside = blocks.filter("not top").join(down, ["tree", "address"]).select(*blocks.columns, "path", *carried)
                met = met.unionByName(inside)
            one = F.array(_beside(F.col("children"), F.col("i") if r == 0 else F.floor(F.col("i") / FAN).cast("int")))
            up = F.when(F.col("single"), F.col("path")).otherwise(F.concat(one, F.col("path")))
            each = met.select("tree", "n", "block", "below", "children", "single", "path", *carried, F.posexplode("below").alias("i", "entry"))
            if r == 0:
                return each.select("tree", "n", up.alias("path"), *carried, "entry.*")
            # Siblings of the block below among the roots that share its parent.
            run = F.slice("below", F.floor(F.col("i") / FAN).cast("int") * FAN + 1, FAN)
            beside = _beside(F.transform(run, lambda e: e["digest"]), F.col("i") % FAN)
            index = F.col("block") * FAN * FAN + F.col("i")
            down = staging.table(each.select(
                "tree", address(F.col("n"), 2 * r - 1, index, self.levels).alias("address"),
                F.concat(F.array(beside), up).alias("path"), *carried), f"{label}{r}")
        raise AssertionError("a forest has at least one round")


def _beside(hashes, i):
    """What stands left and right of entry ``i`` (from 0), each joined."""
    return F.struct(F.array_join(F.slice(hashes, F.lit(1), i), "").alias("left"),
                    F.array_join(F.slice(hashes, i + 2, F.lit(FAN)), "").alias("right"))


def fold(leaf, path):
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, p: F.sha2(F.concat(p["left"], node, p["right"]), 256))


def proof_hash(path):
    """Hash of all siblings, level by level, from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


class Manifest:
    """Trees of all sources and the tree above them.

    ``leaves`` (``source, doc_id, digest`` and other columns) are numbered and built; ``root`` is the data
    set's digest, null for an empty one.
    """

    def __init__(self, leaves, staging):
        self.staging = staging
        other = [c for c in leaves.columns if c not in ("source", "doc_id", "digest")]
        rows = staging.table(leaves.select(
            F.col("source").isNotNull().cast("int").alias("known"), F.coalesce("source", F.lit("")).alias("source"),
            "doc_id", "digest", *other, F.monotonically_increasing_id().alias(ROW)), "leaves")
        placed = ranked(rows, staging, ["known", "source"], ["doc_id", "digest", ROW], "place")
        counts = staging.table(rows.groupBy("known", "source").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.lit(0)), "counts")
        trees = ranked(counts, staging, ["all"], ["known", "source"], "tree").select(
            "known", "source", "n", (F.col("tree") - 1).alias("tree"))
        self.trees = staging.table(trees, "trees")
        leaves = placed.join(bounded(self.trees), ["known", "source"]).select(
            "tree", "n", (F.col("place") - 1).alias("index"), "doc_id", "digest", *other)
        self.sources = Forest(staging.table(leaves, "placed"), staging, "blocks")
        total = self.trees.count()
        subroots = self.sources.roots().select(
            F.lit(0).cast("long").alias("tree"), F.lit(total).cast("long").alias("n"), F.col("tree").alias("index"), "digest")
        self.top = Forest(staging.table(subroots, "subroots"), staging, "top")
        first = self.top.roots().first()
        self.root = first["digest"] if first else None

    def proven(self):
        """Leaves with ``subroot`` and ``path`` up to the root."""
        end = self.staging.spark.createDataFrame([(0, [])], f"tree long, path {_PATH}")
        subroots = self.top.paths(end, self.staging, "top_down").select(
            F.col("index").alias("tree"), F.col("digest").alias("subroot"), "path")
        return self.sources.paths(self.staging.table(subroots, "above"), self.staging, "down")

    def nodes(self):
        """All nodes of the sources' trees, and of the tree above them as tree -1."""
        return self.sources.nodes().unionByName(self.top.nodes().withColumn("tree", F.lit(-1).cast("long")))

    def write(self, path):
        """The manifest in address order, so that a subtree's nodes lie in one or few row groups."""
        self.nodes().repartitionByRange("tree", "address").sortWithinPartitions("tree", "address").write.parquet(path)


def proofs(nodes, asked, most=MOST_LEVELS):
    """Siblings of some nodes' ways up their trees, by address: ``tree, leaf, level, index, digest``.

    ``nodes`` is a manifest; ``asked`` has ``tree, n, leaf`` (an index among the ``n`` leaves of a tree).
    """
    def run(level):
        first = F.shiftleft(F.shiftright("leaf", BITS * (level + 1)), BITS)
        return F.transform(F.sequence(F.lit(0), F.lit(FAN - 1)), lambda i: F.struct(
            F.lit(level).alias("level"), (first + i).alias("index")))

    ways = [run(level) for level in range(most - 1)]
    wide = F.coalesce(*[F.when(F.col("level") == x, _wide(F.col("n"), x)) for x in range(most - 1)])
    own = F.coalesce(*[F.when(F.col("level") == x, F.shiftright("leaf", BITS * x)) for x in range(most - 1)])
    wanted = asked.select("tree", "n", "leaf", F.explode(F.flatten(F.array(*ways))).alias("w")).select(
        "tree", "n", "leaf", "w.*").filter((F.col("index") < wide) & (F.col("index") != own))
    at = F.coalesce(*[F.when(F.col("level") == x, address(F.col("n"), x, F.col("index"), most)) for x in range(most - 1)])
    return wanted.withColumn("address", at).join(
        nodes.select("tree", "address", "digest"), ["tree", "address"]).select("tree", "leaf", "level", "index", "digest")


def tampered(doc_id, one_in=5):
    """Which rows the drill tampers with: those whose id's CRC-32 ``one_in`` divides."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % one_in == 0, F.lit(False))


def verified_rows(documents, one_in=5, staging=None):
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every document.

    The tampering drill lower-cases A-Z in the texts of some rows; what a row then hashes to is folded
    with the original siblings and must equal the root. Rows whose text has no A-Z stay verified.
    """
    staging = staging or Staging(documents.sparkSession)
    hashed = [F.col(c) for c in HASHED]
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    now = F.when(tampered(F.col("doc_id"), one_in), leaf_hash(*hashed[:-1], small))
    manifest = Manifest(documents.select("source", "doc_id", leaf_hash(*hashed).alias("digest"), now.alias("now")), staging)
    rows = manifest.proven()
    folded = fold(F.coalesce("now", "digest"), F.col("path"))
    root = F.lit(manifest.root).cast("string")
    return rows.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), proof_hash(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
