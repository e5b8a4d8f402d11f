r"""Conversations formatted for training as prefix trees.

Conversations that share their initial turns share these nodes of a tree; a tree is one sequence, in
which every node's tokens stand once, depth first. A token's position counts from the start of its own
conversation, and it attends to the intervals of the sequence that hold its ancestors, and to what
stands before it in its own node.

Template: ``<|im_start|>role\ntext<|im_end|>\n`` per turn. ``<|im_start|>`` and ``<|im_end|>`` are the ids
``start_id`` and ``end_id``, which the vocabulary does not use, so no text can forge them. In texts and
roles ``<``, backslashes and ``|`` get one backslash more, so none holds a control string. Roles also
have ``\`` and line breaks spelled out, so the first line break ends the role. Both can be undone (``parsed``).

1. A node is named by 128 bits that combine hashes of place, role and text of all turns up to it,
   taken in one window over each conversation. That is the only time all texts are shuffled.
2. Distinct nodes are tokenized once each, and counted by the conversations that pass them. Where that number
   falls, a branch begins. A node's key is the branches on its way and its depth; sorting keys is
   walking depth first. Turns that nobody shares make no branches, so keys stay short.
3. Nodes are sorted globally by key, which is unique, so a hot first turn spreads over tasks; running
   sums of tokens within tasks and a table of each task's totals give the offsets.
4. A window over each conversation turns its nodes' offsets into intervals; neighbours merge, so there
   are as many as branches on the way.

Only names, counts and offsets go through the joins of steps 2 to 4; their hot keys are split by adaptive
execution or never shuffled where the other side is small. Reading back walks from the written sequences
to each distinct conversation once, in a stream: a task holds one turn's text at a time. Copies of a
conversation share the result.

Turns are ordered by number, then role, then text; null numbers come first. Null texts and roles are empty, null
ids one conversation. Repeated rows are repeated turns. An empty table gives empty ones. Other columns
are not looked at, whatever their names.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from .common import ROW, Staging, bounded
from .packing import _Ids

START, END = "<|im_start|>", "<|im_end|>"
START_ID, END_ID = 50257, 50258
LOSS_ROLE = "assistant"


# Template

def escaped(text):
    """One backslash more in every control string."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescaped(text):
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escaped_role(role):
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescaped_role(role):
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))


def formatted(role, text):
    """A turn in the written form."""
    return f"{START}{escaped_role(role)}\n{escaped(text)}{END}\n"


def parsed(written):
    """``(role, text)`` of each turn of a written conversation."""
    out = []
    for turn in written.split(START)[1:]:
        head, _, rest = turn.partition("\n")
        out.append((unescaped_role(head), unescaped(rest.removesuffix(f"{END}\n"))))
    return out


# Nodes

def named_turns(conversations):
    """``conv, nth, role, text, node`` of every turn; ``node`` names the turns up to here."""
    turns = conversations.select(
        F.col("conv_id").alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = Window.partitionBy("conv").orderBy("turn", "role", "text")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    numbered = turns.withColumn("nth", F.row_number().over(ordered))
    # Two hashes of place and content; the place keeps equal turns from cancelling out.
    halves = [F.bit_xor(F.xxhash64(F.lit(seed), "nth", "role", "text")).over(so_far) for seed in (1, 2)]
    node = F.concat_ws(":", F.hex(halves[0]), F.hex(halves[1]))
    return numbered.withColumn("node", node).select("conv", "nth", "role", "text", "node")


_TOKENS = "node string, depth int, n_convs long, ids array<int>, n_tokens int, loss_start int, loss_end int, n_chars long"


def _tokenized(tokenizer, start_id, end_id, loss_role):
    def run(batches):
        ids_of = _Ids(tokenizer)

        def ids(text):
            return np.frombuffer(ids_of.of(text), "<u4").astype(np.int32)

        breaks = ids("\n")
        for batch in batches:
            rows = []
            for node, depth, n_convs, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                head = np.concatenate([[start_id], ids(escaped_role(role)), breaks]).astype(np.int32)
                body = ids(escaped(text))
                every = np.concatenate([head, body, [end_id], breaks]).astype(np.int32)
                first, last = (len(head), len(head) + len(body)) if role == loss_role else (0, 0)
                rows.append((node, depth, n_convs, every, len(every), first, last, len(formatted(role, text))))
            columns = list(zip(*rows)) or [()] * 8
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=[c.split()[0] for c in _TOKENS.split(", ")])

    return run


def _offsets(nodes, staging):
    """``node, sequence, offset`` of nodes (``node, branches, depth, n_tokens``) in depth-first order."""
    order = ["branches", "depth"]
    placed = staging.table(nodes.orderBy(*order).withColumn(ROW, F.monotonically_increasing_id()), "in_order")
    parted = placed.withColumn("part", F.shiftright(ROW, 33)).withColumn("sequence", F.get("branches", F.lit(0)))
    within = Window.partitionBy("sequence", "part").orderBy(ROW).rowsBetween(Window.unboundedPreceding, -1)
    local = parted.withColumn("local", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    totals = parted.groupBy("sequence", "part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.partitionBy("sequence").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Only trees that go on in another task need a shift, at most one for each task.
    shifts = totals.withColumn("shift", F.sum("n").over(earlier)).filter("shift is not null").select("sequence", "part", "shift")
    return local.join(bounded(staging.table(shifts, "shifts")), ["sequence", "part"], "left").select(
        "node", "sequence", (F.col("local") + F.coalesce("shift", F.lit(0))).alias("offset"))


class ChatTree:
    """The trees of some conversations, written to staged tables.

    * ``segments``, one row per node: ``sequence, offset, ids, n_tokens, position`` (of its first token),
      ``loss_start, loss_end`` (tokens of the node under the loss mask), ``attends`` (intervals
      ``start, end`` of the sequence, the ancestors'), ``n_convs``;
    * ``leaves``, one row per conversation: ``conv_id, sequence, offset`` of its last turn, ``n_turns``;
    * ``ways``, one row per distinct last turn and turn on the way to it: ``sequence, leaf, nth, offset``.
    """

    def __init__(self, conversations, tokenizer, start_id=START_ID, end_id=END_ID, loss_role=LOSS_ROLE, staging=None):
        self.tokenizer, self.loss_role = tokenizer, loss_role
        self.start_id, self.end_id = start_id, end_id
        self.staging = staging = staging or Staging(conversations.sparkSession)
        turns = staging.table(named_turns(conversations), "turns")
        counts = turns.groupBy("node").agg(F.max("nth").alias("depth"), F.count(F.lit(1)).alias("n_convs"))
        texts = turns.select("node", "role", "text").dropDuplicates(["node"])
        nodes = staging.table(counts.join(texts, "node").select("node", "depth", "n_convs", "role", "text").mapInArrow(
            _tokenized(tokenizer, start_id, end_id, loss_role), _TOKENS), "nodes")
        way = Window.partitionBy("conv").orderBy("nth")
        so_far = way.rowsBetween(Window.unboundedPreceding, 0)
        steps = turns.select("conv", "nth", "node").join(bounded(nodes.select("node", "n_convs", "n_tokens")), "node")
        before = F.lag("n_convs").over(way)
        steps = steps.withColumn("begins", F.when(before.isNull() | (F.col("n_convs") < before), F.col("node")))
        steps = staging.table(steps.select(
            "conv", "nth", "node", "n_tokens", F.collect_list("begins").over(so_far).alias("branches"),
            (F.sum("n_tokens").over(so_far) - F.col("n_tokens")).alias("position")), "steps")
        distinct = steps.dropDuplicates(["node"])
        placed = staging.table(_offsets(distinct.select("node", "branches", F.col("nth").alias("depth"), "n_tokens"), staging), "offsets")
        # Every conversation's way through its sequence; of copies one goes on.
        located = steps.select("conv", "nth", "node", "n_tokens", "position").join(bounded(placed), "node")
        end = F.lag(F.col("offset") + F.col("n_tokens")).over(way)
        gap = end.isNull() | (F.col("offset") != end)
        located = located.withColumn("opens", F.when(gap, F.col("offset"))).withColumn("closes", F.when(gap, end)).withColumn("end", end)
        opens = F.collect_list("opens").over(way.rowsBetween(Window.unboundedPreceding, -1))
        closes = F.concat(F.collect_list("closes").over(way.rowsBetween(Window.unboundedPreceding, -1)), F.array_compact(F.array("end")))
        intervals = F.transform(F.arrays_zip(opens.alias("start"), closes.alias("end")), lambda z: F.struct(
            z["start"].alias("start"), z["end"].alias("end")))
        located = staging.table(located.select(
            "conv", "nth", "node", "sequence", "offset", "position", intervals.alias("attends"),
            (F.lead("nth").over(way).isNull()).alias("last")), "located")
        seen = located.dropDuplicates(["node"]).select("node", "sequence", "offset", "position", "attends")
        self.segments = staging.table(nodes.join(seen, "node").select(
            "sequence", "offset", "ids", "n_tokens", "position", "loss_start", "loss_end", "attends", "n_convs", "n_chars"), "segments")
        last = located.filter("last").select("conv", "sequence", F.col("offset").alias("leaf"), F.col("nth").alias("n_turns"))
        self.leaves = staging.table(last, "leaves")
        one = self.leaves.groupBy("sequence", "leaf").agg(F.min(F.struct(F.col("conv").isNotNull(), "conv")).alias("one"))
        chosen = one.select("sequence", "leaf", F.col("one.conv").alias("_conv"))
        self.ways = staging.table(located.select("conv", "nth", "sequence", "offset").join(
            bounded(staging.table(chosen, "chosen")).withColumnRenamed("sequence", "_sequence"),
            (F.col("sequence") == F.col("_sequence")) & F.col("conv").eqNullSafe(F.col("_conv"))).select(
            "sequence", "leaf", "nth", "offset"), "ways")

    def read_back(self):
        """What the written sequences say of each conversation: a row with its digests.

        ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``. Tokens are turned into text
        again, control ids into turns; loss digests cover what the mask holds.
        """
        turns = self.ways.join(self.segments.select("sequence", "offset", "ids", "loss_start", "loss_end"), ["sequence", "offset"])
        ordered = turns.select("sequence", "leaf", "nth", "ids", "loss_start", "loss_end").repartition(
            "sequence", "leaf").sortWithinPartitions("sequence", "leaf", "nth")
        read = ordered.mapInArrow(
            _digests(self.tokenizer, self.start_id, self.end_id),
            "sequence string, leaf long, turns_read long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
        read = self.staging.table(read, "read")
        return self.leaves.join(bounded(read), ["sequence", "leaf"]).select(
            F.col("conv").alias("conv_id"), F.col("turns_read").alias("n_turns"), "turns_sha256", "loss_chars", "loss_sha256",
            "formatted_chars")


def _digests(tokenizer, start_id, end_id):
    def run(batches):
        from tokenizers import Tokenizer

        decoder = Tokenizer.from_file(tokenizer)

        def text_of(ids):
            return decoder.decode(ids.tolist(), skip_special_tokens=False) if len(ids) else ""

        names = ("sequence", "leaf", "turns_read", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        now, state, done = None, None, []

        def told():
            n, turns, chars, loss, written = state
            return (*now, n, turns.hexdigest(), chars, loss.hexdigest(), written)

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 7, kinds)], names=names)

        for batch in batches:
            ids_column = batch.column(3)
            rows = zip(*(batch.column(i).to_pylist() for i in (0, 1, 4, 5)))
            for at, (sequence, leaf, loss_start, loss_end) in enumerate(rows):
                if (sequence, leaf) != now:
                    if now is not None:
                        done.append(told())
                    now, state = (sequence, leaf), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = ids_column[at].values.to_numpy()
                close = len(ids) - 1
                while ids[close] != end_id:
                    close -= 1
                if ids[0] != start_id:
                    raise ValueError("a node does not begin with a start mark")
                inner = text_of(ids[1:close])
                head, _, body = inner.partition("\n")
                role, text = unescaped_role(head), unescaped(body)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if loss_end > loss_start:
                    masked = unescaped(text_of(ids[loss_start:loss_end]))
                    state[2] += len(masked)
                    state[3].update(masked.encode())
                state[4] += len(START) + len(inner) + len(END) + len(text_of(ids[close + 1:]))
            if len(done) > 4096:
                yield batch_of(done)
                done = []
        if now is not None:
            done.append(told())
        yield batch_of(done)

    return run


def formatted_conversations(conversations, tokenizer, staging=None):
    """Build the trees of all conversations and read every conversation back from them."""
    return ChatTree(conversations, tokenizer, staging=staging).read_back()
