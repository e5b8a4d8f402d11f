"""Quality rules as a ledger: every rule is evaluated once, its outcome is a bit.

``ledger`` keeps a document's measurements and ``failed``, a long whose bit ``i`` is set if rule ``i``
fails. Policies are named and versioned bit masks over the ledger, so changing one reads no text
again: ``apply_policy`` is one bitwise AND, and ``ablations`` says what each rule does alone, from
the counts of the distinct bit patterns.

Null texts have no words; a text without words has zero in every measurement.
Long texts are measured whole, in the task that reads them; nothing is shuffled. Repeated rows are measured
each, and an empty table gives an empty ledger, without ablations. Columns that are not kept are not looked at.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from .common import fenced, whole_text

BLANKS, NO_BLANK = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
GRAM = 3

MEASURES = ("n_words", "word_chars", "n_symbols", "n_marks", "n_lines", "n_dup_lines", "n_repeat_words")
# Rules in the order of their bits: name and the condition under which a document fails.
RULES = {
    "too_few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "shouting": "2 * n_marks > n_words",
}


@dataclass(frozen=True)
class Policy:
    """A version of what to refuse: documents that fail any of these rules."""

    name: str
    version: int
    rules: tuple

    @property
    def mask(self):
        return sum(1 << list(RULES).index(rule) for rule in self.rules)


BASE_POLICY = Policy("base", 1, ("too_few_words", "repeated_words"))
POLICY = Policy("web", 2, tuple(RULES))


def _repeated(grams):
    """Words covered by the ``GRAM``-word windows that occur at least twice, from their sorted hashes.

    ``grams`` is a sorted array of ``(hash, place)``: equal windows are neighbours in it. The places
    of repeated ones, sorted again, give the covered words as gaps, none counted over ``GRAM``.
    """
    return F.sort_array(F.array_compact(F.transform(grams, lambda g, k: F.when(
        (g["h"] == F.get(grams, k + 1)["h"]) | (g["h"] == F.get(grams, k - 1)["h"]), g["i"]))))


def measured(documents, *keep):
    """The kept columns with ``n_words, word_chars, n_symbols, n_marks, n_lines, n_dup_lines, n_repeat_words``."""
    split = documents.select(*keep, whole_text(F.col("text")).alias("_text")).withColumn(
        "_words", F.array_remove(F.split("_text", BLANKS, -1), ""))
    n = F.size("_words")
    grams = F.when(n >= GRAM, F.transform(
        F.sequence(F.lit(1), F.greatest(n - GRAM + 1, F.lit(1))),
        lambda i: F.xxhash64(*[F.get("_words", i + (k - 1)) for k in range(GRAM)]),
    )).otherwise(F.array().cast("array<bigint>"))
    counted = split.withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda x: F.rlike(x, F.lit(NO_BLANK)))).select(
        *keep, n.cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.size(F.split("_text", SYMBOLS, -1)) - 1).cast("long").alias("n_symbols"),
        (F.size(F.split("_text", "!+", -1)) - 1).cast("long").alias("n_marks"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        grams.alias("_grams"),
    )
    # Few documents repeat a window; only theirs are sorted.
    repeats = F.size(F.array_distinct("_grams")) < F.size("_grams")
    placed = F.when(repeats, F.sort_array(
        F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    at = counted.withColumn("_sorted", placed).withColumn("_at", _repeated(F.col("_sorted")))
    covered = F.aggregate(
        F.transform("_at", lambda i, k: F.least(F.lit(GRAM), F.coalesce(F.get("_at", k + 1) - i, F.lit(GRAM)))),
        F.lit(0), lambda a, b: a + b)
    return fenced(
        at, ("_grams", "_sorted", "_at"), **{name: F.col(name) for name in MEASURES[:-1]},
        n_repeat_words=F.coalesce(covered, F.lit(0)).cast("long"))


def ledger(documents, *keep):
    """Measurements and ``failed``, the bits of the rules that a document fails."""
    bits = F.lit(0).cast("long")
    for i, condition in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured(documents, *keep).withColumn("failed", bits)


def fails(policy):
    """Whether a ledger's row fails a policy."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def apply_policy(rows, policy):
    """A ledger with ``kept`` and the policy's name and version."""
    return rows.withColumn("kept", ~fails(policy)).withColumn("policy", F.lit(f"{policy.name}/{policy.version}"))


def ablations(rows, policy):
    """One row per rule of a policy: documents failing it, failing it alone, and kept without it.

    Documents are first counted by bit pattern, of which there are at most 2 to the number of rules.
    """
    patterns = rows.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")).agg(
        F.count(F.lit(1)).alias("n"))
    per_rule = patterns.select("bits", "n", F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(1 << list(RULES).index(rule)).cast("long").alias("bit"))
        for rule in policy.rules])).alias("r")).select("bits", "n", "r.*")
    others = F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit")))
    return per_rule.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(others == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
        F.bit_or(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, others)).alias("failed_with"),
    )
