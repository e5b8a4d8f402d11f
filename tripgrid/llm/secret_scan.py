"""Secret scans over whole texts, with a trigram index in front of the regular expressions.

Each rule's pattern is turned into a Boolean query of trigrams that every match must contain: an OR
of alternatives, each an AND of trigrams. The index holds, for every document, which of the queries'
trigrams it contains. Postings are kept bit-sliced: bit ``t`` of a document's ``postings`` is set if
the document is in the posting list of trigram ``t``, so intersecting lists is a bitwise AND with a
query's mask, done where the document is read. Only documents that satisfy a rule's query meet its
regular expression. Rules without mandatory trigrams scan every document.

Null texts are empty. Long texts are scanned whole; findings of a document are thin rows, so a text
never leaves the task that read it. Repeated documents each get their own findings, empty tables none.
Findings look at ``doc_id`` and ``text`` only; masking keeps all other columns, whatever their names.
"""

import re
from dataclasses import dataclass

from pyspark.sql import Window, functions as F

from .common import ROW, fenced, reserved, whole_text

# Sub-patterns with more alternatives than this end a literal run instead of branching it.
MOST_BRANCHES = 48


@dataclass(frozen=True)
class Rule:
    """``kind``, a pattern both Python and Java read, and what a match must satisfy to stay.

    ``least`` is the least length of group ``group``; shorter matches are consumed, but dropped.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False

    @property
    def regex(self):
        return f"(?i){self.pattern}" if self.any_case else self.pattern


# The base kinds, in the order in which findings at one place are listed; then further ones.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=6, any_case=True),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    # Runs of 24 and more are the same as all runs of which the shorter ones are dropped.
    Rule("hex", "[0-9a-f]{24,}", least=24),
)
MORE_RULES = (
    # With its body: up to the end line, or what looks like base64 where that is missing.
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
         r"(?:[A-Za-z0-9+/=:,.\x20\t\r\n-]*?-----END [A-Z ]*PRIVATE KEY-----|[\r\n]+[A-Za-z0-9+/=\r\n]*)?"),
    Rule("code_host", "gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("cloud_key", "AIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE_RULES + MORE_RULES


# Trigram queries

def _fragments(tree):
    """All ways through a parsed pattern: tuples of literal runs, with None where anything may be."""
    ways = [()]
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            step = [(chr(arg),)]
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
            step = [(chr(c),) for _, c in arg]
        elif name == "BRANCH":
            step = [way for branch in arg[1] for way in _fragments(branch)]
        elif name == "SUBPATTERN":
            step = _fragments(arg[-1])
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, inner = arg
            once = _fragments(inner)
            if least == 0 and int(most) == 1:
                step = [(), *once]
            elif least == most == 1:
                step = once
            else:
                step = [(*way, None) for way in once] if least else [(None,)]
        else:
            step = [(None,)]
        if len(ways) * len(step) > MOST_BRANCHES:
            step = [(None,)]
        ways = [(*way, *more) for way in ways for more in step]
    return ways


def trigram_query(pattern):
    """Lower-case trigrams each match must contain: a list of alternative sets, or None for any text."""
    alternatives = set()
    for way in _fragments(re._parser.parse(pattern)):
        runs = "".join("\0" if piece is None else piece for piece in way).lower().split("\0")
        grams = frozenset(run[i:i + 3] for run in runs for i in range(len(run) - 2))
        if not grams:
            return None
        alternatives.add(grams)
    smallest = [a for a in alternatives if not any(b < a for b in alternatives)]
    return sorted(map(sorted, smallest))


class TrigramIndex:
    """The queries of some rules and the postings of the trigrams in them."""

    def __init__(self, rules):
        self.queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
        grams = sorted({g for query in self.queries.values() if query for part in query for g in part})
        self.words = [grams[i:i + 60] for i in range(0, len(grams), 60)]

    def postings(self, text):
        """Array of longs whose bits say which trigrams the text contains, in either case."""
        small = F.lower(text)
        sliced = []
        for word in self.words:
            bits = [F.when(F.contains(small, F.lit(g)), F.lit(1 << i)).otherwise(F.lit(0)) for i, g in enumerate(word)]
            total = F.lit(0).cast("long")
            for bit in bits:
                total = total.bitwiseOR(bit.cast("long"))
            sliced.append(total)
        return F.array(*sliced) if sliced else F.array().cast("array<bigint>")

    def candidate(self, kind, postings):
        """Whether the postings satisfy the rule's query; true where it has none."""
        query = self.queries[kind]
        if query is None:
            return F.lit(True)
        either = F.lit(False)
        for part in query:
            both = F.lit(True)
            for n, word in enumerate(self.words):
                mask = sum(1 << i for i, g in enumerate(word) if g in part)
                if mask:
                    both = both & (F.get(postings, F.lit(n)).bitwiseAND(F.lit(mask).cast("long")) == mask)
            either = either | both
        return either


# Findings

def _matches(rule, text, candidate):
    """Matches as ``struct(gap, match, kept)``: the text before each one since the last, and itself."""
    regex = F.lit(rule.regex)
    hit = candidate & F.rlike(text, regex)
    found = F.regexp_extract_all(text, regex, F.lit(0))
    judged = F.regexp_extract_all(text, regex, F.lit(rule.group)) if rule.group else found
    cut = F.transform(F.split(text, rule.regex, -1), lambda gap: F.char_length(gap))
    cells = F.transform(
        F.arrays_zip(cut.alias("gap"), found.alias("match"), judged.alias("judged")),
        lambda z: F.struct(
            z["gap"].alias("gap"), z["match"].alias("match"), (F.char_length(z["judged"]) >= rule.least).alias("kept")
        ),
    )
    return F.when(hit, F.filter(cells, lambda z: z["match"].isNotNull()))


def findings(documents, rules=RULES):
    """One row per finding: ``_row, doc_id, kind_no, kind, start, end, secret``.

    Places are code points, the end exclusive. Matches of a kind are leftmost and do not overlap. A
    document without findings has one row whose last five columns are null.
    """
    index = TrigramIndex(rules)
    read = documents.select(
        F.monotonically_increasing_id().alias(ROW), "doc_id", whole_text(F.col("text")).alias("_text")
    ).withColumn("_postings", index.postings(F.col("_text")))
    per_kind = [
        F.transform(
            F.coalesce(_matches(rule, F.col("_text"), index.candidate(rule.kind, F.col("_postings"))),
                       F.array().cast("array<struct<gap:int,match:string,kept:boolean>>")),
            lambda z, i: F.struct(F.lit(n).alias("kind_no"), i.alias("nth"), z["gap"].alias("gap"),
                                       z["match"].alias("match"), z["kept"].alias("kept")),
        )
        for n, rule in enumerate(rules)
    ]
    cells = read.select(ROW, "doc_id", F.explode_outer(F.flatten(F.array(*per_kind))).alias("m")).select(
        ROW, "doc_id", "m.*"
    )
    so_far = Window.partitionBy(ROW, "kind_no").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    length = F.char_length("match")
    placed = cells.withColumn("end", F.sum(F.col("gap") + length).over(so_far))
    kept = F.coalesce("kept", F.lit(False))
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    return placed.select(
        ROW, "doc_id", F.when(kept, F.col("kind_no")).alias("kind_no"),
        F.when(kept, F.get(kinds, F.col("kind_no"))).alias("kind"), F.when(kept, F.col("end") - length).alias("start"),
        F.when(kept, F.col("end")).alias("end"), F.when(kept, F.col("match")).alias("secret"),
    )


def span_summary(found, base=len(BASE_RULES)):
    """One row per document: counts of the base kinds, and all spans as ``kind:start:end`` texts."""
    span = F.struct("start", "kind_no", "end", "kind")
    sorted_spans = F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull(), span)))
    per_document = found.groupBy(ROW, "doc_id").agg(
        *[F.count_if(F.col("kind") == rule.kind).alias(f"n_{rule.kind}") for rule in BASE_RULES],
        sorted_spans.alias("_spans"),
    )

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return per_document.select(
        "doc_id", *[f"n_{rule.kind}" for rule in BASE_RULES],
        F.sha2(joined(F.filter("_spans", lambda s: s["kind_no"] < base)), 256).alias("base_sha256"),
        joined(F.col("_spans")).alias("spans"),
    )


def masked(documents, rules=RULES, mask="[REDACTED]"):
    """Documents with every finding replaced, all columns kept; done in the task that reads them.

    Rules apply in order, each to the text that the earlier ones left. Of a rule that judges a group
    at the match's end only that group is replaced. ``n_chars``, where there is one, is counted anew.
    Null texts stay null.
    """
    index, (postings,) = TrigramIndex(rules), reserved(documents, "postings")
    scanned = F.array_compact(F.array(*[
        F.when(index.candidate(rule.kind, F.col(postings)), F.struct(
            F.lit(rule.regex).alias("regex"), F.lit(rule.group).alias("group"), F.lit(rule.least).alias("least")))
        for rule in rules]))

    def rebuilt(text, rule):
        found = F.regexp_extract_all(text, rule["regex"], F.lit(0))
        judged = F.regexp_extract_all(text, rule["regex"], rule["group"])

        def piece(z):
            head = F.substring(z["match"], F.lit(1), F.char_length(z["match"]) - F.char_length(z["judged"]))
            seen = F.when(F.char_length(z["judged"]) >= rule["least"], F.concat(head, F.lit(mask))).otherwise(z["match"])
            return F.concat(z["gap"], F.coalesce(seen, F.lit("")))

        cut = F.arrays_zip(F.split(text, rule["regex"], -1).alias("gap"), found.alias("match"), judged.alias("judged"))
        return F.when(F.rlike(text, rule["regex"]), F.array_join(F.transform(cut, piece), "")).otherwise(text)

    # One fold over a document's candidate rules, rather than a chain of columns.
    read = documents.withColumn(postings, index.postings(whole_text(F.col("text"))))
    shown = fenced(read, (postings,), text=F.aggregate(scanned, F.col("text"), rebuilt))
    return shown.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in documents.columns else shown
