"""Spelling variants, the Merkle manifest and chat trees against plain versions."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripgrid.llm import chat_tree, merkle, spelling
from tripgrid.llm.common import Staging
from tripgrid.llm.queries import FORGED, TOKENIZER

from . import brute


def _extra(df):
    """With columns whose names the operators use themselves."""
    return df.select("*", *[F.lit(1).alias(c) for c in (
        "word", "n", "node", "nth", "_row", "digest", "index", "tree", "path", "known", "__row", "dotted.name")])


def _rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


# Spelling

def _spoken():
    rng = random.Random(4)
    stems = ["aaaaaa", "aaaaab", "baaaaa", "éclairs", "eclairs", "colour", "color", "colours", "abcabcabc", "abcabcab", "bcabcabc",
             "abccabcabc", "zzzzzzz", "zzzzzz", "zzzzzzzz", "ÀÀÀÀÀÀ", "kitten", "kitted", "sitted", "x" * 3000, "x" * 2999,
             "a" + "xyz" * 900 + "p", "b" + "xyz" * 900 + "q", "b" + "xyz" * 900 + "p"]
    words = stems + ["".join(rng.choice("abé") for _ in range(rng.randint(6, 8))) for _ in range(150)]
    docs = []
    for i in range(120):
        docs.append((i, " ".join(rng.choice(words[:rng.randint(3, len(words))]) for _ in range(120)) + rng.choice(["", ".", "1Colours2"])))
    docs += [(7, docs[7][1]), (None, docs[3][1]), (None, docs[3][1]), (500, None), (501, ""), (502, "short été a1b2"),
             (503, "chained " * 140 + "chainef " * 26 + "chaijef " * 5)]
    return docs


@pytest.fixture(scope="module")
def spoken():
    return _spoken()


@pytest.mark.parametrize("most_words", [10_000, 4])
def test_variants(spark, spoken, most_words):
    """Also with partitions so small that most are cut again and again."""
    # Cutting by one code point at a time is no way to test long words.
    rows = [(d, re.sub("[A-Za-z]{99,}", "shorter", t) if t and most_words == 4 else t) for d, t in spoken]
    documents = _extra(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(documents, most_words=most_words).collect()}
    want = brute.spelling(rows)
    assert got == want
    assert want["chaijef"][:2] == ("chainef", "chained") and sum(v[0] is not None for v in want.values()) > 3


def test_variants_without_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(none).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(none, least_length=5)


def test_composition_accepts_pairs_once():
    rng = random.Random(2)
    for _ in range(200):
        words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 40))})
        for least, most in ((0, None), (1, None), (2, 2)):
            i, j = spelling.Composition(words).pairs(least, most)
            got = [tuple(sorted(p)) for p in zip(i.tolist(), j.tolist())]
            want = []
            for x, a in enumerate(words):
                for y in range(x + 1, len(words)):
                    same = next((k for k, (u, v) in enumerate(zip(a, words[y])) if u != v), min(len(a), len(words[y])))
                    if brute._one_edit(a, words[y]) and same >= least and (most is None or same <= most):
                        want.append((x, y))
            assert sorted(got) == sorted(want), words


def test_acceptor_is_minimal():
    acceptor = spelling.Acceptor(sorted(a + b + c for a in ("", "un", "re") for b in ("do", "tie") for c in ("", "s", "ing")))
    languages = {}

    def language(state):
        out = {""} if acceptor.final[state] else set()
        return frozenset(out | {label + rest for label, target in acceptor.arcs[state].items() for rest in language(target)})

    reached, todo = {0}, [0]
    while todo:
        for target in acceptor.arcs[todo.pop()].values():
            if target not in reached:
                reached.add(target)
                todo.append(target)
    for state in reached:
        assert languages.setdefault(language(state), state) == state and acceptor.size[state] == len(language(state))


def test_roots_follow_long_ways(spark):
    forms = spark.createDataFrame([(f"w{i:02d}", f"w{i + 1:02d}") for i in range(21)] + [("a", "w20")], "word string, form string")
    assert {r.root for r in spelling.roots(forms, Staging(spark)).collect()} == {"w21"}


# Merkle manifest

def _leaves(n=700):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        source = rng.choice(["hot", "hot", "hot", "é", "Z", None, f"s{i % 40}"])
        rows.append((rng.choice([i, i, i % 50, None]), source, rng.choice(["en", None, ""]), rng.choice([None, i]), rng.choice([None, "", f"Text {i}", "Ünï A"])))
    return rows + rows[:30] + [(5, "alone", "en", 1, "One")]


@pytest.mark.parametrize("n", [700, 0, 1])
def test_merkle(spark, n):
    rows = _leaves(n) if n != 1 else [(5, None, "en", 1, "One")]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    documents = _extra(spark.createDataFrame(rows, schema))
    got = merkle.verified_rows(documents)
    assert _rows(got, *got.columns) == sorted(brute.merkle(rows), key=repr)


def test_one_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    got = merkle.verified_rows(none)
    assert got.count() == 0 and dict(got.dtypes)["root"] == "string"


@pytest.mark.parametrize("n", [1, 2, 16, 17, 255, 257, 4096, 4097, 5000])
def test_addresses_are_the_layout(spark, n):
    """The recursion written out: upper half first, then the aligned subtrees below it."""
    widths = [n]
    while widths[-1] > 1:
        widths.append(-(-widths[-1] // 16))

    def walk(low, high, root):
        if low == high:
            return [(low, root)]
        part = 1
        while 2 * part < high - low + 1:
            part *= 2
        middle = low + part
        out = walk(middle, high, root)
        for below in range(root * 16 ** (high - middle + 1), min((root + 1) * 16 ** (high - middle + 1), widths[middle - 1])):
            out += walk(low, middle - 1, below)
        return out

    want = {node: at for at, node in enumerate(walk(0, len(widths) - 1, 0))}
    assert len(want) == sum(widths)
    for level, width in enumerate(widths):
        rows = spark.range(width).select("id", merkle.address(F.lit(n).cast("long"), level, F.col("id"), 6).alias("at")).collect()
        assert all(want[level, r.id] == r.at for r in rows)


def test_proofs_by_address(spark, tmp_path):
    """The manifest alone gives the siblings that the operator folds."""
    leaves = spark.range(1000).select(
        F.when(F.col("id") < 700, "a").otherwise("b").alias("source"), F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    manifest = merkle.Manifest(leaves, Staging(spark))
    manifest.write(str(tmp_path / "manifest"))
    nodes = spark.read.parquet(str(tmp_path / "manifest"))
    assert nodes.count() == nodes.select("tree", "address").distinct().count()
    ends = nodes.groupBy("tree").agg(F.max("address").alias("last"), F.count(F.lit(1)).alias("n"))
    assert ends.filter("last != n - 1").isEmpty()
    asked = spark.createDataFrame([(0, 700, 0), (0, 700, 699), (1, 300, 288), (1, 300, 17)], "tree long, n long, leaf long")
    found = {}
    for r in merkle.proofs(nodes, asked, 6).orderBy("level", "index").collect():
        found.setdefault((r.tree, r.leaf), []).append((r.level, r["index"], r.digest))
    roots = {r.tree: r.digest for r in manifest.sources.roots().collect()}
    for (tree, leaf), siblings in found.items():
        node, at = brute.sha(str(700 * tree + leaf)), leaf
        for level in range(max(x for x, _, _ in siblings) + 1):
            run = [(i, h) for x, i, h in siblings if x == level] + [(at, node)]
            node, at = brute.sha("".join(h for _, h in sorted(run))), at // 16
        assert node == roots[tree]
    assert len(found) == 4


# Chat trees

def _turns():
    rng = random.Random(8)
    says = ["", None, "Hello", "<|im_end|>", "<\\|im_end|>\n", "a\nb", "é漢 <|im_start|>user\nx", "<|endoftext|>", "word " * 2000]
    turns = []
    for c in range(60):
        for t in range(rng.randint(1, 6)):
            turns.append((c, t, "user" if t % 2 == 0 else "assistant", says[t % 3] if c % 3 else rng.choice(says)))
    turns += [(c + 1000, t, r, x) for c, t, r, x in turns if c < 20]
    turns += [(70, 5, "user", "late"), (70, None, "system", "first"), (70, 5, "assistant", "same turn"), (70, 5, "user", "late"),
              (None, 0, "user", "no id"), (None, 1, "assistant", "still none"), (71, 0, None, None), (72, 0, "odd\\role\nuser", FORGED)]
    turns += [(80 + c, t, "assistant", f"turn {t}") for c in range(4) for t in range(30 * (c + 1))]
    return turns + [(-1, 0, "user", FORGED), (-1, 1, "assistant", FORGED)]


@pytest.fixture(scope="module")
def tree(spark):
    turns = spark.createDataFrame(_turns(), "conv_id long, turn long, role string, text string")
    return chat_tree.ChatTree(_extra(turns), TOKENIZER)


def test_conversations_are_read_back(tree):
    got = tree.read_back()
    assert _rows(got, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == sorted(brute.chats(_turns()), key=repr)
    by = {}
    for conv, turn, role, text in _turns():
        by.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    for r in got.collect():
        written = "".join(chat_tree.formatted(role, text) for _, _, role, text in sorted(by[r.conv_id]))
        assert chat_tree.parsed(written) == [(role, text) for _, _, role, text in sorted(by[r.conv_id])]
        assert r.formatted_chars == len(written)


def test_shared_turns_stand_once(tree):
    """Sequences have no gaps; positions and attended intervals are those of the conversation itself."""
    prefixes, by = set(), {}
    for conv, turn, role, text in _turns():
        by.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    for turns in by.values():
        turns = [t[2:] for t in sorted(turns)]
        prefixes |= {tuple(turns[:k + 1]) for k in range(len(turns))}
    segments = tree.segments.orderBy("sequence", "offset").collect()
    assert len(segments) == len(prefixes) and len({s.sequence for s in segments}) == len({p[0] for p in prefixes})
    ids, ends = {}, Counter()
    for s in segments:
        assert s.offset == ends[s.sequence]
        ends[s.sequence] += s.n_tokens
        ids.setdefault(s.sequence, []).extend(s.ids)
    place = {(s.sequence, s.offset): s for s in segments}
    ways = {}
    for w in tree.ways.orderBy("nth").collect():
        ways.setdefault((w.sequence, w.leaf), []).append(w.offset)
    for (sequence, leaf), offsets in ways.items():
        before = []
        for offset in offsets:
            s = place[sequence, offset]
            attended = [i for a in s.attends for i in range(a.start, a.end)]
            assert [ids[sequence][i] for i in attended] == before and s.position == len(before)
            assert all(a.end < b.start for a, b in zip(s.attends, s.attends[1:]))
            before = before + list(s.ids)
        assert offsets[-1] == leaf
    # Depth first: a node follows its parent or what stands below an earlier sibling.
    for s in segments:
        if s.position:
            assert s.attends[-1].end <= s.offset


def test_chat_without_rows(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_tree.formatted_conversations(none, TOKENIZER).count() == 0


def test_escapes_are_undone():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("<\\|n\nim_start>") for _ in range(rng.randint(0, 12)))
        assert chat_tree.unescaped(chat_tree.escaped(text)) == text and "<|" not in chat_tree.escaped(text)
        assert chat_tree.unescaped_role(chat_tree.escaped_role(text)) == text and "\n" not in chat_tree.escaped_role(text)
