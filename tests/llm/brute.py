"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(SMALL))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(documents, items):
    """(doc_id, n_words, n_hit, item ids, contaminated) of each (doc_id, text)."""
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - 12, 1) if w else 0):
            windows.setdefault(tuple(w[i:i + 13]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in documents:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                owners = windows.get(tuple(w[i:i + n]))
                if owners:
                    hit.update(range(i, i + n))
                    found |= owners
        out.append((doc, len(w), len(hit), sorted(found), 0 < len(hit) and 20 * len(hit) >= len(w)))
    return out


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def links(documents):
    """(doc_id, class_id, n_links, n_copies) of each (doc_id, text)."""
    sets = [shingles(text) for _, text in documents]
    near = [[j for j, t in enumerate(sets) if j != i and s and t and len(s & t) / len(s | t) >= 0.8]
            for i, s in enumerate(sets)]
    out = []
    for i, (doc, _) in enumerate(documents):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [documents[j][0] for j in seen if documents[j][0] is not None]
        out.append((doc, min(ids) if ids else None, len(near[i]), sum(sets[j] == sets[i] for j in near[i])))
    return out


def secrets(text):
    """Spans ``kind:start:end`` of the base kinds in order."""
    text, spans = text or "", []
    assign = re.compile(
        r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
        r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for n, (kind, pattern, group, least) in enumerate((
            ("assign", assign, 2, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24))):
        spans += [(m.start(), n, m.end(), kind) for m in pattern.finditer(text) if len(m[group]) >= least]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans)]


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    counts = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def url_parts(url):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(SMALL), re.match(r"[^?#]*", rest[len(host):])[0]


def site_rule(url):
    host, path = url_parts(url)
    fits = [(len(h + p), h + p, v) for v, h, p in (
        ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
        ("allow", "com", "/fr/"), ("block", "com", "/de/"))
        if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def spelling(documents, least=5):
    """{word: (form, root, n, n_near, form_n)} of (doc_id, text) rows."""
    counts = Counter()
    for doc, text in documents:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= least}
    near = {w: [v for v in n if _one_edit(w, v)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs}
    form = {w: b for w, b in best.items() if n[b] >= 5 * n[w]}
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None)
    return out


def _one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def merkle(rows):
    """{row number: (doc_id, leaf, subroot, root, proof, folded, verified)} of (doc_id, source, lang, n_chars, text) rows.

    Rows in the order of their source, id and leaf.
    """
    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def tree(nodes):
        ways, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, i in enumerate(at):
                run = nodes[i // 16 * 16:i // 16 * 16 + 16]
                ways[k].append((run[:i % 16], run[i % 16 + 1:]))
                at[k] = i // 16
            nodes = [sha("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
        return nodes[0], ways

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0], leaf(r))) for s in sources]
    trees = [tree([leaf(r) for r in g]) for g in groups]
    root, tops = tree([t[0] for t in trees]) if trees else (None, [])
    out = []
    for group, (subroot, ways), top in zip(groups, trees, tops):
        for row, way in zip(group, ways):
            way, text = way + top, row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and text is not None:
                text = text.translate(SMALL)
            node = leaf((*row[:4], text))
            for left, right in way:
                node = sha("".join([*left, node, *right]))
            proof = sha("".join(h for left, right in way for h in left + right))
            out.append((row[0], leaf(row), subroot, root, proof, node, node == root))
    return out


def chats(turns):
    """(conv_id, n_turns, turns digest, loss characters, loss digest) of (conv_id, turn, role, text) rows."""
    by = {}
    for conv, turn, role, text in turns:
        by.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    out = []
    for conv, rows in by.items():
        rows.sort()
        loss = "".join(t for _, _, r, t in rows if r == "assistant")
        out.append((conv, len(rows), sha("".join(f"{r}\n{t}\n" for _, _, r, t in rows)), len(loss), sha(loss)))
    return out
