"""Plain Python versions of the operators' results, for small inputs."""

import re
from collections import Counter, defaultdict

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, size=5):
    w = words((text or "").translate(LOWER))
    if 0 < len(w) < size:
        return [("whole", *w)]
    return [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]


def near_duplicates(rows, percent, size=5):
    """[(doc_id, n_shingles, component_id, kept)] of [(doc_id, text)], by counting what all pairs share."""
    sets = [(i, set(shingles(t, size))) for i, t in rows]
    having = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            having[x].append(k)
    both = Counter((a, b) for ks in having.values() for a in ks for b in ks if a < b)
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for (a, b), n in both.items():
        (i, s), (j, t) = sets[a], sets[b]
        if i is not None and j is not None and 100 * n >= percent * (len(s) + len(t) - n):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return [(i, len(s), i if i is None else find(i), i is None or find(i) == i) for i, s in sets]


def leaks(rows, items, percent):
    """{(doc_id, item_id): similarity} over every window of the item's number of shingles."""
    out = {}
    for i, text in rows:
        mine = shingles(text)
        for k, item in items:
            theirs = Counter(shingles(item))
            m = theirs.total()
            for a in range(max(1, len(mine) - m + 1)) if m else ():
                window = Counter(mine[a : a + m])
                common = (window & theirs).total()
                if common and 100 * common >= percent * (window.total() + m - common):
                    out[i, k] = max(out.get((i, k), 0), common / (window.total() + m - common))
    return out


def passages(rows, size):
    """[(doc_id, bytes, removed spans)]."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        for p in range(len(t) - size + 1) if i is not None else ():
            first[t[p : p + size]] = min(i, first.get(t[p : p + size], i))
    out = []
    for i, t in texts:
        spans = []
        for p in range(len(t) - size + 1) if i is not None else ():
            if first[t[p : p + size]] < i:
                if spans and spans[-1][1] >= p:
                    spans[-1][1] = p + size
                else:
                    spans.append([p, p + size])
        out.append((i, t, [tuple(s) for s in spans]))
    return out


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w, lines = words(text), [x for x in text.split("\n") if words(x)]
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated)


def spans(tokens):
    """(start, end) of each of some byte strings in a row."""
    out, at = [], 0
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def alignment(text, a, b):
    """(a ids, b ids, groups as text, links) of one text; ``a`` and ``b`` give (id, bytes) of its tokens."""
    want = b" " + (text or "").encode()
    a, b = (a(text), b(text)) if text else ([], [])
    if not text or any(b"".join(t for _, t in side) != want for side in (a, b)):
        return [], [], "", []
    at_a, at_b = spans(t for _, t in a), spans(t for _, t in b)
    common = {e for _, e in at_a} & {e for _, e in at_b}
    texts, links = [], []
    for side, at in ((a, at_a), (b, at_b)):
        cut, group = [], []
        for (i, _), (_, end) in zip(side, at, strict=True):
            group.append(str(i))
            if end in common:
                cut.append(",".join(group))
                group = []
        texts.append(cut)
    first = 0
    for (i, _), (start, end) in zip(a, at_a, strict=True):
        while at_b[first][1] <= start:
            first += 1
        k = first
        while k < len(b) and at_b[k][0] < end:
            links.append((i, b[k][0]))
            k += 1
    return [i for i, _ in a], [i for i, _ in b], ";".join(map("|".join, zip(*texts, strict=True))), links
