"""Plain Python versions of the llm operators, for small tables."""

import collections
import hashlib
import re

LOW = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def repeats(rows, span=35):
    """[(id, n_words, n_removed, kept sha256)] of (id, text) rows."""
    texts = [WORD.findall(t or "") for _, t in rows]
    seen = collections.Counter(tuple(w[i:i + span]) for w in texts for i in range(len(w) - span + 1))
    out = []
    for (i, _), w in zip(rows, texts):
        gone = {p for s in range(len(w) - span + 1) if seen[tuple(w[s:s + span])] > 1 for p in range(s, s + span)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def contamination(rows, items, size=10):
    """[(id, n_words, n_hit, sorted item ids)] of (id, text) rows."""
    windows = collections.defaultdict(set)
    for i, t in items:
        w = LETTERS.findall((t or "").translate(LOW))
        for s in range(max(len(w) - size, 0) + 1):
            if w:
                windows[tuple(w[s:s + size])].add(str(i))
    lengths = {len(k) for k in windows}
    out = []
    for i, t in rows:
        w = LETTERS.findall((t or "").translate(LOW))
        hits, found = set(), set()
        for k in lengths:
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in windows:
                    hits.update(range(s, s + k))
                    found |= windows[tuple(w[s:s + k])]
        out.append((i, len(w), len(hits), sorted(found)))
    return out


def shingles(text, n=5):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[s:s + n]) for s in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def jaccard(rows, per_cent=75):
    """[(id, n_shingles, component id)] of (id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            overlap = len(sets[a] & sets[b])
            if overlap and 100 * overlap >= per_cent * (len(sets[a]) + len(sets[b]) - overlap):
                parent[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return [(i, len(s), least.get(top(k), i)) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def vectors(rows, threshold=0.95):
    """[(id, n_links, component id, kept)] of (id, vector) rows."""
    import math

    def usable(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(y * y for y in b))

    links = {k: set() for k in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            if usable(rows[a][1]) and usable(rows[b][1]) and len(rows[a][1]) == len(rows[b][1]) and cosine(rows[a][1], rows[b][1]) >= threshold:
                links[a].add(b)
                links[b].add(a)
    out = []
    for k, (i, _) in enumerate(rows):
        reach, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - reach
            reach |= new
            todo += new
        ids = [rows[r][0] for r in reach if rows[r][0] is not None]
        least = min(ids) if ids else i
        out.append((i, len(links[k]), least, i is not None and i == least))
    return out


def secrets(text):
    """(n_assign, n_access, n_hex, base spans) of a text."""
    text = text or ""
    assign = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [[(m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 6],
             [(m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20],
             [(m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]]
    spans = sorted((s, k, e) for k, part in enumerate(found) for s, e in part)
    return (*map(len, found), ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans))
