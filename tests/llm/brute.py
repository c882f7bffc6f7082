"""Plain versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def components(rows, k, percent):
    """(set size, component) by row position; rows are (doc_id, text)."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(zip(*[w[j:] for j in range(k)])) if len(w) >= k else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    common = defaultdict(int)
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            for j in holders[x]:
                common[j, i] += 1
            holders[x].append(i)
    for (i, j), n in common.items():
        if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return [(len(sets[i]), rows[i][0] if not sets[i] else least.get(find(i))) for i in range(len(rows))]


def contamination(text, items):
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or ""))
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    w, hit, found = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        n = min(10, len(iw))
        for k in range(len(iw) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p : p + n] == iw[k : k + n]:
                    hit |= set(range(p, p + n))
                    found.add(item)
    return (len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit))


def secrets(text):
    t, out = text or "", []
    either = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    for m in re.finditer(rf"""({either})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    counts = Counter(x[3] for x in out)
    return (counts["assign"], counts["access"], counts["hex"], sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))))


def quality(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    counts, inside = Counter(grams), set()
    for i, g in enumerate(grams):
        if counts[g] > 1:
            inside |= set(range(i, i + 8))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside), len(w) < 20 or 100 * len(inside) > 30 * len(w))


def removals(rows, length=50):
    """(doc, bytes, removed, runs, digest of the rest) of each (doc_id, text)."""
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            if doc is not None:
                key = data[i : i + length]
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        cut = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if doc is not None and first[data[i : i + length]] < doc:
                cut[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(data)) if cut[i] and (not i or not cut[i - 1]))
        out.append((doc, len(data), sum(cut), runs, sha(bytes(x for x, c in zip(data, cut) if not c))))
    return out
