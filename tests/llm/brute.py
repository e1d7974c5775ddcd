"""Plain versions of the operators, written from their contracts, for small tables."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text, k):
    words = WORD.findall(fold(text or ""))
    if not words:
        return frozenset()
    if len(words) < k:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def jaccard_components(docs, k, num, den):
    """``docs``: (id, text) with distinct ids; returns id -> (set size, smallest linked id)."""
    sets = {i: shingles(t, k) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    common = {}
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a):
                p = (min(ids[a], ids[b]), max(ids[a], ids[b]))
                common[p] = common.get(p, 0) + 1
    for (a, b), n in common.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def repeats(docs, window=13):
    first = {}
    words = {i: WORD.findall(t or "") for i, t in docs}
    for i, ws in words.items():
        for j in range(len(ws) - window + 1):
            w = tuple(ws[j:j + window])
            first[w] = min(i, first.get(w, i))
    out = {}
    for i, ws in words.items():
        gone = [False] * len(ws)
        for j in range(len(ws) - window + 1):
            if first[tuple(ws[j:j + window])] < i:
                gone[j:j + window] = [True] * window
        kept = " ".join(w for w, g in zip(ws, gone) if not g)
        out[i] = (len(ws), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def private(text):
    """Counts per kind, and the base spans as (start, kind number, end)."""
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ]
    found = [[(m.start(), k, m.end()) for m in re.finditer(p, text) if ok(m[0])] for k, (p, ok) in enumerate(kinds)]
    return [len(x) for x in found], sorted(sum(found, []))


def span_digest(spans):
    names = ("email", "ip", "card", "phone")
    return hashlib.sha256(",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()


def local_score(doc, item, match=2, mismatch=-1, gap=-1):
    """Smith-Waterman by the textbook recurrence."""
    prev, best = [0] * (len(doc) + 1), 0
    for w in item:
        cur = [0]
        for j, d in enumerate(doc, 1):
            cur.append(max(0, prev[j - 1] + (match if d == w else mismatch), prev[j] + gap, cur[-1] + gap))
        best, prev = max(best, max(cur)), cur
    return best
