"""Plain versions of the text operators, for small inputs: no shared code, no Spark."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")
FOLDED = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text):
    """The counts of the rules, and whether the text fails them."""
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + k for i, g in enumerate(windows) if often[g] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed)


def shingles(text):
    w = words((text or "").translate(SMALL))
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} - {()}


def similar(docs, percent=90):
    """Doc id to shingles and smallest linked id, for (doc_id, text) with ids that are not null."""
    sets, parent = [(i, shingles(t)) for i, t in docs], {i: i for i, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [(i, len(s), root(i)) for i, s in sets]


def kept_words(texts, size=35):
    """Per text: number of words, removed ones, and the rest."""
    split = [words(t) for t in texts]
    often = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for w in split:
        gone = {
            i + k for i in range(len(w) - size + 1) if often[tuple(w[i : i + size])] > 1 for k in range(size)
        }
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def contamination(text, items, size=13):
    """Words, hit words and items hit, for (item_id, text)."""
    w = FOLDED.findall((text or "").translate(SMALL))
    hit, found = set(), set()
    for name, item in items:
        x = FOLDED.findall((item or "").translate(SMALL))
        n = min(size, len(x))
        wanted = {tuple(x[i : i + n]) for i in range(len(x) - n + 1)} if x else set()
        places = [i for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in wanted] if wanted else []
        hit |= {i + k for i in places for k in range(n)}
        found |= {"" if name is None else str(name)} if places else set()
    return len(w), len(hit), sorted(found)


def greedy_pieces(word, vocabulary):
    """Number of greedy longest pieces, or None."""
    at = n = 0
    while at < len(word):
        size = next((k for k in range(len(word) - at, 0, -1) if word[at : at + k] in vocabulary), 0)
        if not size:
            return None
        at, n = at + size, n + 1
    return n


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    out = []
    for n, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            number = [int(c) for c in m[0] if c in "0123456789"]
            doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(number[::-1])]
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(number) <= 19 and sum(doubled) % 10 == 0,
                "phone": 10 <= len(number) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def targets(sizes, most=3, weights=(5, 2, 1)):
    """Source to words, for (source, size): shares by weight, the excess over the limit shared anew."""
    totals = Counter()
    for source, size in sizes:
        totals[source] += size
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, rest = set(), sum(totals.values())
    while True:
        open_ = [s for s in names if s not in full]
        left = rest - sum(most * totals[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * totals[s]}
        if not over:
            return {s: share.get(s, most * totals[s]) for s in names}
        full |= over


def runs(x, least=6, times=4):
    """Maximal stretches with a smallest period q, of max(least, times * q) words or more, as
    (start, length, q)."""
    best = {}
    for q in range(1, len(x) // times + 1):
        i = 0
        while i < len(x) - q:
            if x[i] != x[i + q]:
                i += 1
                continue
            start = i
            while i < len(x) - q and x[i] == x[i + q]:
                i += 1
            if i + q - start >= max(least, times * q):
                best.setdefault((start, i + q - start), q)
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def collapsed(x, found):
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return [w for i, w in enumerate(x) if i not in gone]
