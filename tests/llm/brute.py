"""Plain versions of the operators, a row at a time, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def substring_dedup(rows, length=50):
    """rows: (doc_id or None, text). One (doc_id, n_words, n_removed, sha) per row."""
    rank = lambda d: float("inf") if d is None else d
    least = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - length + 1):
            k = tuple(w[i : i + length])
            least[k] = min(least.get(k, float("inf")), rank(d))
    out = []
    for d, t in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - length + 1):
            if least[tuple(w[i : i + length])] < rank(d):
                gone.update(range(i, i + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), sha(kept)))
    return out


def line_key(line):
    return lower(line.strip(" \t\n\x0b\x0c\r"))


def line_dedup(rows, min_chars=40, min_docs=5):
    docs = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(line_key(line)) >= min_chars:
                docs[line_key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            held = docs.get(line_key(line), ())
            if len(held) >= min_docs and d != max(x for x in held if x is not None):
                continue
            kept.append(line)
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def fingerprint(text, size=3):
    w = words(lower(text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + size]).encode(), 42) for i in range(max(1, len(w) - size + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_duplicates(rows, radius=2):
    """(doc_id, fingerprint, component) per row."""
    prints = [fingerprint(t) for _, t in rows]
    kinds = sorted(set(prints))
    root = {f: f for f in kinds}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(kinds):
        for b in kinds[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for (d, _), f in zip(rows, prints):
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return [(d, f"{f:016x}", least.get(find(f))) for (d, _), f in zip(rows, prints)]


def base_measures(text):
    text = text or ""
    w = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def edit_distance_within(item, text):
    """Least edit distance of an item to any part of a text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != x), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)
