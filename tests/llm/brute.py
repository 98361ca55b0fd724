"""Plain versions of the operators, one text at a time, for small inputs."""

import hashlib
import re
from collections import Counter

SPACES = "[\x20\x09-\x0d]+"


def words(text):
    return [w for w in re.split(SPACES, text or "") if w]


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def similar(docs, percent=80, k=5):
    """{id: (size of set, component)}"""
    sets = {}
    for i, t in docs.items():
        w = words(fold(t))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in docs:
        for b in docs:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in docs}


def without_repeats(docs, size=100):
    """{id: (bytes, removed, spans, sha)}"""
    seen, out = set(), {}
    for i in sorted(docs):
        b = (docs[i] or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if b[p : p + size] in seen:
                gone[p : p + size] = b"\1" * size
            seen.add(b[p : p + size])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for j, g in enumerate(gone) if g and not (j and gone[j - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


ASSIGN = re.compile(
    r"(?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_key", "apikey"))
    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


def stats(text):
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def edits(text, item):
    """The least edit distance between an item and any passage."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, x in enumerate(text):
            new.append(min(row[j] + (x != c), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)
