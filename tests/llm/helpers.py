"""Plain versions the operators are held against."""

import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def repeat_words(text):
    w = words(text)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    return len({j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)})


def simhash(text, size=4):
    w = words(lower(text))
    parts = [" ".join(w[k:k + size]) for k in range(max(1, len(w) - size + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def classes(prints, ids, radius=4):
    """The smallest id reachable over fingerprints within the radius, per row."""
    values = np.array(prints, dtype=np.uint64)
    group = list(range(len(values)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in range(len(values)):
        for b in np.flatnonzero(np.bitwise_count(values[a] ^ values[a + 1:]) <= radius):
            x, y = root(a), root(a + 1 + int(b))
            if x != y:
                group[max(x, y)] = min(x, y)
    least = {}
    for i, name in enumerate(ids):
        if name is not None:
            least[root(i)] = min(least.get(root(i), name), name)
    return [least.get(root(i)) for i in range(len(values))]


ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def hits(text, items, size=10):
    """(words, words hit, ids of the items with a window in the text)."""
    w = ALNUM.findall(lower(text))
    hit, found = set(), set()
    for item, body in items:
        v = ALNUM.findall(lower(body))
        n = min(size, len(v))
        for s in range(max(1, len(v) - size + 1)) if v else ():
            for k in range(len(w) - n + 1):
                if w[k:k + n] == v[s:s + n]:
                    hit |= set(range(k, k + n))
                    found.add("" if item is None else str(item))
    return len(w), len(hit), sorted(found)


ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def one_by_one(lengths, capacity):
    """Best-fit decreasing, one piece at a time: the number of sequences and their loads."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        best = min((r for r in range(len(rooms)) if rooms[r] >= length), key=lambda r: rooms[r], default=None)
        if best is None:
            rooms.append(capacity)
            best = len(rooms) - 1
        rooms[best] -= length
    return len(rooms), sorted(capacity - r for r in rooms)
