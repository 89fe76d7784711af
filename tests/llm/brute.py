"""Plain-Python readings of the rules, pair by pair and window by window."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text, k):
    own = words(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + k]) for i in range(len(own) - k + 1)) or frozenset([tuple(own)])


class Groups:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def near_texts(rows, k, percent):
    """{doc_id: (n_shingles, component)} by comparing all pairs."""
    sets = {i: shingles(t, k) for i, t in rows}
    groups, ids = Groups(sets), sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                same = len(sets[a] & sets[b])
                if 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                    groups.join(a, b)
    return {i: (len(sets[i]), groups.find(i)) for i in ids}


def passages(rows, width):
    """{doc_id: (n_words, n_removed, sha256 of what is left)}."""
    least = {}
    for i, t in sorted(rows):
        own = words(t)
        for at in range(len(own) - width + 1):
            least.setdefault(tuple(own[at : at + width]), i)
    out = {}
    for i, t in rows:
        own = words(t)
        gone = set()
        for at in range(len(own) - width + 1):
            if least[tuple(own[at : at + width])] < i:
                gone.update(range(at, at + width))
        left = " ".join(w for at, w in enumerate(own) if at not in gone)
        out[i] = (len(own), len(gone), hashlib.sha256(left.encode()).hexdigest())
    return out


def quality_counts(text):
    text = text or ""
    own = words(text)
    seen = Counter(tuple(own[i : i + 8]) for i in range(len(own) - 7))
    again = {p for i in range(len(own) - 7) if seen[tuple(own[i : i + 8])] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(own) < 20 or 100 * len(again) > 30 * len(own)
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(again), failed


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def ranked(docs, items, k=10):
    """[(item_id, rank, doc_id, score)] from the formula, document by document."""
    counts = [(i, Counter(TERM.findall((t or "").translate(UPPER)))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    total, length = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, Counter()).update(TERM.findall((t or "").translate(UPPER)))
    out = []
    for item, terms in wanted.items():
        found = []
        for i, c, n in counts:
            m = 100 - 75 + 75 * n * total // length
            score = sum(
                r * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t, r in terms.items()
                if t in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, place, x[3], -x[0]) for place, x in enumerate(sorted(found)[:k], 1)]
    return out


def lines(rows, least=10):
    """[(doc_id, n_lines, n_dropped, sha256 of what is left)] for every row."""
    blanks = " \t\n\x0b\x0c\r"
    cut = [(i, [(x, x.strip(blanks).translate(UPPER)) for x in (t or "").split("\n")]) for i, t in rows]
    keeper = {}
    for i, own in cut:
        for _, key in own:
            if i is not None and len(key) >= least:
                keeper[key] = min(keeper.get(key, i), i)
    out = []
    for i, own in cut:
        kept = [x for x, key in own if i is None or keeper.get(key, i) == i]
        out.append((i, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def trie(rows):
    """[(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)] prefix by prefix."""
    given = {}
    for c, turn, role, text in rows:
        if c is not None:
            given.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    given = {c: [x[2:] for x in sorted(own, key=lambda x: x[:2])] for c, own in given.items()}
    members, ends, children = {}, {}, {}
    for c, own in given.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(given.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
        ends.setdefault(path, []).append(c)
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
            if d:
                children.setdefault(path[: d - 1], set()).add(path[:d])
    leaves, saved = Counter(), Counter()
    for path, own in members.items():
        n = len(words(path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(own) - 1) * n
    digest = lambda path: hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest()
    return [
        (min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(children.get(path, ())), leaves[path], saved[path], digest(path))
        for path, own in members.items()
    ]
