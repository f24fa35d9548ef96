"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
from collections import Counter

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def substrings(docs: list[tuple], window: int = 50) -> Counter:
    """(id, n_words, n_removed, kept) of each row; ids may be null or repeated."""
    starts: dict[tuple, int] = {}
    for key, text in docs:
        w = words(text)
        for i in range(len(w) - window + 1) if key is not None else ():
            at = tuple(w[i : i + window])
            starts[at] = min(key, starts.get(at, key))
    out = Counter()
    for key, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1) if key is not None else ():
            if starts[tuple(w[i : i + window])] < key:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out[key, len(w), len(gone), kept] += 1
    return out


def shingles(text: str | None, n: int = 5) -> frozenset:
    w = words((text or "").encode().translate(LOWER).decode())
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def near(docs: list[tuple], n: int = 5, percent: int = 80) -> Counter:
    """(id, n_shingles, component) of each row."""
    sets = [(key, shingles(text, n)) for key, text in docs]
    low = {key: key for key, _ in sets if key is not None}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                u, v = find(a), find(b)
                low[max(u, v)] = min(u, v)
    return Counter((key, len(s), None if key is None else find(key)) for key, s in sets)


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            lines += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""), lines, len(covered)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def repeated_lines(docs: list[tuple]) -> Counter:
    """(id, text left, n_lines, n_removed_lines) of each row: lines of pairs that an earlier document or the own text before has."""
    split = [(key, None if text is None else text.split("\n")) for key, text in docs]
    first: dict[tuple, int] = {}
    for key, x in split:
        for pair in zip(x or (), (x or ())[1:]) if key is not None else ():
            first[pair] = min(key, first.get(pair, key))
    out = Counter()
    for key, x in split:
        gone, seen = set(), {}
        for i, pair in enumerate(zip(x or (), (x or ())[1:]) if key is not None else ()):
            if first[pair] < key or i >= seen.setdefault(pair, i) + 2:
                gone |= {i, i + 1}
        left = None if x is None else "\n".join(line for i, line in enumerate(x) if i not in gone)
        out[key, left, len(x or ()), len(gone)] += 1
    return out


def repeated_pairs(docs: list[tuple]) -> dict[int, set[int]]:
    """Lines of each document that stand in a block of two lines or more which an earlier document, or the own text, has before."""
    split = [(k, (text or "").split("\n")) for k, text in docs]
    first: dict[tuple, int] = {}
    for key, x in split:
        for pair in zip(x, x[1:]):
            first[pair] = min(key, first.get(pair, key))
    out = {}
    for key, x in split:
        gone, seen = set(), {}
        for i, pair in enumerate(zip(x, x[1:])):
            if first[pair] < key or i >= seen.setdefault(pair, i) + 2:
                gone |= {i, i + 1}
        out[key] = gone
    return out


def contamination(docs: list[tuple], items: list[tuple], window: int = 10) -> Counter:
    """(id, n_words, n_hit, items) of each row."""
    import re

    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def cut(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(fold))

    owners: dict[tuple, set] = {}
    for item, text in items:
        w = cut(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1) if w else ():
            owners.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = Counter()
    for key, text in docs:
        w, hit, found = cut(text), set(), set()
        for size in {len(x) for x in owners}:
            for i in range(len(w) - size + 1):
                if (own := owners.get(tuple(w[i : i + size]))) is not None:
                    hit |= set(range(i, i + size))
                    found |= own
        out[key, len(w), len(hit), tuple(sorted(x for x in found if x is not None))] += 1
    return out


def variants(words: dict[str, int], min_length: int = 7, min_count: int = 2, times: int = 10) -> dict[str, tuple]:
    """word to (form, root, n, n_near, form_n)."""
    words = {w: n for w, n in words.items() if len(w) >= min_length and n >= min_count}

    def near(a: str, b: str) -> bool:
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    close = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, found in close.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(close[w]), words.get(form[w])) for w, n in words.items()}


def trie(convs: dict[int, list[tuple[str, str]]]) -> Counter:
    """(conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends) of every node."""
    members: dict[tuple, list] = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, who in members.items():
        own = (len(who) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += own
    out = Counter()
    for p, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(convs[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out[min(who), len(p), parent, len(who), children[p], leaves[p], saved[p], sha(ends)] += 1
    return out
