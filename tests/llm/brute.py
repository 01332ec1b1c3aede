"""Plain versions of the operators, for small inputs."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def near_duplicates(rows, k, num, den=100):
    """Sorted (doc_id, n_shingles, component_id) of (doc_id, text) rows."""
    sets = []
    for doc, text in rows:
        w = words((text or "").translate(LOWER))
        sets.append((doc, frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()))
    index, groups = defaultdict(set), Union()
    for n, (doc, s) in enumerate(sets):
        if doc is not None:
            shared = defaultdict(int)
            for x in s:
                for m in index[x]:
                    shared[m] += 1
                index[x].add(n)
            for m, i in shared.items():
                if den * i >= num * (len(s) + len(sets[m][1]) - i):
                    groups.join(doc, sets[m][0])
    return sorted(((d, len(s), None if d is None else groups.find(d)) for d, s in sets), key=repr)


def without_repeats(rows, window=13):
    """(doc_id, n_words, kept words) of each row."""
    least = {}
    for doc, text in rows:
        w = words(text)
        if doc is not None:
            for i in range(len(w) - window + 1):
                key = tuple(w[i : i + window])
                least[key] = min(least.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = words(text)
        gone = set()
        if doc is not None:
            for i in range(len(w) - window + 1):
                if least[tuple(w[i : i + window])] < doc:
                    gone.update(range(i, i + window))
        out.append((doc, len(w), [x for i, x in enumerate(w) if i not in gone]))
    return out


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    times = defaultdict(int)
    for i in range(len(w) - 4):
        times[tuple(w[i : i + 5])] += 1
    cover = set()
    for i in range(len(w) - 4):
        if times[tuple(w[i : i + 5])] > 1:
            cover.update(range(i, i + 5))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(cover)
