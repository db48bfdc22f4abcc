"""Plain Python versions of what the operators compute."""

import re


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[ \\t\\n\\r\\v\\f]+", words) if w]
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def groups(sets):
    """Smallest id of each group, by comparing all pairs that share a shingle."""
    by_shingle = {}
    for i, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        for j in {j for x in s for j in by_shingle[x] if j < i}:
            shared = len(s & sets[j])
            if 100 * shared >= 80 * (len(s) + len(sets[j]) - shared):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in sets}
