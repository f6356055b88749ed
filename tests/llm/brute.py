"""Plain Python versions of the operators, over small inputs."""

import math
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(nodes, links):
    """node -> smallest node reachable."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicates(rows):
    """(id, text) with unique ids -> id: (set size, component)."""
    sets = {i: shingles(t) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    links = set()
    for i, s in sets.items():
        common = defaultdict(int)
        for x in s:
            for j in holders[x]:
                if j > i:
                    common[j] += 1
        links |= {(i, j) for j, n in common.items() if 100 * n >= 75 * (len(s) + len(sets[j]) - n)}
    found = components(sets, links)
    return {i: (len(sets[i]), found[i]) for i in sets}


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True)) / (math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b)))


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
