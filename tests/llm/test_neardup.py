from __future__ import annotations

import random
import re

from lathework.llm.components import components
from lathework.llm.neardup import near_duplicates


def shingle_set(t):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, percent):
    sets = [(k, shingle_set(t)) for k, t in rows]
    up = {k: k for k, _ in sets}

    def top(a):
        while up[a] != a:
            a = up[a]
        return a

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if None not in (a, b) and x and 100 * len(x & y) >= percent * len(x | y) and top(a) != top(b):
                up[max(top(a), top(b))] = min(top(a), top(b))
    return sorted(((k, len(x), top(k), k == top(k)) for k, x in sets), key=str)


def test_against_brute_force(spark):
    rng = random.Random(11)
    rows = []
    base = [[rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(rng.choice([3, 8, 60, 150]))] for _ in range(12)]
    for k in range(220):
        w = list(base[0] if k % 3 == 0 else rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            w[rng.randrange(len(w))] = "n" + str(rng.randint(0, 9))
        rows.append((k, rng.choice([" ", "\n "]).join(w).upper() if k % 2 else " ".join(w)))
    rows += [(300, None), (301, ""), (302, " \t"), (303, None), (4, rows[4][1])]
    d = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n int")
    got = sorted((tuple(r) for r in near_duplicates(d, percent=85).collect()), key=str)
    assert got == brute(rows, 85)
    assert near_duplicates(d.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(40)] + [(rng.randint(50, 90), rng.randint(50, 90)) for _ in range(25)] + [(99, 99)]
    up = {n: n for e in edges for n in e}
    for _ in range(100):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in up.items() if any(k in e and e[0] != e[1] for e in edges)}
