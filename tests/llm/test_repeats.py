from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from lathework.llm.repeats import remove_repeats


def brute(rows, width):
    data = [(k, (t or "").encode()) for k, t in rows]
    count = Counter(d[i : i + width] for _, d in data for i in range(len(d) - width + 1))
    out = []
    for k, d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - width + 1):
            if count[d[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans = sum(1 for i in range(len(d)) if gone[i] and not (i and gone[i - 1]))
        out.append((k, len(d), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(d, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("part_bytes", [1 << 20, 300])
def test_against_brute_force(spark, part_bytes):
    rng = random.Random(7)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(30, 300))) for _ in range(6)]
    rows = []
    for k in range(120):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 3])):
            t[rng.randrange(len(t))] = rng.choice("xyz")
        rows.append((k, "".join(t) + rng.choice(["", base[0][5:60], "q" * 70])))
    rows += [(210, "ab" * 100 + "tail of its own"), (211, "line of text\n" * 30), (212, "x" + "line of text\n" * 9), (213, "once " + "p" * 43)]
    rows += [(200, None), (201, ""), (202, "short"), (5, rows[5][1]), (None, rows[6][1]), (None, "no copy of this text stands anywhere else, so it is kept"), (203, "w" * 41), (7, "other text for the same id " * 3)]
    d = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, len int")
    got = sorted((tuple(r)[:5] for r in remove_repeats(d, width=40, part_bytes=part_bytes).collect()), key=str)
    assert got == brute(rows, 40)
    assert remove_repeats(d.limit(0)).count() == 0


def brute_words(rows, width, words):
    data = [(k, (t or "").encode()) for k, t in rows]
    spans = [[m.span() for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", d)] for _, d in data]
    windows = [[(w[i][0], w[i + words - 1][1]) for i in range(len(w) - words + 1)] + [(-i - 1, i + width) for i in range(len(d) - width + 1)] for w, (_, d) in zip(spans, data, strict=True)]
    at = lambda a: a if a >= 0 else -a - 1
    count = Counter((a < 0, d[at(a) : z]) for (_, d), w in zip(data, windows, strict=True) for a, z in w)
    out = []
    for (k, d), w in zip(data, windows, strict=True):
        gone = bytearray(len(d))
        for a, z in w:
            if count[a < 0, d[at(a) : z]] > 1:
                gone[at(a) : z] = b"\1" * (z - at(a))
        out.append((k, len(d), sum(gone), hashlib.sha256(bytes(x for x, g in zip(d, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def test_windows_of_words(spark):
    rng = random.Random(9)
    say = lambda n: " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) + rng.choice(["", "", ",", "."]) for _ in range(n))
    base = [say(rng.randint(5, 60)) for _ in range(8)]
    rows = []
    for k in range(150):
        t = rng.choice(base).split(" ")
        for _ in range(rng.choice([0, 1, 2, 4])):
            t[rng.randrange(len(t))] = rng.choice(["X", "Yz", "q q"])
        rows.append((k, f"own {k} " + " ".join(t) + rng.choice(["", " " + rng.choice(base), "\n" + say(20)])))
    rows += [(200, None), (201, ""), (202, "a b"), (203, "a " * 40), (204, "tick tock " * 30), (205, "x y z w v u t s"), (206, "-x y z w v u t s!"), (5, rows[5][1]), (None, rows[6][1])]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in remove_repeats(d, width=60, words=8, part_bytes=300).collect()), key=str)
    assert got == brute_words(rows, 60, 8)
