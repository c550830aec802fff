from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from lathework.llm import decontam
from lathework.llm.decontam import contamination, without_passages
from lathework.llm.fmindex import FMIndex
from lathework.llm.suffix import common_prefixes, pack, suffix_array


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for _ in range(60):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 90))) * rng.randint(1, 3)
        t = np.frombuffer(text, np.uint8)
        order = suffix_array(*pack(t))
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        lcp = common_prefixes(t, order)
        for k in range(1, len(text)):
            a, b = text[order[k - 1] :], text[order[k] :]
            n = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
            assert lcp[k] == n


def test_fm_index():
    rng = random.Random(2)
    text = np.array([rng.randint(1, 5) for _ in range(400)])
    index = FMIndex(text, 4)
    for m in range(1, 5):
        p = np.array([[rng.randint(1, 6) for _ in range(m)] for _ in range(30)])
        low, high = index.search(p, np.full(30, m))
        for k in range(30):
            want = [i for i in range(400 - m + 1) if (text[i : i + m] == p[k]).all()]
            assert sorted(index.locate(np.arange(low[k], high[k])).tolist()) == want


def words(t):
    return re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))


def brute(docs, items):
    wins = [(str(i), tuple(w[k : k + 8])) for i, t in items for w in [words(t)] for k in range(max(len(w) - 7, min(1, len(w))))]
    out = []
    for d, t in docs:
        w, hit, names = words(t), set(), set()
        for i, x in wins:
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit |= set(range(k, k + len(x)))
                    names.add(i)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), len(names) >= 2))
    return sorted(out, key=str)


@pytest.mark.parametrize("pass_bytes", [1 << 20, 90])
def test_contamination(spark, monkeypatch, pass_bytes):
    monkeypatch.setattr(decontam, "PASS_BYTES", pass_bytes)
    rng = random.Random(3)
    say = lambda n: " ".join(rng.choice(["the", "of", "Ab", "é9", "x"]) for _ in range(n))
    items = [(k, say(rng.choice([1, 2, 5, 9, 12]) if k else 1)) for k in range(12)] + [(20, None), (21, ""), (3, "the THE; the of")]
    docs = [(k, say(rng.randint(0, 60)) + rng.choice(["", "!? " + items[k % 12][1]])) for k in range(80)] + [(90, None), (91, ""), (5, "the"), (5, "the"), (None, "x x")]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, n_words int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in contamination(d, b).collect()), key=str)
    assert got == brute(docs, items)
    assert contamination(d.limit(0), b).count() == 0
    assert {r.n_items for r in contamination(d, b.limit(0)).collect()} == {0}


def test_cut(spark):
    d = spark.createDataFrame([(1, "Keep a b c d e f g h, é"), (2, None), (3, "a b c d e f g")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "A b c d e f g h")], "item_id long, text string")
    assert {r.doc_id: (r.text, r.n_items) for r in without_passages(d, b).collect()} == {1: ("Keep , é", 1), 2: (None, 0), 3: ("a b c d e f g", 0)}
