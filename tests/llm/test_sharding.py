from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lathework.llm import sharding
from lathework.llm.sharding import Blocks, shard_documents, solve


def best_capacity(sizes, shards):
    """Smallest largest sum of at most ``shards`` runs, by dynamic programming."""
    sums = np.concatenate(([0], np.cumsum(sizes)))
    best = sums.copy()
    for _ in range(shards - 1):
        best = np.array([min(max(best[j], sums[i] - sums[j]) for j in range(i + 1)) for i in range(len(sums))])
    return int(best[-1])


def test_solve_is_minimax():
    rng = random.Random(1)
    for _ in range(60):
        sizes = np.array([rng.randint(1, 30) for _ in range(rng.randint(1, 40))])
        shards = rng.randint(1, 6)
        top, cuts, open_ = solve(Blocks([str(i) for i in range(len(sizes))], sizes, sizes, np.ones(len(sizes), np.int64)), shards)
        assert top == best_capacity(sizes, shards) and not open_ and len(cuts) <= shards + 1
        assert max(sizes[a:b].sum() for a, b in zip(cuts, cuts[1:], strict=False)) <= top


@pytest.mark.parametrize("digits", [1, 4])
def test_shards(spark, monkeypatch, digits):
    monkeypatch.setattr(sharding, "FIRST_DIGITS", digits)
    monkeypatch.setattr(sharding, "MORE_DIGITS", 1)
    rng = random.Random(2)
    rows = [(k, rng.choice("abcdé") * rng.randint(0, 60)) for k in range(400)] + [(1000 + k, "hot text " * 3) for k in range(200)]
    rows += [(2000, None), (2001, None), (2002, ""), (5, rows[5][1]), (None, "x")]
    d = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, shard int")
    got = shard_documents(d, 6).collect()
    assert len(got) == len(rows)
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((k, size(t), zlib.crc32((t or "").encode())) for k, t in rows)
    assert {r.law for r in got} == {"bytes"} and all(r.grown_shard is None for r in got)
    slots, groups, load = defaultdict(list), defaultdict(set), Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        groups[r.group_key].add(r.shard)
        load[r.shard] += r.size
    assert set(slots) <= set(range(6)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in groups.values())
    by_key = Counter()
    for _, t in rows:
        by_key["0" * 32 if t is None else hashlib.md5(t.encode()).hexdigest()] += size(t)
    hot = hashlib.md5(("hot text " * 3).encode()).hexdigest()
    assert load[0] == by_key[hot]  # above a fair share, so a shard of its own
    rest = [n for k, n in sorted(by_key.items()) if k != hot]
    assert max(n for s, n in load.items() if s) == best_capacity(rest, 5)
    assert shard_documents(d.limit(0)).count() == 0
    assert {r.shard for r in shard_documents(d.where("doc_id = 1"), 6).collect()} == {0}
