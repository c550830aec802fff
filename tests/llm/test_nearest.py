from __future__ import annotations

import numpy as np

from lathework.llm.nearest import Cells, chi_square, nearest, unit


def test_chi_square():
    assert abs(chi_square(np.array([15.507]))[0] - 0.95) < 1e-3 and chi_square(np.array([0.0, np.inf])).tolist() == [0.0, 1.0]


def test_recall_and_edges(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((6, 16))
    data = [(int(k), [float(x) for x in np.float32(centre[k % 6] + rng.standard_normal(16) * 0.4)]) for k in range(700)]
    data += [(1000 + k, data[7][1]) for k in range(40)]
    odd = [(2000, None), (2050, []), (2100, [0.0] * 16), (2150, [float("nan")] * 16), (2200, [None] + [1.0] * 15), (2250, [float("inf")] + [1.0] * 15), (2300, [1.0, 2.0]), (None, [1.0] * 16)]
    d = spark.createDataFrame([(*r, 1) for r in data + odd], "vec_id long, embedding array<float>, rank int")
    for tree_rows in (None, 150):
        got: dict = {}
        for r in nearest(d, tree_rows=tree_rows).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.vec_id, r.score, r["rank"]))
        compare(data, got)
    few = {r.query_id: r.vec_id for r in nearest(d.where("vec_id in (50, 51)")).collect()}
    assert few == {50: 51}
    assert nearest(d.limit(0)).count() == 0


def compare(data, got):
    """Against all cosines: every query, five ranks each, true scores, and a recall of 0.9."""
    ids, v = np.array([r[0] for r in data]), np.array([r[1] for r in data])
    want_ids = {int(i) for i in ids if i % 50 == 0}
    assert set(got) == want_ids
    hits = 0
    for q in want_ids:
        i = int(np.flatnonzero(ids == q)[0])
        score = (v * v[i]).sum(1) / (np.sqrt((v[i] * v[i]).sum()) * np.sqrt((v * v).sum(1)))
        score[i] = -2
        best = np.lexsort((ids, -score))[:5]
        assert [g[2] for g in got[q]] == [1, 2, 3, 4, 5]
        assert all(abs(score[np.flatnonzero(ids == g[0])[0]] - g[1]) < 1e-12 for g in got[q])
        hits += len({int(ids[b]) for b in best} & {g[0] for g in got[q]})
    assert hits / (5 * len(want_ids)) >= 0.9


def test_cells():
    """Every vector is in one cell, its box holds its projection, and all copies of a vector share one."""
    v = np.random.default_rng(8).standard_normal((900, 12))
    c = Cells(v, 7, 17)
    cell, low = c.place(v), unit(v) @ c.axes
    assert len(np.unique(cell)) == 7 and np.bincount(cell).max() < 300
    assert ((low >= c.low_side[cell]) & (low <= c.high_side[cell])).all()
    same = Cells(np.repeat(v[:1], 500, 0), 7, 17)
    assert len(same.leaves) == 1 and set(same.place(v)) == {0}
    assert [len(x) for x in c.near(v[:2], np.array([-2.0, 1.0]))] == [7, 1]
