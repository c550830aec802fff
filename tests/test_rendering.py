from __future__ import annotations

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from lathework.operators import registry
from lathework.operators import rendering as R


def test_layout():
    block, boxes = R.stack([np.ones((20, 100), np.uint8), np.ones((20, 60), np.uint8)], 4, "center")
    assert block.shape == (44, 100) and boxes == [(0, 0, 100, 20), (20, 24, 80, 44)]
    assert R.rotated(np.full((4, 10), 255, np.uint8), 90).shape[0] >= 10 and (R.rotated(np.full((4, 10), 255, np.uint8), 90) > 0).sum() >= 36


def test_render():
    clean = np.full((200, 400, 3), 90, np.uint8)
    r = R.render(clean, "ab\nc d", (0.5, 0.8), opacity=0.8, degrees=5)
    assert r.pairing.ok and r.pairing.changed_box is not None and (r.image != clean).any() and r.mask.sum() > (r.alpha > 0).sum()
    for text, center in (("a\n \nb", (0.5, 0.5)), ("a", (0.0, 0.5))):
        with pytest.raises(ValueError):
            R.render(clean, text, center)


def test_fonts():
    latin, all_ = R.Font("latin", frozenset(range(128))), R.Font("all", frozenset(range(70000)), False)
    assert R.choose_font("a b", [latin, all_]) == (latin, {})
    assert R.choose_font("aé", [latin, all_], training_only=False) == (all_, {"latin": ["é"]})
    for text in ("é", "\U0001f600"):
        with pytest.raises(ValueError):
            R.choose_font(text, [latin, all_])


def test_registry(spark):
    schema = "source_id string, license_status string, allowed_to_download boolean, allowed_for_derivative_work boolean, allowed_for_ml_training boolean, authorization_start_at date, authorization_expire_at date, n int"
    day = date.fromisoformat
    rows = [("a", "authorized", True, True, True, day("2026-01-01"), day("2026-12-31"), 1), ("a", "unknown", True, True, True, day("2026-02-01"), day("2026-01-01"), 2), ("b", "authorized", True, True, None, None, None, 3)]
    df = spark.createDataFrame(rows, schema)
    why = lambda d: {r.n: len(r.reasons) for r in registry.authorised(df, F.lit(d).cast("date")).collect()}
    assert why("2026-12-31")[1] == 0 and why("2027-01-01")[1] == 1 and why("2025-12-31")[1] == 1 and why("2026-06-01") == {1: 0, 2: 2, 3: 1}
    got = sorted(tuple(r) for r in registry.registry_violations(df, "n").collect())
    assert [g[1] for g in got] == ["source_id is repeated", "the window ends before it begins", "training needs an authorised license"]
    left, right = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x")], "k int, v string")
    assert registry.join_all(left.where("k = 1"), right, ["k"]).first().v == "x"
    with pytest.raises(Exception, match="no partner"):
        registry.join_all(left, right, ["k"]).collect()
    assert spark.range(1).select(registry.basename(F.lit("a/b/c.png")).alias("v")).first().v == "c.png"
