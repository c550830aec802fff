from __future__ import annotations

import random

import numpy as np

import corpus_pipeline
from lathework.llm.pieces import MODEL, Vocabulary
from tests.llm.test_neardup import brute as near_brute
from tests.llm.test_repeats import brute as repeat_brute


def test_stages_in_turn(spark, tmp_path):
    """Each stage against what brute force makes of what the stage before it left."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abdeghilmnorst") for _ in range(rng.randint(2, 8)))
    say = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    junk = lambda n: " ".join(word().upper() + "!!" for _ in range(n))
    item, other, passage = say(20), say(15), say(90)
    rows = [(k, say(rng.randint(20, 120))) for k in range(60)] + [(k, junk(rng.randint(20, 120))) for k in range(60, 90)]
    rows += [(100, rows[3][1]), (101, rows[4][1] + " more"), (102, say(30) + passage), (103, say(40) + passage + say(5)), (104, say(9) + item + say(9)), (105, item + other), (106, None), (107, ""), (108, say(20000))]
    docs = spark.createDataFrame([(k, t, "en", "s", None if t is None else len(t), 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long, th int")
    spark.createDataFrame([(k, int(k < 60), 0) for k in range(0, 90)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, other)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs.drop("th") if name == "quality" else docs, str(tmp_path)).write.parquet(f"{tmp_path}/out-{name}")
        docs = spark.read.parquet(f"{tmp_path}/out-{name}")
        if name != "tokens":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            left[name] = {r.doc_id: r.text for r in docs.collect()}
            assert all(r.n_chars is None or r.n_chars == len(r.text) for r in docs.collect())
    assert not set(left["quality"]) & set(range(60, 90)) and set(left["quality"]) >= {*range(60), *range(100, 106), 108}
    stays = {k for k, _, _, kept in near_brute(list(left["quality"].items()), 80) if kept}
    assert set(left["near_dedup"]) == stays and not stays & {100, 101}
    gone = {r[0]: r[2] for r in repeat_brute(list(left["near_dedup"].items()), 400)}
    assert {k: len((t or "").encode()) for k, t in left["suffix_dedup"].items()} == {k: len((t or "").encode()) - gone[k] for k, t in left["near_dedup"].items()}
    assert gone[102] and gone[103]
    clean = left["decontamination"]
    assert 105 not in clean and item[:-1] not in clean[104] and clean[5] == left["suffix_dedup"][5]
    assert set(clean) == set(left["suffix_dedup"]) - {105}
    with open(MODEL, "rb") as f:
        v = Vocabulary(f.read())
    ids: dict = {}
    for r in docs.orderBy("doc_id", "chunk").collect():
        ids[r.doc_id] = ids.get(r.doc_id, b"") + bytes(r.ids)
        assert r.n_tokens == len(np.frombuffer(r.ids, "<i4"))
    assert {k: v.decode(x)[1:].decode() for k, x in ids.items()} == {k: t or "" for k, t in clean.items()}


def test_repeats_of_51_words_are_cut(spark):
    """A passage of over 50 words goes however few bytes it has; one of 50 words under 400 bytes stays."""
    rng = random.Random(22)
    word = lambda: "".join(rng.choice("abdeghilmnorst") for _ in range(rng.randint(2, 6)))
    say = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    passage, brief, short = say(51), " ".join(rng.choice("ab") for _ in range(51)), say(50)
    assert max(map(len, (passage, brief, short))) < 400
    rows = [(1, say(60) + passage + say(60)), (2, say(9) + passage), (3, say(30) + brief + "."), (4, brief + ". " + say(30)), (5, say(40) + short), (6, short + say(40))]
    docs = spark.createDataFrame([(k, t, "en", "s") for k, t in rows], "doc_id long, text string, lang string, source string")
    left = {r.doc_id: r.text for r in corpus_pipeline.suffix_dedup(spark, docs, "").collect()}
    assert left[1] == rows[0][1].replace(passage[:-1], "") and left[2] == rows[1][1].replace(passage[:-1], "")
    assert brief not in left[3] and brief not in left[4]
    assert left[5] == rows[4][1] and left[6] == rows[5][1]


def test_empty_tables_and_nulls(spark, tmp_path):
    """No documents give none; nulls in every column pass all stages, a document without id or text stays."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, rows in (("none", []), ("odd", [(None, None, None, None, None), (1, None, "en", None, 5), (2, "", None, "s", 0), (None, "a few words", "en", "s", 11)])):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        for t in ("labels", "benchmark"):
            spark.read.parquet(f"{tmp_path}/{t}.parquet").write.parquet(f"{tmp_path}/{name}/{t}.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert sorted(((r.doc_id, r.n_tokens > 0) for r in got), key=str) == sorted(((k, bool(t)) for k, t, *_ in rows), key=str)
