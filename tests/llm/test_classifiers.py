from __future__ import annotations

import zlib

import numpy as np
import pytest

from lathework.llm.langid import Trees, identify_language
from lathework.llm.quality import N_FEATURES, features, fit, score_quality

SF = "/root/testdata/sf0.01"
ODD = [(9000001, None), (9000002, ""), (9000003, "12 %% 34"), (9000004, "é"), (9000005, "The " * 50000), (None, "of the"), (3, "again")]


@pytest.fixture(scope="module")
def docs(spark):
    odd = spark.createDataFrame([(k, t, None, None, None) for k, t in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    return spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd).withColumnRenamed("n_chars", "score")


def test_language(spark, docs):
    got = identify_language(docs).collect()
    assert len(got) == 1000 + len(ODD) and all(0 <= r.score <= 1 for r in got)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in got if r.held_out and truth[r.doc_id]]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    odd = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert odd[9000001] == odd[9000002] == odd[9000003] == ("und", 0.0) and odd[9000005][0] == "en" and odd[9000004][0] != "und"
    none = identify_language(docs.where("lang is null")).collect()
    assert {r.lang_pred for r in none} == {"und"} and identify_language(docs.limit(0)).count() == 0


def test_code_lengths():
    """Code lengths of one language against the escapes of a plain tree of counts."""
    text = b"   abcabcab the cat sat abca " * 9
    counts: dict = {}
    for i in range(3, len(text)):
        counts[text[i - 3 : i + 1]] = counts.get(text[i - 3 : i + 1], 0) + 1
    code = np.array([int.from_bytes(k, "big") for k in counts])
    t = Trees(["x"], np.zeros(len(code), np.int64), code, np.array(list(counts.values())))
    alphabet = len({b for k in counts for b in k} | {32}) + 1

    def bits(context, symbol):
        own = {}
        for k, n in counts.items():
            if k[3 - len(context) : 3] == context:
                own[k[3]] = own.get(k[3], 0) + n
        if len(context) == 3 and sum(own.values()) < 48:
            return bits(context[1:], symbol)
        total, kinds = sum(own.values()), len(own)
        if symbol in own:
            return np.log2((total + kinds) / own[symbol])
        escape = np.log2((total + kinds) / kinds) if own else 0.0
        return escape + (bits(context[1:], symbol) if context else np.log2(alphabet))

    for probe in (b"abc the zcat", b"bbb"):
        padded = b"   " + probe
        padded += b" "  # the blank that ends a text
        want = sum(bits(padded[i - 3 : i], padded[i]) for i in range(3, len(padded)))
        assert t.lengths([probe])[0, 0] == pytest.approx(want, abs=1e-3)


def test_quality(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = score_quality(docs, labels).collect()
    assert len(got) == 1000 + len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([t == p for t, p in held]) > 0.95
    assert {r.score for r in score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert score_quality(docs.limit(0), labels).count() == 0


def test_discriminant():
    rng = np.random.default_rng(1)
    x = {c: rng.normal(c, 1 + c, (500, N_FEATURES)) for c in (0, 1)}
    m = fit({c: (500.0, v.sum(0), v.T @ v) for c, v in x.items()}, 0.3, 0.02)
    assert (m.scores(x[1]) > 0.5).mean() > 0.95 and (m.scores(x[0]) < 0.5).mean() > 0.95
    for k in (0, 1):  # the cached factors give the log densities of the shrunk covariances
        cov = m.factors[k] @ m.factors[k].T
        z = (x[0][:3] - m.centre) / m.scale - m.means[k]
        want = -0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) - 0.5 * np.linalg.slogdet(cov)[1]
        got = -0.5 * (np.linalg.solve(m.factors[k], z.T) ** 2).sum(0) - np.log(np.diag(m.factors[k])).sum()
        assert np.allclose(want, got)
    assert features([b"", b"a"]).shape == (2, N_FEATURES) and np.isfinite(features([b"", b" \n\n", b"x" * 1000])).all()
