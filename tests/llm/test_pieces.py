from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from lathework.llm import pieces
from lathework.llm.pieces import MODEL, Vocabulary, compose, decode, encode, marked, piece_digests, states


@pytest.fixture(scope="module")
def vocabulary():
    with open(MODEL, "rb") as f:
        return Vocabulary(f.read())


def as_unigram(data: bytes) -> bytes:
    """The same model file with the library's search for the best sum of scores in place of merges."""
    at = data.rindex(b"tok_v0") + 6
    assert data[at : at + 2] == b"\x18\x02"
    return data[: at + 1] + b"\x01" + data[at + 2 :]


def worth(vocabulary, ids):
    score = {k: x for k, x in vocabulary.piece.values()}
    return sum(score.get(k, 0) for k in ids)


def every_way(vocabulary, text):
    if not text:
        yield []
    for n in range(1, len(text) + 1):
        if hit := vocabulary.piece.get(text[:n]):
            for rest in every_way(vocabulary, text[n:]):
                yield [hit[0], *rest]


def test_against_all_ways_and_the_library(vocabulary):
    """Never worse than any way of cutting; the library's own search, which now and then misses the best, mostly agrees."""
    with open(MODEL, "rb") as f:
        library = sentencepiece.SentencePieceProcessor(model_proto=as_unigram(f.read()))
    rng, same = random.Random(8), 0
    for _ in range(300):
        text = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 2)))
        own, other = vocabulary.encode([text.encode()])[0].tolist(), library.encode(text)
        assert worth(vocabulary, own) == max(worth(vocabulary, w) for w in every_way(vocabulary, marked(text))) >= worth(vocabulary, other)
        same += own == other
    assert same >= 295


def test_scan_is_the_whole_search(vocabulary):
    rng = random.Random(9)
    for size in (20, 33, 64):
        text = marked("".join(rng.choice("the cat\né") for _ in range(200)))
        n = len(text) // size
        cut = [(i * size, len(text) if i + 1 == n else (i + 1) * size) for i in range(n)]
        m = [vocabulary.transfer(text[a : z + vocabulary.longest - 1], z - a) for a, z in cut]
        left, right = compose(compose(m[0], m[1]), m[2]), compose(m[0], compose(m[1], m[2]))
        assert np.allclose(left, right)
        s = states(m)
        ids = b"".join(vocabulary.best(text[a : z + vocabulary.longest - 1], s[i], z - a + s[i + 1]) for i, (a, z) in enumerate(cut))
        assert vocabulary.decode(ids) == text.replace("▁", " ").encode()
        whole = vocabulary.best(text, 0, len(text))
        assert worth(vocabulary, np.frombuffer(ids, "<i4").tolist()) == worth(vocabulary, np.frombuffer(whole, "<i4").tolist())


def test_scan_of_words_is_the_whole_search(vocabulary):
    """Chunks of whole words are traced by their words; texts without words or with a giant one by every character."""
    rng, differ = random.Random(19), 0
    texts = [" ".join("".join(rng.choice("etaoinsh\né") for _ in range(rng.choice([1, 4, 9, 60]))) for _ in range(60)) for _ in range(16)]
    texts += ["x" * 400, " " * 400, ("ab" * 150 + " ") * 2, "a ▁ b" * 80]
    for t in texts:
        text, size = marked(t), rng.choice([90, 150, 260])
        n = len(text) // size
        cut = [(i * size, len(text) if i + 1 == n else (i + 1) * size) for i in range(n)]
        parts = [(text[a : z + vocabulary.longest - 1], z - a) for a, z in cut]
        full, short = [vocabulary.paths(*p) for p in parts], [vocabulary.transfer(*p) for p in parts]
        for f, k in zip(full, short, strict=True):  # the same up to a constant
            both = (f > pieces.NONE / 2) & (k > pieces.NONE / 2)
            assert ((f > pieces.NONE / 2) == (k > pieces.NONE / 2)).all() and np.ptp((f - k)[both]) < 1e-6
        s = states(short)
        ids = b"".join(vocabulary.trace(p, z, s[i], s[i + 1]) for i, (p, z) in enumerate(parts))
        whole = vocabulary.best(text, 0, len(text))
        assert vocabulary.decode(ids) == vocabulary.decode(whole)
        assert worth(vocabulary, np.frombuffer(ids, "<i4").tolist()) == worth(vocabulary, np.frombuffer(whole, "<i4").tolist())
        differ += ids != whole
    assert differ <= 2  # a word across a border with two equally good cuttings


def test_many_words_at_once(vocabulary):
    rng = random.Random(12)
    texts = ["".join(rng.choice("the cat\n  é日𝄞\x00▁zq") for _ in range(rng.randint(0, 90))) + "w" * (k % 60) for k in range(200)]
    flat, at = vocabulary.encode([t.encode() for t in texts])
    for k, t in enumerate(texts):
        own = flat[at[k] : at[k + 1]]
        assert own.tobytes() == (vocabulary.best(marked(t), 0, len(t) + 1) if t else b"")


def test_round_trip(spark, vocabulary):
    rng = random.Random(10)
    rows = [(k, "".join(rng.choice("the ox  runs\n\té日𝄞<0x0A>") for _ in range(rng.choice([5, 80, 299, 300, 2000])))) for k in range(14)]
    rows += [(20, None), (21, ""), (22, " "), (3, rows[3][1]), (23, "a▁b"), (None, "z" * 500), (None, "z" * 500)]
    d = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, chunk int")
    got = piece_digests(d, chunk=300).collect()
    assert len(got) == len(rows)
    assert all(r.round_trip == (r.doc_id != 23) for r in got)
    texts = dict(rows)
    back = {r.doc_id: r.text for r in decode(encode(d.where("doc_id is not null"), chunk=300)).collect()}
    assert all(back[k] == (t or "").replace("▁", " ") for k, t in texts.items() if k is not None)
    want = {k: vocabulary.best(marked(t), 0, len(t) + 1) if t else b"" for k, t in rows}
    for r in got:
        own = np.frombuffer(want[r.doc_id], "<i4").tolist()
        ids = np.frombuffer(r.ids, "<i4").tolist()
        assert r.ids_sha256 == hashlib.sha256(r.ids).hexdigest() and r.n_tokens == len(ids)
        assert ids == own or len(texts[r.doc_id]) > 300 and worth(vocabulary, ids) == worth(vocabulary, own)
    assert piece_digests(d.limit(0)).count() == 0
