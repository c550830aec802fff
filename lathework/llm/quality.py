"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.llm import vec
from lathework.llm.runtime import arrow, prepare, stage_table

#: Each of these gives a share of the bytes.
KINDS = {
    "upper": vec.table(lambda b: 65 <= b <= 90),
    "lower": vec.table(lambda b: 97 <= b <= 122),
    "digit": vec.table(lambda b: 48 <= b <= 57),
    "stop": vec.table(lambda b: b in b".,;:?"),
    "bang": vec.table(lambda b: b in b"!"),
    "bar": vec.table(lambda b: b in b"|<>{}[]_=/\\"),
    "symbol": vec.table(lambda b: b in b"#$%&*@^~+"),
    "other": vec.table(lambda b: b >= 0x80),
    "space": vec.table(lambda b: b in b" \t\r"),
}
N_FEATURES = len(KINDS) + 9
#: Prediction is 1 from this score on.
CUT = 0.3


def distinct(doc: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """Distinct keys of each document; two keys of one document share their upper 44 bits with negligible chance."""
    if not len(key):
        return np.zeros(n)
    both = np.sort((doc.astype(np.uint64) << np.uint64(44)) | (key >> np.uint64(20)))
    new = np.append(True, both[1:] != both[:-1])
    return np.bincount((both[new] >> np.uint64(44)).astype(np.int64), minlength=n).astype(float)


def features(docs: list[bytes]) -> np.ndarray:
    """Transformed statistics of whole texts: shares by their square root, counts and lengths by log(1 + x)."""
    b = vec.Block(docs, lower=False)
    b.words(vec.NOT_SPACE)
    size = np.maximum(b.size, 1)
    edges = np.append(b.first, len(b.buf))
    share = []
    for kind in KINDS.values():
        run = np.concatenate(([0], np.cumsum(kind[b.buf], dtype=np.int64)))
        share.append((run[b.first + b.size] - run[b.first]) / size)
    n = np.maximum(b.count, 1)
    length = (b.end - b.start).astype(float)
    word_sum = np.bincount(b.doc, length, b.n)
    word_sq = np.bincount(b.doc, length**2, b.n)
    mean = word_sum / n
    # lines are words of everything but the line feed
    line_edge = np.flatnonzero(b.buf == 10)
    line_start = np.sort(np.concatenate((b.first, line_edge + 1)))
    line_doc = np.searchsorted(edges, line_start, "right") - 1
    keep = (line_doc >= 0) & (line_doc < b.n)
    line_start, line_doc = line_start[keep], line_doc[keep]
    stop = np.append(line_start[1:] - 1, len(b.buf) - 1)
    run = vec.prefix(b.buf)
    line_key = vec.spans(run, line_start, np.maximum(stop, line_start))
    lines = np.maximum(np.bincount(line_doc, minlength=b.n), 1)
    first_upper = KINDS["upper"][b.buf[b.start]] if len(b.start) else np.zeros(0)
    last_odd = (KINDS["symbol"] | KINDS["bang"] | KINDS["bar"])[b.buf[b.end - 1]] if len(b.end) else np.zeros(0)
    out = [
        *(np.sqrt(s) for s in share),
        np.log1p(b.size), np.log1p(b.count), np.log1p(mean), np.sqrt(np.maximum(word_sq / n - mean**2, 0)) / (1 + mean),
        np.sqrt(distinct(b.doc, b.word, b.n) / n), np.sqrt(distinct(line_doc, line_key, b.n) / lines), np.log1p(lines),
        np.sqrt(np.bincount(b.doc, first_upper, b.n) / n), np.sqrt(np.bincount(b.doc, last_odd, b.n) / n),
    ]
    return np.stack(out, 1).astype(np.float32)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = vec.texts(batch.column(1))
        parts = [features(docs[i:j]) for i, j in vec.blocks(docs)]
        if parts:
            x = np.concatenate(parts)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, N_FEATURES, dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), flat], ["doc_id", "th", "x"])


@dataclass
class Model:
    """Standardised class means, Cholesky factors of the shrunk covariances, and constants of the log densities."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    logs: list[float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        density = [c - 0.5 * (np.linalg.solve(f, (z - m).T) ** 2).sum(0) for m, f, c in zip(self.means, self.factors, self.logs, strict=True)]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def fit(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], pool: float, ridge: float) -> Model:
    """From count, sum and sum of outer products of each class. A class without rows has the density of the other."""
    k = N_FEATURES
    n = {c: sums.get(c, (0.0, np.zeros(k), np.zeros((k, k)))) for c in (0, 1)}
    total = max(n[0][0] + n[1][0], 1.0)
    centre = (n[0][1] + n[1][1]) / total
    second = (n[0][2] + n[1][2]) / total - np.outer(centre, centre)
    scale = np.sqrt(np.maximum(np.diag(second), 1e-6))
    norm = np.outer(scale, scale)
    raw, means = {}, {}
    for c in (0, 1):
        m, s, q = n[c]
        mean = s / m if m else centre
        means[c] = (mean - centre) / scale
        raw[c] = (q / m - np.outer(mean, mean)) / norm if m else np.eye(k)
    both = sum(raw[c] * n[c][0] for c in (0, 1)) / total if n[0][0] + n[1][0] else np.eye(k)
    factors, logs = [], []
    for c in (0, 1):
        cov = (1 - pool) * raw[c] + pool * both
        cov = (1 - ridge) * cov + ridge * np.eye(k) * max(np.trace(cov) / k, 1e-3)
        factors.append(np.linalg.cholesky(cov))
        logs.append(np.log((n[c][0] + 1) / (total + 2)) - np.log(np.diag(factors[-1])).sum())
    return Model(centre, scale, [means[0], means[1]], factors, logs)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = {c: np.zeros((N_FEATURES + 1, N_FEATURES + 1)) for c in (0, 1)}
    for batch in batches:
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES).astype(float)
        y = batch.column(1).to_numpy(zero_copy_only=False)
        for c in (0, 1):
            one = np.hstack((np.ones(((y == c).sum(), 1)), x[y == c]))
            held[c] += one.T @ one
    for c in (0, 1):
        yield pa.RecordBatch.from_arrays([pa.array(np.full(held[c].size, c, np.int32)), pa.array(np.arange(held[c].size, dtype=np.int32)), pa.array(held[c].ravel())], ["y", "i", "v"])


def score_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", pool: float = 0.3, ridge: float = 0.02) -> DataFrame:
    """Score whole texts by a quadratic discriminant learnt from ``labels`` (doc_id, quality).

    Every labelled row outside the held-out fifth counts; only sums by class, of a size fixed by the number of
    features, reach the driver. Texts are read once: their statistics are staged in the shared folder. Returns
    ``doc_id, held_out, score, predicted, th``; the last is a hash of the text.

    Null and empty texts have the statistics of no bytes and are scored alike; very long texts are read whole. Equal
    densities give 0.5. Labels other than 0 and 1 and labels
    without a document are ignored; without labels every score is 0.5. Repeated rows are each scored; other columns
    are ignored.
    """
    prepare(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    measured = stage_table(plain.transform(arrow, _measure, "doc_id long, th long, x array<float>"), "statistics")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    known = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("y"))
    train = measured.where(~held).join(known, "doc_id").select("x", "y")
    rows = train.transform(arrow, _moments, "y int, i int, v double").groupBy("y", "i").agg(F.sum("v").alias("v")).collect()
    flat = {c: np.zeros((N_FEATURES + 1) ** 2) for c in (0, 1)}
    for r in rows:
        flat[r.y][r.i] = r.v
    square = {c: m.reshape(N_FEATURES + 1, -1) for c, m in flat.items()}
    model = fit({c: (m[0, 0], m[0, 1:], m[1:, 1:]) for c, m in square.items()}, pool, ridge)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES).astype(float)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.scores(x))], ["doc_id", "th", "score"])

    scored = measured.transform(arrow, score, "doc_id long, th long, score double")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "th")
