"""MinHash near-dedup: universal hash minima, banding, verification on full sets, components."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.llm import vec
from lathework.llm.components import hot_keys, stars
from lathework.llm.runtime import arrow, prepare, stage_table

#: Bands of ROWS minima each. A pair of similarity 0.85 shares no band with chance (1 - 0.85**5)**32, about 7e-9.
BANDS, ROWS = 32, 5
#: Pairs whose signatures agree less than the threshold by this many standard deviations are not verified.
DEVIATIONS = 4
#: Bins of the fine signature, one byte each: the smallest hash of a bin.
BINS_LOG = 9
#: Waves of comparison after the first stars: the likeliest pair of each member in its block, then every pair.
WAVES = (False, True)
#: Members of a bucket that one task compares with as many others; partners of a document that one task verifies.
CELL, PARTNERS = 384, 96

_draw = np.random.default_rng(20240229)
MUL = _draw.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
ADD = _draw.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
SEED = _draw.integers(0, 1 << 63, BANDS, dtype=np.uint64)


def sets_of(docs: list[bytes], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    for i, j in vec.blocks(docs):
        b = vec.Block(docs[i:j])
        b.words(vec.NOT_SPACE)
        h, at = vec.shingles(b, width)
        for k in range(b.n):
            yield np.unique(h[at[k] : at[k + 1]])


def minima(x: np.ndarray) -> np.ndarray:
    """Minimum of every hash function a * x + b mod 2**32 over the set."""
    u = (x >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(MUL), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(u), 2048):
        part = np.multiply.outer(MUL, u[k : k + 2048])
        part += ADD[:, None]
        np.minimum(out, part.min(1), out=out)
    return out


def fine_signature(x: np.ndarray) -> bytes:
    """A byte of the smallest hash in each bin, 0 in empty ones; ``x`` is sorted and its leading bits name the bin."""
    out = np.zeros(1 << BINS_LOG, np.uint8)
    bins = (x >> np.uint64(64 - BINS_LOG)).astype(np.int64)
    first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1])[: len(x)])
    out[bins[first]] = ((x[first] >> np.uint64(8)) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    return out.tobytes()


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = vec.texts(batch.column(1))
            if not docs:
                continue
            n, h1, h2, signature, fine, bands = [], [], [], [], [], []
            for x in sets_of(docs, width):
                n.append(len(x))
                h1.append(np.bitwise_xor.reduce(vec.mix(x + vec.MIX_1)) if len(x) else np.uint64(0))
                h2.append(vec.mix(x ^ vec.MIX_2).sum(dtype=np.uint64))
                fine.append(fine_signature(x))
                m = minima(x)
                signature.append(((m * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes())
                wide = m.reshape(BANDS, ROWS).astype(np.uint64)
                key = SEED.copy()
                for k in range(ROWS):
                    key = vec.mix(key * np.uint64(vec.BASE_A) + wide[:, k])
                bands.append(key.view(np.int64))
                fine[-1] += key.tobytes()
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, len(n) * BANDS + 1, BANDS, dtype=np.int32)), pa.array(np.concatenate(bands)))
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(np.array(h1, np.uint64).view(np.int64)), pa.array(np.array(h2, np.uint64).view(np.int64)), pa.array(signature, pa.binary()), pa.array(fine, pa.binary()), flat]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n", "h1", "h2", "sig", "fine", "bands"])

    return run


def _agreement(a: pa.Array, b: pa.Array) -> np.ndarray:
    k = BANDS * ROWS
    x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(-1, k) for c in (a, b))
    return (x == y).mean(1)


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(_agreement(batch.column(2), batch.column(3)))], ["a", "b", "e"])


def likeness(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Estimated similarity by signatures; bins that are empty on both sides don't count."""
    full = (many > 0) | (one > 0)
    return ((many == one) & full).sum(1) / np.maximum(full.sum(1), 1)


def _cells(least: float, ratio: float, every: bool):
    """Pairs of different components within a cell whose signatures and sizes allow a link; cells arrive in order.

    Unless ``every`` pair is asked for, each member outside the cell's largest component gives its likeliest pair.
    A pair that meets in several buckets is given in that of its first common band only.
    """

    def pairs(key: tuple, held: list[tuple]) -> pa.RecordBatch:
        block, rep, comp, n = (np.array([h[k] for h in held], np.int64) for k in range(4))
        sig = np.frombuffer(b"".join(h[4] for h in held), np.uint8).reshape(len(held), -1)
        if every:
            sig, bands = sig[:, : 1 << BINS_LOG], np.ascontiguousarray(sig[:, 1 << BINS_LOG :]).view(np.int64)
        kinds, inverse, count = np.unique(comp, return_inverse=True, return_counts=True)
        small = inverse != count.argmax()
        left, right = np.flatnonzero(block == key[1]), np.flatnonzero(block == key[2])
        out: list[tuple[int, int, float]] = []
        for i in np.flatnonzero(small):
            to = right if block[i] == key[1] else left
            to = to[comp[to] != comp[i]]
            if every:  # a pair of two small members is met from both sides
                to = to[~small[to] | (rep[to] > rep[i])]
            to = to[np.minimum(n[to], n[i]) >= ratio * np.maximum(n[to], n[i]) - 1e-9]
            e = likeness(sig[i], sig[to]) if every else (sig[to] == sig[i]).mean(1)
            to, e = to[e >= least], e[e >= least]
            if every and len(to):
                here = bands[i][(bands[to] == bands[i]).argmax(1)] == key[0]
                to, e = to[here], e[here]
            elif len(to):
                best = np.lexsort((rep[to], -e))[:1]
                to, e = to[best], e[best]
            out += [(int(rep[i]), int(rep[k]), float(x)) for k, x in zip(to, e, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.float64())], ["b", "a", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != now:
                    if len(held) > 1:
                        yield pairs(now, held)
                    now, held = row[:3], []
                held.append(row[3:])
        if len(held) > 1:
            yield pairs(now, held)

    return run


def _confirm(width: int, share: Fraction):
    """Links between a document (role 0, first of its cell) and its partners (role 1), on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, centre = None, []
        for batch in batches:
            a, chunk, role, b = (batch.column(k).to_pylist() for k in range(4))
            found = []
            for k, x in enumerate(sets_of(vec.texts(batch.column(4)), width)):
                if (a[k], chunk[k]) != now:
                    now, centre = (a[k], chunk[k]), []
                if role[k] == 0:
                    centre.append(x)
                    continue
                for c in centre:
                    both = len(np.intersect1d(c, x, assume_unique=True))
                    if share.denominator * both >= share.numerator * (len(c) + len(x) - both):
                        found.append((a[k], b[k]))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], ["a", "b"])

    return run


def confirmed(pairs: DataFrame, plain: DataFrame, width: int, share: Fraction) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts are similar enough. A document's partners are verified by one task; those of
    a hot one by many, their number growing with the root of its partners, as each of them needs its text."""
    hot = hot_keys(pairs.groupBy("a").agg(F.count("*").alias("k")), pairs.count(), PARTNERS)
    hot = F.broadcast(hot.select("a", F.ceil(F.col("k") / F.greatest(F.lit(PARTNERS), 3 * F.sqrt("k"))).alias("parts")))
    right = pairs.join(hot, "a", "left").select("a", F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).alias("chunk"), F.lit(1).alias("role"), F.col("b").alias("doc_id"))
    left = right.select("a", "chunk").distinct().select("a", "chunk", F.lit(0).alias("role"), F.col("a").alias("doc_id"))
    rows = left.unionByName(right).join(plain, "doc_id").select("a", "chunk", "role", "doc_id", "text")
    return rows.repartition("a", "chunk").sortWithinPartitions("a", "chunk", "role").transform(arrow, _confirm(width, share), "a long, b long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents whose sets of ``width``-word shingles have a Jaccard similarity of ``percent`` or more.

    Equal sets are one class from the start. Classes that share a band meet in its bucket: each is first verified
    against the one of the buckets' smallest members that its signature likes best; then the members of a bucket that
    are not in one component yet are compared in blocks by signature, and what may be similar is verified on full
    sets: the likeliest pair of each member first, as that joins most of them, at last every pair. No bucket is
    capped, and no pair inside a component is looked at. Returns ``doc_id, n_shingles,
    component_id, kept``, a row for each row of ``docs``; the kept document of a group has its smallest id.

    Null texts and texts without words have no shingles, are kept and linked with nothing; very long texts are compared
    by their whole sets. Equally likely partners count by the smaller id. Rows of one id count as
    one document that links by any of its texts; a null id is linked with nothing. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    share = Fraction(percent, 100)
    slack = float(share) - DEVIATIONS * (float(share) * (1 - float(share)) / (BANDS * ROWS)) ** 0.5
    sharp = float(share) - DEVIATIONS * (float(share) * (1 - float(share)) / (1 << BINS_LOG)) ** 0.5
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = stage_table(plain.transform(arrow, _sketch(width), "doc_id long, n long, h1 long, h2 long, sig binary, fine binary, bands array<long>"), "sketches")
    some = sketch.where("n > 0 and doc_id is not null")
    classes = stage_table(some.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep")), "classes")
    key = ["doc_id", "h1", "h2", "n"]
    reps = some.select(*key, "bands").join(classes.select(F.col("rep").alias("doc_id"), "h1", "h2", "n"), key).dropDuplicates(key)

    keyed = reps.select(F.col("doc_id").alias("rep"), F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("rep").alias("c"), F.max("rep").alias("z"), F.count("*").alias("k")).where("c <> z").drop("z")
    members = stage_table(keyed.join(stage_table(shared, "buckets"), "key"), "members")

    known = some.select(F.col("doc_id").alias("rep"), "n", "sig")
    finely = some.select(F.col("doc_id").alias("rep"), "n", F.col("fine").alias("sig"))

    def sized(pairs: DataFrame) -> DataFrame:
        """Joins the sizes and signatures of both sides."""
        one = known.toDF("a", "na", "siga")
        two = known.toDF("b", "nb", "sigb")
        fits: Column = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
        return pairs.join(one, "a").join(two, "b").where(fits).select("a", "b", "siga", "sigb")

    star = members.where("rep <> c").select(F.col("rep").alias("b"), F.col("c").alias("a")).distinct()
    liked = sized(star).transform(arrow, _estimate, "a long, b long, e double").where(F.col("e") >= slack)
    best = liked.groupBy("b").agg(F.max_by("a", F.struct("e", -F.col("a"))).alias("a")).select("a", "b")
    edges = stars(confirmed(stage_table(best, "pairs"), plain, width, share))

    def centres() -> DataFrame:
        """What each document but the centres themselves hangs on."""
        return edges.select(F.col("a").alias("rep"), F.col("b").alias("component"))

    parts = F.ceil(F.col("k") / CELL).cast("int")
    for every in WAVES:
        placed = members.join(centres(), "rep", "left").select("key", "rep", "k", F.coalesce("component", "rep").alias("comp"))
        placed = stage_table(placed, "placed")
        mixed = placed.groupBy("key").agg(F.min("comp").alias("c"), F.max("comp").alias("z")).where("c <> z").select("key")
        mixed = stage_table(mixed, "mixed")
        if mixed.isEmpty():
            break
        blocked = placed.join(mixed, "key").withColumn("parts", parts).withColumn("block", F.pmod(F.xxhash64("rep"), "parts").cast("int"))
        cells = blocked.join(finely if every else known, "rep")
        cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)) if every else F.col("block"))
        cells = cells.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "comp", "n", "sig")
        likely = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").transform(arrow, _cells(sharp if every else slack, percent / 100, every), "b long, a long, e double")
        if every:
            likely = likely.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a")).distinct()
        else:
            likely = likely.groupBy("b").agg(F.max_by("a", F.struct("e", -F.col("a"))).alias("a"))
        more = confirmed(stage_table(likely.select("a", "b"), "pairs"), plain, width, share)
        edges = stars(edges.unionByName(more))

    out = sketch.select("doc_id", "n", "h1", "h2").join(classes, ["h1", "h2", "n"], "left").join(centres(), "rep", "left")
    component = F.coalesce("component", "rep", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
