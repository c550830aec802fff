"""Benchmark decontamination: an FM-index of each training shard, searched for the windows of the test items."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.llm import vec
from lathework.llm.fmindex import FMIndex
from lathework.llm.runtime import arrow, prepare

#: Words of a window; bytes of benchmark text searched in one pass; symbols of one shard's index.
WINDOW, PASS_BYTES, SHARD_SYMBOLS = 8, 16 << 20, 1 << 20
UNKNOWN = 1


@dataclass
class Windows:
    """Distinct windows of a part of the benchmark as symbols of its vocabulary, and the items that hold each."""

    vocabulary: np.ndarray
    pairs: np.ndarray
    single: np.ndarray
    patterns: np.ndarray
    length: np.ndarray
    at: np.ndarray
    items: list[str]


def windows(ids: list[str], texts: list[bytes]) -> Windows:
    b = vec.Block(texts)
    b.words(vec.ALNUM)
    vocabulary, symbol = np.unique(b.word, return_inverse=True)
    symbol = symbol + 2
    held: dict[tuple, set[str]] = {}
    for k in range(b.n):
        s = symbol[b.at[k] : b.at[k + 1]].tolist()
        for i in range(max(len(s) - WINDOW + 1, min(len(s), 1))):
            held.setdefault(tuple(s[i : i + WINDOW]), set()).add(ids[k])
    keys = list(held)
    patterns = np.array([(0,) * (WINDOW - len(x)) + x for x in keys], np.int64).reshape(-1, WINDOW)
    length = np.array([len(x) for x in keys], np.int64)
    both = (patterns[:, :-1] << 32) | patterns[:, 1:]
    single = np.zeros(len(vocabulary) + 2, bool)
    single[patterns[length == 1, -1]] = True
    at = np.concatenate(([0], np.cumsum([len(held[k]) for k in keys]))).astype(np.int64)
    return Windows(vocabulary, np.unique(both[patterns[:, :-1] > 0]), single, patterns, length, at, [i for k in keys for i in sorted(held[k])])


def among(sorted_: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether and where each x is in the sorted array."""
    if not len(sorted_):
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)
    return sorted_[at] == x, at


class Shard:
    """Symbols of some documents that can take part in a window, with what is needed to go back to their words."""

    def __init__(self, w: Windows):
        self.w, self.parts, self.size, self.docs = w, [], 0, 0

    def add(self, docs: list[bytes]) -> np.ndarray:
        """Takes the documents in; returns their numbers of words."""
        b = vec.Block(docs)
        b.words(vec.ALNUM)
        known, at = among(self.w.vocabulary, b.word)
        symbol = np.where(known, at + 2, UNKNOWN)
        # a word stays if a window could hold it: alone, or with a neighbour as in some window
        tied = np.zeros(len(symbol), bool)
        if len(symbol) > 1:
            tied[1:] = known[1:] & known[:-1] & (b.doc[1:] == b.doc[:-1])
            near = np.flatnonzero(tied)
            tied[near] = among(self.w.pairs, (symbol[near - 1] << 32) | symbol[near])[0]
        stay = np.flatnonzero(self.w.single[symbol] | tied | np.append(tied[1:], False))
        # runs of tied words follow each other; a separator stands in front of each run
        lead = ~tied[stay]
        place = np.arange(len(stay)) + np.cumsum(lead)
        text = np.full(len(stay) + lead.sum(), UNKNOWN, np.int64)
        text[place] = symbol[stay]
        info = np.full((4, len(text)), -1, np.int64)
        offset = b.first[b.doc[stay]]
        info[:, place] = self.docs + b.doc[stay], stay - b.at[b.doc[stay]], b.start[stay] - offset, b.end[stay] - offset
        self.parts.append((text, info))
        self.size += len(text)
        self.docs += b.n
        return b.count

    def hits(self) -> list[tuple[bytes, list[str]]]:
        """For each document the hit words, as int32 triples (word, first byte, end), and the items found."""
        out: list[tuple[bytes, list[str]]] = [(b"", [])] * self.docs
        text, info = np.concatenate([p[0] for p in self.parts]), np.concatenate([p[1] for p in self.parts], 1)
        if not len(text) or not len(self.w.length):
            return out
        index = FMIndex(text)
        low, high = index.search(self.w.patterns, self.w.length)
        n = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(n)), n)
        rows = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        at = index.locate(rows)
        cover = np.zeros(len(text) + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + self.w.length[which], -1)
        hit = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
        doc = info[0, hit]
        triples = info[1:, hit].T.astype(np.int32)
        found = np.unique(np.stack((info[0, at], which), 1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
        begin = np.searchsorted(doc, np.arange(self.docs + 1))
        first = np.searchsorted(found[:, 0], np.arange(self.docs + 1))
        for d in np.unique(doc):
            names = {i for k in found[first[d] : first[d + 1], 1] for i in self.w.items[self.w.at[k] : self.w.at[k + 1]]}
            out[d] = triples[begin[d] : begin[d + 1]].tobytes(), sorted(names)
        return out


def _pass(part):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = part.value
        shard, waiting, counts = Shard(w), [], []

        def flush() -> Iterator[pa.RecordBatch]:
            found, at = shard.hits(), 0
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            for batch in waiting:
                own = found[at : at + batch.num_rows]
                hits, items = [o[0] for o in own], [o[1] for o in own]
                old, had = batch.column(3).to_pylist(), batch.column(4).to_pylist()
                for k in range(len(own)):
                    if old[k]:
                        both = np.concatenate([np.frombuffer(x, np.int32).reshape(-1, 3) for x in (old[k], hits[k])])
                        hits[k] = np.unique(both, axis=0).tobytes()
                        items[k] = sorted({*had[k], *items[k]})
                cols = [batch.column(0), batch.column(1), pa.array(n[at : at + batch.num_rows]), pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string())), batch.column(5)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "text", "n_words", "hits", "items", "carried"])
                at += batch.num_rows

        for batch in batches:
            if not batch.num_rows:
                continue
            docs = vec.texts(batch.column(1))
            for i, j in vec.blocks(docs):
                counts.append(shard.add(docs[i:j]))
                waiting.append(batch.slice(i, j - i))
                if shard.size >= SHARD_SYMBOLS or sum(b.num_rows for b in waiting) >= 4096:
                    yield from flush()
                    shard, waiting, counts = Shard(w), [], []
        if waiting:
            yield from flush()

    return run


def find_passages(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Hit words of each document: those inside an occurrence of a window of the benchmark (item_id, text).

    Words are runs of digits, a-z after lower-casing A-Z, and non-ASCII characters. A window is WINDOW words in a row
    of an item, or all of a shorter item. Documents stay in their partitions: each worker indexes a shard of them, the
    words that can take part in a window, and searches it. The benchmark is taken in parts of PASS_BYTES, a pass over
    the documents for each, so what is broadcast is bounded. Returns ``doc_id, text, n_words, hits, items, carried``: hits
    are int32 triples (word, first byte, end byte) in order, items the sorted ids as strings, and carried holds the
    columns named in ``carry``.

    Null and empty texts have no words; null or wordless items have no window; equal items are each named. Without a
    benchmark nothing is hit. Repeated rows are each marked; other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), "text").where("id is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-total // PASS_BYTES))
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"), F.lit(None).cast("binary").alias("hits"), F.lit(None).cast("array<string>").alias("items"), F.struct(id_col, *carry).alias("carried"))
    schema = out.schema
    for k in range(passes):
        own = items.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == k).toPandas()
        part = windows(own["id"].tolist(), [t.encode() for t in own["text"]])
        out = out.transform(arrow, _pass(spark.sparkContext.broadcast(part)), schema)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, *, least_items: int = 2, **names) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of each document, by ``find_passages``.

    Null texts have no words; very long ones are searched whole, as a shard of their own. Overlapping windows count each
    word once, items of the same text count each by its id, and repeated rows are each returned. An empty benchmark hits
    nothing; other columns are ignored.
    """
    found = find_passages(docs, benchmark, **names)
    n = F.size("items").cast("long")
    return found.select(
        "doc_id", "n_words", (F.octet_length("hits") / 12).cast("long").alias("n_hit"), n.alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n >= least_items).alias("contaminated"),
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, hits = vec.texts(batch.column(1)), batch.column(2).to_pylist()
        out = []
        for d, h in zip(docs, hits, strict=True):
            if h:
                words, first, end = np.frombuffer(h, np.int32).reshape(-1, 3).T
                lead = np.flatnonzero(np.append(True, np.diff(words) != 1))
                stop = np.append(lead[1:], len(words)) - 1
                at, kept = 0, []
                for a, z in zip(first[lead], end[stop], strict=True):
                    kept.append(d[at:a])
                    at = z
                d = b"".join([*kept, d[at:]])
            out.append(d.decode())
        text = pa.array([None if keep is None else o for o, keep in zip(out, batch.column(1).to_pylist(), strict=True)], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), text, *batch.columns[3:]], ["doc_id", "text", "n_items", "carried"])


def without_passages(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """``doc_id, text, n_items, carried``: texts without their runs of hit words, from the first's start to the last's end.

    Null texts stay null; repeated rows are each returned.
    """
    found = find_passages(docs, benchmark, **names).select("doc_id", "text", "hits", F.size("items").alias("n_items"), "carried")
    return found.transform(arrow, _cut, found.drop("hits").schema)
