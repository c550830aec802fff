"""LM scoring: interpolated modified Kneser-Ney trigrams, counted in Spark, kept as sorted hash arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.llm import vec
from lathework.llm.runtime import arrow, map_file, new_path, prepare, put_file

U64, U32 = np.uint64, np.uint32
#: Stand for the begin and the end of a text; no word's hash is as small but by a chance of 2**-63.
BEGIN, END = U64(1), U64(2)
#: Tokens that a task counts at once; bytes of text behind one bucket of the model, and the least number of buckets.
CHUNK_TOKENS, BUCKET_BYTES, LEAST_BUCKETS = 1 << 20, 8 << 20, 16
#: Bytes of text that a task scores at once.
SCORE_BYTES = 4 << 20


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((vec.mix(h) >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def pair(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Hash of two words' numbers; of a pair's hash and a number, that of the trigram."""
    return vec.mix(h * U64(vec.BASE_A) + w)


def tokens(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the documents in a row, and where each document's begin."""
    b = vec.Block(docs)
    b.words(vec.NOT_SPACE)
    at = np.concatenate(([0], np.cumsum(b.count + 1)))
    w = np.full(at[-1], END)
    w[np.arange(len(b.word)) + b.doc] = b.word
    return w, at


def before(x: np.ndarray, first: np.ndarray, begin) -> np.ndarray:
    """For each token what stands before it, ``begin`` at the first ones of documents."""
    out = np.concatenate((x[:1], x[:-1]))
    out[first] = begin
    return out


def order_of(key: np.ndarray, spread: bool = False) -> np.ndarray:
    """Order of the keys. Values sort faster than places, so a key with its place behind it is sorted as one number.

    Where that takes more than 64 bits, the upper bits of keys that are ``spread`` (hashes) nearly always tell them apart.
    """
    bits = max(len(key) - 1, 1).bit_length()
    over = max(int(key.max()).bit_length() + bits - 64, 0) if len(key) else 0
    if over and not spread:
        return np.argsort(key)
    both = (key >> U64(over) << U64(bits)) | np.arange(len(key), dtype=U64)
    both.sort()
    order = (both & U64((1 << bits) - 1)).astype(np.int64)
    if over and ((now := key[order])[1:] < now[:-1]).any():
        return np.argsort(key)
    return order


def runs(key: np.ndarray, spread: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and where in it each distinct one begins."""
    order = order_of(key, spread)
    key = key[order]
    return order, np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])


def distinct(h: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of each thing by the order of hashes, and for each row the place of its thing among them.

    ``own`` tells things apart whose hashes are equal; these may then come more than once.
    """
    order = order_of(h, spread=True)
    own = own[order]
    at = np.flatnonzero(np.append(True, own[1:] != own[:-1])[: len(own)])
    place = np.empty(len(h), np.int64)
    place[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(h))))
    return order[at], place


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket and its rows, in order."""
    order, n = order_of(bucket.astype(U64)), np.bincount(bucket)
    end = np.cumsum(n)
    for b in np.flatnonzero(n).tolist():
        yield b, order[end[b] - n[b] : end[b]]


@dataclass
class Grams:
    """Distinct n-grams by their words' numbers, in order, with columns of counts."""

    places: list[np.ndarray]
    counts: list[np.ndarray]

    @staticmethod
    def of(places: list[np.ndarray], counts: list[np.ndarray]) -> Grams:
        """Equal n-grams as one, their counts added."""
        size = max((int(p.max()) for p in places if len(p)), default=0) + 1
        key, limit = places[0], size
        for place in places[1:]:
            if limit * size >= 1 << 63:  # the words so far by their rank, so that one more fits behind it
                order, at = runs(key)
                rank = np.empty(len(key), U64)
                rank[order] = np.repeat(np.arange(len(at), dtype=U64), np.diff(np.append(at, len(key))))
                key, limit = rank, len(at)
            key, limit = key * U64(size) + place, limit * size
        order, at = runs(key)
        first = order[at]
        return Grams([p[first] for p in places], [np.add.reduceat(c[order], at, dtype=U64 if c.dtype == U64 else U32) if len(at) else c for c in counts])

    @staticmethod
    def merged(parts: list[Grams]) -> Grams:
        """All parts as one; the parts are given back."""
        every = [[np.concatenate(x) for x in zip(*part, strict=True)] for part in ([g.places for g in parts], [g.counts for g in parts])]
        parts.clear()
        return Grams.of(*every)

    def hashes(self) -> list[np.ndarray]:
        """The n-grams' first words, and hashes of the first two words, and so on."""
        out = [self.places[0]]
        for p in self.places[1:]:
            out.append(pair(out[-1], p))
        return out

    def part(self, rows: np.ndarray) -> Grams:
        return Grams([p[rows] for p in self.places], [c[rows] for c in self.counts])

    def pack(self) -> bytes:
        """Numbers by planes of their bytes, up to a column's highest that isn't zero, compressed: frequent words have small numbers."""
        columns = [np.ascontiguousarray(x) for x in (np.diff(self.places[0], prepend=U64(0)), *self.places[1:], *self.counts)]
        planes = [-(-int(x.max()).bit_length() // 8) if len(x) else 0 for x in columns]
        data = b"".join(x.view(np.uint8)[k :: x.itemsize].tobytes() for x, n in zip(columns, planes, strict=True) for k in range(n))
        return np.array([len(self.places[0]), len(self.places), len(columns), *planes], np.int64).tobytes() + pa.Codec("zstd", 1).compress(data, asbytes=True)

    @staticmethod
    def unpack(data: bytes) -> Grams:
        rows, k, n = np.frombuffer(data, np.int64, 3).tolist()
        planes = np.frombuffer(data, np.int64, n, 24).tolist()
        plain = iter(np.frombuffer(pa.Codec("zstd").decompress(data[24 + 8 * n :], rows * sum(planes), asbytes=True), np.uint8).reshape(-1, max(rows, 1)))
        columns = []
        for used in planes:
            x = np.zeros((rows, 8), np.uint8)
            for place in range(used):
                x[:, place] = next(plain)
            columns.append(x.view(U64).ravel())
        return Grams([np.cumsum(columns[0], dtype=U64), *columns[1:k]], columns[k:])


def blob(arrays: list[np.ndarray], types: list) -> bytes:
    return b"".join(a.astype(t).tobytes() for a, t in zip(arrays, types, strict=True))


def unblob(data, types: list) -> list[np.ndarray]:
    n = len(data) // sum(np.dtype(t).itemsize for t in types)
    out, at = [], 0
    for t in types:
        out.append(np.frombuffer(data, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


#: Counts from this on are kept in full in a second file.
MANY = 255
#: What files hold of trigrams: the first 40 bits of the hash, in two columns, the second with the count behind it; in
#: full, hash and count. A hash of another trigram is taken for it by a chance of 2**-40 times a bucket's rows.
TRIGRAM, TRIGRAM_MORE = [U32, np.uint16], [U64] * 2
#: Of pairs: as above with the number of words that come before the pair, its count as a history, and the words that
#: follow it once, twice and more often; in full, hash and the five numbers.
PAIR, PAIR_MORE = [U32, np.uint16, *[np.uint8] * 4], [U64] * 6
#: Of words: hash and place by frequency among the bucket's words; by that place how often the word stands, and its sum
#: over pairs as a history, distinct predecessors, and words that follow in pairs of one predecessor, two, more.
WORD, TIMES, FOLLOW = [U64, U32], [np.uint8], [np.uint8] * 5
TIMES_MORE, FOLLOW_MORE = [U32, U64], [U32, *[U64] * 5]
#: The number of words that are not met.
UNMET = U64(1 << 62)
SCHEMA = "bucket int, data binary"
#: Whether shuffle files are removed when their query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
COUNTS, STATS = ["vocabulary", "tokens"], ["n1", "n2", "n3", "n4", "m1", "m2", "m3", "m4", "kinds", "k1", "k2", "k3", "k4"]


def few(n: np.ndarray) -> list[int]:
    """How many of the counts are 1, 2, 3 and 4."""
    return [int((n == k).sum()) for k in (1, 2, 3, 4)]


def split_up(n: np.ndarray) -> list[np.ndarray]:
    """Whether a count is 1, 2, more."""
    return [(n == 1).view(np.uint8), (n == 2).view(np.uint8), (n > 2).view(np.uint8)]


def narrow(key: np.ndarray, count: np.ndarray, *others: np.ndarray) -> list[np.ndarray]:
    """Columns of ``TRIGRAM`` or ``PAIR``, in order."""
    high, low = (key >> U64(32)).astype(U32), (key >> U64(16) & U64(0xFF00)).astype(np.uint16)
    order = order_of(key, spread=True)
    return [x[order] for x in (high, low | np.minimum(count, MANY).astype(np.uint16), *(np.minimum(o, MANY).astype(np.uint8) for o in others))]


def put_dense(folder: str, name: str, bucket: int, columns: list[np.ndarray]) -> None:
    """Columns by place, up to MANY; rows with more again in full, with their place."""
    put_file(folder, f"{name}-{bucket}", blob([np.minimum(c, MANY) for c in columns], [np.uint8] * len(columns)))
    many = np.flatnonzero(np.maximum.reduce(columns) >= MANY)
    put_file(folder, f"{name}-more-{bucket}", blob([many, *(c[many] for c in columns)], [U32, *[U64] * len(columns)]))


def _batch(bucket: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([data], pa.binary())], ["bucket", "data"])


def _row(values: list[int], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in values], names)


def _dealt(grams: Grams, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each bucket. Buckets go by the whole n-gram, so of a frequent one each task has one entry."""
    for b, rows in by_bucket(bucket):
        yield _batch(b, grams.part(rows).pack())


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Tokens of whole documents, CHUNK_TOKENS and more at once."""
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        docs = vec.texts(batch.column(0))
        for i, j in vec.blocks(docs):
            held.append(tokens(docs[i:j])[0])
            size += len(held[-1])
            if size >= CHUNK_TOKENS:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def _count_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in _chunks(batches):
            word, n = np.unique(np.append(w, BEGIN), return_counts=True)
            n = n.astype(U64) - (word == BEGIN)
            yield from _dealt(Grams([word], [n]), bucket_of(word, buckets))

    return run


def _vocabulary(folder: str):
    """Writes a bucket's words with their places by frequency; returns how many there are and how often they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = total = 0
        for bucket, parts in _groups(batches):
            g = Grams.merged([Grams.unpack(p) for p in parts])
            word, n = g.places[0], g.counts[0]
            place = np.empty(len(word), np.int64)
            place[np.lexsort((word, -n.astype(np.int64)))] = np.arange(len(word))
            put_file(folder, f"words-{bucket}", blob([word, place], WORD))
            dense = np.empty(len(n), U64)
            dense[place] = n
            put_dense(folder, "times", bucket, [dense])
            words += int((n > 0).sum())
            total += int(n.sum())
        yield _row([words, total], COUNTS)

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Rows of each bucket of a partition that is in order by bucket."""
    now, held = None, []
    for batch in batches:
        for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if bucket != now and held:
                yield now, held
                held = []
            now = bucket
            held.append(data)
    if held:
        yield now, held


def _count(words: Words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens_ in _chunks(batches):
            row, of_w = distinct(hashes := np.append(BEGIN, tokens_), hashes)
            number = words.find(hashes[row])
            # words by the rank of their numbers here, so that three fit a key; the order is that of the numbers
            order = order_of(number)
            rank = np.empty(len(order), U64)
            rank[order] = np.arange(len(order), dtype=U64)
            of_w, begin = rank[of_w[1:]], rank[of_w[0]]
            first = np.append(0, np.flatnonzero(tokens_[:-1] == END) + 1)
            of_v = before(of_w, first, begin)
            g = Grams.of([before(of_v, first, begin), of_v, of_w], [np.ones(len(of_w), np.uint8)])
            g.places = [number[order][p.astype(np.int64)] for p in g.places]
            yield from _dealt(g, bucket_of(g.hashes()[-1], words.buckets))

    return run


def _trigrams(folder: str, buckets: int, end: int):
    """Merges the trigrams of a bucket into its files; passes what they tell about pairs on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, parts in _groups(batches):
            g = Grams.merged([Grams.unpack(p) for p in parts])
            (u, v, w), (n,), key = g.places, g.counts, g.hashes()[2]
            put_file(folder, f"trigrams-{bucket}", blob(narrow(key, n), TRIGRAM))
            many = np.flatnonzero(n >= MANY)
            many = many[np.argsort(key[many])]
            put_file(folder, f"trigrams-more-{bucket}", blob([key[many], n[many]], TRIGRAM_MORE))
            nil, one = np.zeros(len(n), np.uint8), np.ones(len(n), np.uint8)
            # a pair's count is that of the trigrams which it begins; one that ends a text begins none
            last = np.where(w == U64(end), n, U64(0))
            history, event = [nil, n, *split_up(n)], [one, last, nil, nil, nil]
            both = Grams.of([np.concatenate((u, v)), np.concatenate((v, w))], [np.concatenate(x) for x in zip(history, event, strict=True)])
            yield from _dealt(both, bucket_of(both.hashes()[-1], buckets))
            yield _batch(buckets, np.array(few(n) + [0] * 9, np.int64).tobytes())

    return run


def _pairs(folder: str, buckets: int):
    """Merges the pairs of a bucket into its files; passes what they tell about words on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, parts in _groups(batches):
            if bucket == buckets:
                yield from (_batch(bucket, p) for p in parts)
                continue
            g = Grams.merged([Grams.unpack(p) for p in parts])
            (v, w), (cc, c, *f), key = g.places, g.counts, g.hashes()[1]
            put_file(folder, f"pairs-{bucket}", blob(narrow(key, cc, c, *f), PAIR))
            many = np.flatnonzero(np.maximum.reduce([cc, c, *f]) >= MANY)
            many = many[np.argsort(key[many])]
            put_file(folder, f"pairs-more-{bucket}", blob([x[many] for x in (key, cc, c, *f)], PAIR_MORE))
            met, nil = (cc > 0).view(np.uint8), np.zeros(len(cc), np.uint8)
            history, event = [cc.astype(U64), nil, *split_up(cc)], [nil, met, nil, nil, nil]
            words = Grams.of([np.concatenate((v, w))], [np.concatenate(x) for x in zip(history, event, strict=True)])
            yield from _dealt(words, (words.places[0] % U64(buckets)).astype(np.int64))
            yield _batch(buckets, np.array([0] * 4 + few(cc) + [int(met.sum())] + [0] * 4, np.int64).tobytes())

    return run


def _follow(words: Words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(STATS), np.int64)
        for bucket, parts in _groups(batches):
            if bucket == words.buckets:
                total += sum(np.frombuffer(p, np.int64) for p in parts)
                continue
            g = Grams.merged([Grams.unpack(p) for p in parts])
            size = len(unblob(map_file(words.folder, f"words-{bucket}"), WORD)[0])
            dense = [np.zeros(size, U64) for _ in FOLLOW]
            for d, c in zip(dense, g.counts, strict=True):
                d[(g.places[0] // U64(words.buckets)).astype(np.int64)] = c
            put_dense(words.folder, "follow", bucket, dense)
            total += np.array([0] * 9 + few(g.counts[1]), np.int64)
        yield _row(total.tolist(), STATS)

    return run


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Chen and Goodman's three discounts from the numbers of n-grams met 1 to 4 times; 1/2 of the count if too few."""
    n1, n2, n3, n4 = n
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(d, 0.05 * k), k) for k, d in enumerate(found, 1))


@dataclass
class Words:
    """The corpus's words. A word's number is its place in its bucket, times the buckets, and the bucket: the more
    frequent, the smaller."""

    folder: str
    buckets: int

    def files(self, name: str, types: list, bucket: np.ndarray) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """The mapped columns of each bucket, and which rows are of it."""
        for b, rows in by_bucket(bucket):
            yield rows, unblob(map_file(self.folder, f"{name}-{b}"), types)

    def find(self, word: np.ndarray) -> np.ndarray:
        """Numbers of words by their hashes."""
        bucket, number = bucket_of(word, self.buckets), np.full(len(word), UNMET)
        for own, (key, place) in self.files("words", WORD, bucket):
            if len(key):
                at = np.minimum(np.searchsorted(key, word[own]), len(key) - 1)
                same = key[at] == word[own]
                own, at = own[same], at[same]
                number[own] = place[at].astype(U64) * U64(self.buckets) + bucket[own].astype(U64)
        return number

    def counts(self, name: str, types: list, full: list, number: np.ndarray) -> list[np.ndarray]:
        """The columns of a dense file by the words' numbers; zeros if not met."""
        out = [np.zeros(len(number), np.int64) for _ in types]
        met = np.flatnonzero(number != UNMET)
        bucket, place = (number[met] % U64(self.buckets)).astype(np.int64), (number[met] // U64(self.buckets)).astype(np.int64)
        for own, table in self.files(name, types, bucket):
            if len(table[0]):
                for o, t in zip(out, table, strict=True):
                    o[met[own]] = t[place[own]]
        more = np.flatnonzero(np.maximum.reduce(out)[met] == MANY)
        for own, (key, *table) in self.files(f"{name}-more", full, bucket[more]):
            own = more[own]
            at = np.searchsorted(key, place[own])
            for o, t in zip(out, table, strict=True):
                o[met[own]] = t[at]
        return out


@dataclass
class Model:
    """Where the sorted arrays lie, and the constants of the whole corpus: discounts of trigrams, pairs and words."""

    words: Words
    vocabulary: int
    tokens: int
    kinds: int
    discounts: tuple[tuple[float, float, float], ...]
    left: float

    def _counts(self, name: str, types: list, full: list, key: np.ndarray) -> list[np.ndarray]:
        """Counts behind the hashes in the narrow files, those of MANY from the full ones; zeros if not met.

        Hashes in order are found faster, as the places looked at lie side by side.
        """
        out = [np.zeros(len(key), np.int64) for _ in types[1:]]
        high, low = (key >> U64(32)).astype(U32), (key >> U64(24) & U64(0xFF)).astype(np.uint16)
        for live, (first, second, *others) in self.words.files(name, types, bucket_of(key, self.words.buckets)):
            at = np.searchsorted(first, high[live])
            while len(live) and len(first):  # rows of the same 32 bits stand next to each other
                there = np.flatnonzero((at < len(first)) & (first.take(at, mode="clip") == high[live]))
                live, at = live[there], at[there]
                last = second[at]
                same = last >> 8 == low[live]
                found, place = live[same], at[same]
                for o, t in zip(out, (last[same] & 0xFF, *(x[place] for x in others)), strict=True):
                    o[found] = t
                live, at = live[~same], at[~same] + 1
        more = np.flatnonzero(np.maximum.reduce(out) == MANY)
        for own, (first, *columns) in self.words.files(f"{name}-more", full, bucket_of(key[more], self.words.buckets)):
            if len(first):
                own = more[own]
                at = np.minimum(np.searchsorted(first, key[own]), len(first) - 1)
                same = first[at] == key[own]
                for o, t in zip(out, columns, strict=True):
                    o[own[same]] = t[at[same]]
        return out

    def score(self, docs: list[bytes], order: int = 3) -> tuple[np.ndarray, ...]:
        """Tokens, known tokens, base score and model score of each document, all in log10."""
        three, two, one = (np.array([0, *d]) for d in self.discounts)
        parts = [tokens(docs[i:j]) for i, j in vec.blocks(docs)]
        w, at = np.concatenate([p[0] for p in parts]), np.append(0, np.cumsum(np.concatenate([np.diff(p[1]) for p in parts])))
        first = at[:-1]
        row, inverse = distinct(hashes := np.append(BEGIN, w), hashes)
        of_w, begin = inverse[1:], inverse[0]
        number = self.words.find(hashes[row])
        (cw,), (hist, cont, *s) = self.words.counts("times", TIMES, TIMES_MORE, number), self.words.counts("follow", FOLLOW, FOLLOW_MORE, number)
        base = np.log10((cw + 0.5) / (self.tokens + 0.5 * (self.vocabulary + 1)))
        p1 = (cont - one[np.minimum(cont, 3)]) / max(self.kinds, 1) + self.left / (self.vocabulary + 1)
        # the pair in front of a document, and those that end at each token
        of_v = np.append(begin, before(of_w, first, begin))
        key = pair(number[of_v], number[inverse])
        row, of_pair = distinct(key, of_v * len(number) + inverse)
        a, b, key = of_v[row], inverse[row], key[row]
        cc, c, *f = self._counts("pairs", PAIR, PAIR_MORE, key)
        left = np.where(hist > 0, sum(two[k + 1] * s[k] for k in range(3)) / np.maximum(hist, 1), 1.0)
        p2 = (cc - two[np.minimum(cc, 3)]) / np.maximum(hist, 1)[a] + left[a] * p1[b]
        if order == 3:
            front, of_pair = of_pair[0], of_pair[1:]
            h = before(of_pair, first, front)
            triple = pair(key[h], number[of_w])
            row, of_triple = distinct(triple, h * len(number) + of_w)
            h = h[row]
            (n,) = self._counts("trigrams", TRIGRAM, TRIGRAM_MORE, triple[row])
            left = np.where(c > 0, sum(three[k + 1] * f[k] for k in range(3)) / np.maximum(c, 1), 1.0)
            p3 = (n - three[np.minimum(n, 3)]) / np.maximum(c, 1)[h] + left[h] * p2[of_pair[row]]
            log = np.log10(p3)[of_triple]
        else:
            log = np.log10(p2)[of_pair[1:]] if order == 2 else np.log10(p1)[of_w]
        add = lambda x: np.add.reduceat(x, first)
        return np.diff(at), add((cw > 0).astype(np.int64)[of_w]), add(base[of_w]), add(log)


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Counts all trigrams of ``docs`` and writes the sorted arrays to the shared folder, files for each bucket.

    Words are counted and numbered first, so n-grams travel as small numbers. Rows are dealt by the whole n-gram at
    each step, so no history, word or pair is too frequent for a task: a task sends one entry of it on.
    """
    spark = docs.sparkSession
    prepare(spark)
    plain = docs.select(F.col(text_col).alias("text"))
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    words = Words(new_path(spark, "ngrams"), max(LEAST_BUCKETS, -(-size // BUCKET_BYTES)))

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartitionById(words.buckets + 1, "bucket").sortWithinPartitions("bucket")

    def total(df: DataFrame, names: list[str]):
        return df.agg(*(F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in names)).first()

    def longs(names: list[str]) -> str:
        return ", ".join(f"{s} long" for s in names)

    keep = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")  # shuffle files of the first job go before the second begins
    counted = dealt(plain.transform(arrow, _count_words(words.buckets), SCHEMA))
    known = total(counted.transform(arrow, _vocabulary(words.folder), longs(COUNTS)), COUNTS)
    end = int(words.find(np.array([END]))[0])
    counted = dealt(plain.transform(arrow, _count(words), SCHEMA)).transform(arrow, _trigrams(words.folder, words.buckets, end), SCHEMA)
    counted = dealt(counted).transform(arrow, _pairs(words.folder, words.buckets), SCHEMA)
    r = total(dealt(counted).transform(arrow, _follow(words), longs(STATS)), STATS)
    spark.conf.set(CLEANUP, keep)
    found = tuple(discounts([r[f"{x}{k}"] for k in (1, 2, 3, 4)]) for x in "nmk")
    one = found[2]
    left = (one[0] * r.k1 + one[1] * r.k2 + one[2] * (known.vocabulary - r.k1 - r.k2)) / r.kinds if r.kinds else 1.0
    return Model(words, known.vocabulary, known.tokens, r.kinds, found, left)


def score_language_model(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", order: int = 3) -> DataFrame:
    """Score whole texts by a trigram model of the documents outside the held-out fifth.

    Tokens are words between ASCII white space, A-Z lower-cased, then one end. Returns ``doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score, score, perplexity``; scores are log10 probabilities, the base that of single
    tokens. The model is interpolated modified Kneser-Ney: below the trigrams stand the numbers of words before a pair,
    below these the numbers of words before a word, and below those equal odds of the vocabulary and one unknown word,
    so the odds after any history add up to 1. A text begins after two begin signs. ``order`` 2 or 1 scores by the
    model's lower orders alone.

    Null and empty texts are an end alone; very long texts are scored whole. Without training documents all tokens are
    unknown and equally likely. Ties don't arise: counts are sums.
    Repeated rows each count and are each scored; a null id is trained on. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1, F.lit(False))
    model = train(plain.where(~held))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = vec.texts(batch.column(1))
            for i, j in vec.blocks(docs, SCORE_BYTES):
                n, known, base, own = model.score(docs[i:j], order)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n), pa.array(known), pa.array(base), pa.array(own)], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    scored = plain.transform(arrow, score, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
