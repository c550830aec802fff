"""SentencePiece encoding and decoding: best-scoring pieces, giant documents by a max-plus scan over chunks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.llm import vec
from lathework.llm.runtime import arrow, prepare, stage_table

#: A public vocabulary; any other model file of the same format may be given.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of one chunk: a longer text is scanned chunk by chunk.
CHUNK = 1 << 16
#: Bytes of text that a worker encodes at once, of a word that is searched together with others, and words of one search.
BLOCK_BYTES, SHORT_WORD, TOGETHER = 2 << 20, 48, 1 << 14
#: Bits of the table that finds a piece by its hash.
TABLE_BITS = 20
NONE = -1e30
#: Where a word begins behind another character, and how many characters behind the reach of a piece it is looked for.
WORD_BEGIN, WORDS_AHEAD = re.compile("[^▁](?=▁)"), 1 << 10
#: Fixed values of the format: the sign of a blank, kinds of pieces, and how much an unknown character lies under the least score.
BLANK, NORMAL, UNKNOWN, CONTROL, USER, BYTE, PENALTY = "▁", 1, 2, 3, 4, 6, 10.0


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Numbers and contents of a protocol-buffer message's fields."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            n = number() if tag & 7 == 2 else 4 if tag & 7 == 5 else 8
            yield tag >> 3, data[at : at + n]
            at += n


class Vocabulary:
    """Pieces with their scores. Texts are bytes in which a blank stands for its sign."""

    def __init__(self, model: bytes):
        self.piece: dict[str, tuple[int, float]] = {}
        self.bytes: dict[int, int] = {}
        self.plain: list[bytes] = []
        for number, data in _fields(model):
            if number != 1:
                continue
            own = dict(_fields(data))
            text, kind, k = own.get(1, b"").decode(), own.get(3, NORMAL), len(self.plain)
            score = float(np.frombuffer(own[2], "<f4")[0]) if 2 in own else 0.0
            if kind in (NORMAL, USER):
                self.piece[text] = k, score
                self.plain.append(text.replace(BLANK, " ").encode())
            elif kind == BYTE:
                self.bytes[int(text[3:-1], 16)] = k
                self.plain.append(bytes([int(text[3:-1], 16)]))
            else:
                self.plain.append(b"")
        self.longest = max(map(len, self.piece), default=1)
        self.unknown = min((s for _, s in self.piece.values()), default=0.0) - PENALTY
        if len(self.bytes) < 256:
            raise ValueError("the model has no byte pieces")
        # a word ends before a blank that follows another character, and at a line feed, if no piece reaches across
        self.apart = not any(re.search(f"[^{BLANK}]{BLANK}", p) or "\n" in p[1:] or "\n" in p[:-1] for p in self.piece)
        self._index()

    def _index(self) -> None:
        """Tables from the hash of a piece's bytes, last byte first, to its place, id and score."""
        plain = [p.replace(BLANK, " ").encode() for p in self.piece]
        self.widest = max(map(len, plain), default=1)
        self.power = np.array([pow(vec.BASE_A, k, 1 << 64) for k in range(self.widest)], np.uint64)
        self.key = np.zeros(len(plain) + 1, np.uint64)
        for i, p in enumerate(plain):
            own = np.frombuffer(p, np.uint8)[::-1].astype(np.uint64) + np.uint64(1)
            self.key[i] = (own * self.power[: len(p)]).sum(dtype=np.uint64)
        self.id = np.array([k for k, _ in self.piece.values()] + [-1], np.int32)
        self.score = np.array([x for _, x in self.piece.values()] + [NONE])
        self.first = np.full(1 << TABLE_BITS, len(plain), np.int32)
        self.second: dict[int, list[int]] = {}
        self.crowded = np.zeros(1 << TABLE_BITS, bool)
        for i, at in enumerate(self._place(self.key[:-1]).tolist()):
            if self.first[at] == len(plain):
                self.first[at] = i
            else:
                self.crowded[at] = True
                self.second.setdefault(at, []).append(i)
        self.of_byte = np.array([self.bytes[k] for k in range(256)], np.int32)

    @staticmethod
    def _place(h: np.ndarray) -> np.ndarray:
        return (h * vec.MIX_1 >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Place of the piece with each hash; the last place, without id, for none."""
        at = self._place(h)
        got = self.first[at]
        out = np.where(self.key[got] == h, got, len(self.key) - 1)
        for i in np.flatnonzero(self.crowded[at] & (self.key[got] != h)):
            for k in self.second[int(at[i])]:
                if self.key[k] == h[i]:
                    out[i] = k
        return out

    def _together(self, text: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many short words, one after another, and their number for each word. ``text`` has a row for each byte
        position and a column for each word, longest words first."""
        width, m = text.shape
        lead = (text & 0xC0) != 0x80
        score = np.full((width + 1, m), NONE)
        score[0] = 0.0
        back, step = np.zeros((width + 1, m), np.int32), np.ones((width + 1, m), np.int8)
        begin = np.zeros(m, np.int64)
        for end in range(1, width + 1):
            n = int(np.searchsorted(-size, -end, "right"))
            if not n:
                break
            begin = np.where(lead[end - 1, :n], end - 1, begin[:n])
            whole = (size[:n] == end) | (lead[end, :n] if end < width else True)
            best, own, far = np.full(n, NONE), self.of_byte[text[end - 1, :n]], np.ones(n, np.int8)
            single = np.zeros(n, bool)
            h = np.zeros(n, np.uint64)
            for back_by in range(1, min(end, self.widest) + 1):
                h = h + (text[end - back_by, :n].astype(np.uint64) + np.uint64(1)) * self.power[back_by - 1]
                got = self._find(h)
                ok = np.flatnonzero((self.id[got] >= 0) & whole)
                if not len(ok):
                    continue
                single[ok] |= begin[ok] == end - back_by
                total = score[end - back_by, ok] + self.score[got[ok]]
                good = (total >= best[ok]) & (score[end - back_by, ok] > NONE)
                ok, total = ok[good], total[good]
                best[ok], own[ok], far[ok] = total, self.id[got[ok]], back_by
            odd = np.flatnonzero(whole & ~single)
            total = score[begin[odd], odd] + self.unknown
            odd, total = odd[total > best[odd]], total[total > best[odd]]
            best[odd], own[odd], far[odd] = total, self.of_byte[text[end - 1, odd]], 1
            score[end, :n], back[end, :n], step[end, :n] = np.where(whole, best, NONE), own, far
        at, count = size.copy(), np.zeros(m, np.int64)
        found = np.zeros((m, width), np.int32)
        while len(go := np.flatnonzero(at > 0)):
            found[go, count[go]] = back[at[go], go]
            at[go] -= step[at[go], go]
            count[go] += 1
        lo = np.concatenate(([0], np.cumsum(count)))
        return found[np.repeat(np.arange(m), count), np.repeat(lo[:-1] + count - 1, count) - np.arange(lo[-1])], count

    def encode(self, docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in a row, and where each text's begin. Each distinct word is searched once."""
        buf = np.frombuffer(b"".join(b" " + d.replace(BLANK.encode(), b" ") for d in docs if d), np.uint8)
        size = np.array([len(d) - 2 * d.count(BLANK.encode()) + 1 if d else 0 for d in docs], np.int64)
        at = np.concatenate(([0], np.cumsum(size)))
        if not len(buf):
            return np.zeros(0, np.int32), np.zeros(len(docs) + 1, np.int64)
        cut = np.zeros(len(buf), bool)
        if self.apart:
            blank, line = buf == 32, buf == 10
            cut[1:] = blank[1:] & ~blank[:-1] | line[1:] | line[:-1]
        cut[at[:-1][size > 0]] = True
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(buf))
        _, one, which = np.unique(vec.spans(vec.prefix(buf), first, last), return_index=True, return_inverse=True)
        word, length = first[one], (last - first)[one]
        order = np.argsort(-length, kind="stable")
        ids, count = [], np.zeros(len(one), np.int64)
        long = int(np.searchsorted(-length[order], -SHORT_WORD))
        for k in order[:long].tolist():
            text = bytes(buf[word[k] : word[k] + length[k]]).decode().replace(" ", BLANK)
            ids.append(np.frombuffer(self.best(text, 0, len(text)), "<i4"))
            count[k] = len(ids[-1])
        for i in range(long, len(order), TOGETHER):
            own = order[i : i + TOGETHER]
            width = int(length[own[0]])
            text = buf[np.minimum(word[own] + np.arange(width)[:, None], len(buf) - 1)]
            found, n = self._together(text, length[own])
            ids.append(found)
            count[own] = n
        lo = np.zeros(len(one), np.int64)
        lo[order] = np.concatenate(([0], np.cumsum(count[order])[:-1]))
        flat = np.concatenate(ids)
        n = count[which]
        to = np.concatenate(([0], np.cumsum(n)))
        out = flat[np.repeat(lo[which] - to[:-1], n) + np.arange(to[-1])]
        return out, np.append(to, to[-1])[np.searchsorted(first, at)]

    def links(self, text: str, start: int, most: int) -> Iterator[tuple[int, int | None, float]]:
        """End, id and score of the pieces at ``start``; an unknown character has no id."""
        single = False
        for end in range(start + 1, min(start + self.longest, most) + 1):
            if hit := self.piece.get(text[start:end]):
                single |= end == start + 1
                yield end, *hit
        if not single and start < most:
            yield start + 1, None, self.unknown

    def best(self, text: str, first: int, last: int) -> bytes:
        """Ids of the best-scoring pieces of text[first:last]; of equal ones those whose last piece is longest."""
        score, back = [NONE] * (last + 1), [(0, None)] * (last + 1)
        score[first] = 0.0
        for start in range(first, last):
            own = score[start]
            if own <= NONE:
                continue
            for end, k, s in self.links(text, start, last):
                if own + s > score[end]:
                    score[end], back[end] = own + s, (start, k)
        out: list[int] = []
        while last > first:
            start, k = back[last]
            out += [k] if k is not None else [self.bytes[b] for b in reversed(text[start:last].encode())]
            last = start
        return np.array(out[::-1], "<i4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        """Text of the ids, with the blank that encoding puts in front."""
        return b"".join(map(self.plain.__getitem__, np.frombuffer(ids, "<i4").tolist()))

    def core(self, text: str, size: int) -> tuple[int, int] | None:
        """Two places in the chunk text[:size] that every path passes, as no piece reaches across: the begins of the
        first word behind all that may reach in, and of the last word. None if there are no such two."""
        if not self.apart:
            return None
        begins = [m.start() + 1 for m in WORD_BEGIN.finditer(text, self.longest - 2, min(self.longest + WORDS_AHEAD, size + 1))]
        first = next((p for p in begins if p >= self.longest - 1), None)
        if first is None:
            return None
        last = next((q for q in range(size, first, -1) if q < len(text) and text[q] == BLANK and text[q - 1] != BLANK), None)
        return (first, last) if last is not None else None

    def paths(self, text: str, size: int) -> np.ndarray:
        """Best scores from each of the first characters (rows) to ``size`` and each of the characters after it."""
        n = self.longest
        score = np.full((size + n, n), NONE)
        score[np.arange(min(n, len(text) + 1)), np.arange(min(n, len(text) + 1))] = 0.0
        for start in range(size):
            for end, _, s in self.links(text, start, len(text)):
                np.maximum(score[end], score[start] + s, out=score[end])
        out = score[size : size + n].T.copy()
        out[out < NONE / 2] = NONE
        return out

    def transfer(self, text: str, size: int) -> np.ndarray:
        """Best scores through a chunk of ``size`` characters, by the characters that the pieces of the chunk before
        reach into it (rows) and that its own pieces reach into the next (columns), up to a constant of the chunk: what
        lies between two places that all paths pass adds the same to all.
        """
        found = self.core(text, size)
        if found is None:
            return self.paths(text, size)
        first, last = found
        out = self.paths(text[:first], first)[:, :1] + self.paths(text[last:], size - last)[:1]
        return np.maximum(out, NONE)

    def trace(self, text: str, size: int, start: int, over: int) -> bytes:
        """Ids of the best pieces of a chunk from ``start`` to ``over`` characters beyond it."""
        found = self.core(text, size)
        if found is None:
            return self.best(text, start, size + over)
        first, last = found
        middle = self.encode([text[first + 1 : last].encode()])[0].astype("<i4").tobytes()
        return self.best(text[:first], start, first) + middle + self.best(text[last:], 0, size + over - last)


@lru_cache(maxsize=1)
def vocabulary(model: bytes) -> Vocabulary:
    """The vocabulary of a model file, built once in a worker."""
    return Vocabulary(model)


def marked(text: str) -> str:
    return BLANK + text.replace(" ", BLANK)


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product: best scores through two chunks in a row."""
    return np.maximum((a[:, :, None] + b[None]).max(1), NONE)


def states(matrices: list[np.ndarray]) -> list[int]:
    """Overhang at each border of the chunks on a best path, from 0 at the begin to 0 at the end.

    The products of all chunks after each border are built once, from the end; each border's state then follows from
    the one before it, its chunk's matrix and the product behind.
    """
    behind = [matrices[-1][:, 0]]
    for m in matrices[-2::-1]:
        behind.append(np.maximum((m + behind[-1]).max(1), NONE))
    behind.reverse()
    out = [0]
    for i, m in enumerate(matrices):
        out.append(0 if i + 1 == len(matrices) else int((m[out[-1]] + behind[i + 1]).argmax()))
    return out


def _small(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model.value)
        for batch in batches:
            docs = vec.texts(batch.column(2))
            for i, j in vec.blocks(docs, BLOCK_BYTES):
                flat, at = v.encode(docs[i:j])
                ids = [flat[a:z].tobytes() for a, z in zip(at, at[1:], strict=False)]
                own = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(np.zeros(j - i, np.int32)), pa.array(ids, pa.binary())], ["doc_id", "th", "chunk", "ids"])

    return run


def _chunks(longest: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, th, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = marked(text)
                n = max(1, len(text) // chunk)
                for i in range(n):
                    end = len(text) if i + 1 == n else (i + 1) * chunk
                    part = text[i * chunk : end + longest - 1]
                    yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([th]), pa.array([i], pa.int32()), pa.array([end - i * chunk], pa.int32()), pa.array([part])], ["doc_id", "th", "chunk", "size", "part"])

    return run


def _transfers(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model.value)
        for batch in batches:
            m = [v.transfer(t, n).tobytes() for n, t in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(m, pa.binary())], ["doc_id", "th", "chunk", "m"])

    return run


def _borders(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def close() -> pa.RecordBatch:
            s = states([np.frombuffer(m).reshape(longest, longest) for m in held])
            n = len(held)
            return pa.RecordBatch.from_arrays([pa.array([now[0]] * n, pa.int64()), pa.array([now[1]] * n), pa.array(range(n), pa.int32()), pa.array(s[:-1], pa.int32()), pa.array(s[1:], pa.int32())], ["doc_id", "th", "chunk", "a", "z"])

        for batch in batches:
            for doc, th, _, m in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (doc, th) != now:
                    if held:
                        yield close()
                    now, held = (doc, th), []
                held.append(m)
        if held:
            yield close()

    return run


def _backtrace(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model.value)
        for batch in batches:
            ids = [v.trace(part, size, a, z) for size, part, a, z in zip(*(c.to_pylist() for c in batch.columns[3:]), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ids, pa.binary())], ["doc_id", "th", "chunk", "ids"])

    return run


class Source:
    """The documents of a call, its model on the workers, and the two ways of encoding."""

    schema = "doc_id long, th long, chunk int, ids binary"

    def __init__(self, docs: DataFrame, model_file: str, id_col: str, text_col: str, chunk: int):
        spark = docs.sparkSession
        prepare(spark)
        with open(model_file, "rb") as f:
            data = f.read()
        self.longest = vocabulary(data).longest
        self.model = spark.sparkContext.broadcast(data)
        plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
        self.chunk = chunk
        giant = F.coalesce(F.char_length("text") > chunk, F.lit(False))
        self.small, self.giant = plain.where(~giant), plain.where(giant)

    def in_chunks(self) -> DataFrame:
        parts = self.giant.dropDuplicates(["doc_id", "th"]).transform(arrow, _chunks(self.longest, self.chunk), "doc_id long, th long, chunk int, size int, part string")
        parts = stage_table(parts.repartition("doc_id", "chunk"), "chunks")
        moved = parts.transform(arrow, _transfers(self.model), "doc_id long, th long, chunk int, m binary")
        ordered = moved.repartition("doc_id", "th").sortWithinPartitions("doc_id", "th", "chunk")
        border = ordered.transform(arrow, _borders(self.longest), "d long, t long, c int, a int, z int")
        same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")) & (F.col("chunk") == F.col("c"))
        both = parts.join(border, same).select("doc_id", "th", "chunk", "size", "part", "a", "z")
        return both.transform(arrow, _backtrace(self.model), self.schema)


def encode(docs: DataFrame, *, model_file: str = MODEL, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Ids of the best-scoring pieces of whole texts: ``doc_id, th, chunk, ids``, ids as little-endian int32.

    A piece counts by its score in the model file, whose bytes go to the workers; a blank stands in front, and what
    no piece covers becomes byte pieces. A text of up to ``chunk`` characters is one; the chunks of a longer one give
    transfer matrices, those tell what overhangs each border, and each chunk is traced back on its own, a row for each.

    Null and empty texts have no ids. Equal rows give equal rows, of texts in chunks once; ``th`` is a hash of the text.
    Of equally good cuttings the one counts whose last piece is longest, and so on to the front; of a word that lies
    across a border of chunks it may be another one.
    """
    s = Source(docs, model_file, id_col, text_col, chunk)
    return s.small.transform(arrow, _small(s.model), s.schema).unionByName(s.in_chunks())


def decode(encoded: DataFrame, *, model_file: str = MODEL) -> DataFrame:
    """Texts of rows of ``encode``: ``doc_id, th, text``, the chunks of a giant text joined; bytes that are no UTF-8 are replaced."""
    spark = encoded.sparkSession
    prepare(spark)
    with open(model_file, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model.value)
        for batch in batches:
            plain = [v.decode(x) for x in batch.column(3).to_pylist()]
            plain = [p[1:] if c == 0 else p for p, c in zip(plain, batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(plain, pa.binary())], ["doc_id", "th", "chunk", "plain"])

    rows = encoded.transform(arrow, run, "doc_id long, th long, chunk int, plain binary")
    joined = rows.groupBy("doc_id", "th", (F.col("chunk") >= 0).alias("_")).agg(F.array_sort(F.collect_set(F.struct("chunk", "plain"))).alias("p"))
    return joined.select("doc_id", "th", F.try_validate_utf8(F.aggregate("p", F.lit("").cast("binary"), lambda a, x: F.concat(a, x["plain"])).cast("string")).alias("text"))


def _digests(model):
    """Digest of each row, or of the rows of a giant text as one; chunks of a text follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model.value)
        out: list[tuple] = []
        now = None

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], ["doc_id", "th", "n_tokens", "ids_sha256", "n_bytes", "decoded_sha256", "ids"])

        for batch in batches:
            for doc, th, chunk, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                plain = v.decode(ids)
                if chunk == 0:
                    if now:
                        out.append((*now[:3], now[3].hexdigest(), now[4], now[5].hexdigest(), b"".join(now[6])))
                    now, plain = [doc, th, 0, hashlib.sha256(), 0, hashlib.sha256(), []], plain[1:]
                now[2] += len(ids) // 4
                now[3].update(ids)
                now[4] += len(plain)
                now[5].update(plain)
                now[6].append(ids)
            if out:
                yield batch_of()
                out = []
        if now:
            out = [(*now[:3], now[3].hexdigest(), now[4], now[5].hexdigest(), b"".join(now[6]))]
            yield batch_of()

    return run


def _digest_small(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model.value)
        for batch in batches:
            docs = vec.texts(batch.column(2))
            n, sha, size, same, found = [], [], [], [], []
            for i, j in vec.blocks(docs, BLOCK_BYTES):
                flat, at = v.encode(docs[i:j])
                for text, a, z in zip(docs[i:j], at, at[1:], strict=False):
                    ids = flat[a:z].tobytes()
                    plain = v.decode(ids)[1:]
                    n.append(len(ids) // 4)
                    sha.append(hashlib.sha256(ids).hexdigest())
                    size.append(len(plain))
                    same.append(plain == text)
                    found.append(ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(size, pa.int64()), pa.array(same, pa.bool_()), pa.array(found, pa.binary())], ["doc_id", "n_tokens", "ids_sha256", "n_bytes", "round_trip", "ids"])

    return run


def piece_digests(docs: DataFrame, *, model_file: str = MODEL, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Encode whole texts, decode the ids again, and compare: ``doc_id, n_tokens, ids_sha256, n_bytes, round_trip, ids``.

    The ids are little-endian int32. ``round_trip`` says whether the decoded text is the input; it is not where a text holds the blank's own sign. Null
    texts count as empty, very long ones are scanned in chunks. Repeated rows are each returned; other columns are ignored.
    """
    s = Source(docs, model_file, id_col, text_col, chunk)
    small = s.small.transform(arrow, _digest_small(s.model), "doc_id long, n_tokens long, ids_sha256 string, n_bytes long, round_trip boolean, ids binary")
    ordered = s.in_chunks().repartition("doc_id", "th").sortWithinPartitions("doc_id", "th", "chunk")
    found = ordered.transform(arrow, _digests(s.model), "d long, t long, n_tokens long, ids_sha256 string, n_bytes long, decoded string, ids binary")
    rows = s.giant.select("doc_id", "th", F.sha2("text", 256).alias("own"))
    giant = rows.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")))
    return small.unionByName(giant.select("doc_id", "n_tokens", "ids_sha256", "n_bytes", (F.col("own") == F.col("decoded")).alias("round_trip"), "ids"))
