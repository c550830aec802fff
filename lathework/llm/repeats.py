"""Suffix-array dedup: bytes covered by strings that start at two places or more are removed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathework.llm import vec
from lathework.llm.runtime import arrow, prepare, stage_table
from lathework.llm.suffix import common_prefixes, pack, suffix_array

#: Bytes under one suffix array, and the smallest part into which the strings of one anchor are split.
SHARD_BYTES, PART_BYTES, SOME_PARTS = 768 << 10, 128 << 10, 8
LARGE_PART = 8 << 20
#: Bytes of words: digits, letters and all of non-ASCII characters.
WORD = vec.table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)


def anchors(docs: list[bytes], width: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows that share an anchor: document, first byte, length of the run's bytes, of one unit, number
    of units, two hashes.

    The anchor of a window is the one of its grams with the smallest hash, the leftmost of several; equal windows have
    equal anchors at equal places wherever they stand, so a window can only repeat among runs of the same anchor hash.
    In text of a short period one run follows another with the same bytes; they are one row of so many units.
    """
    gram = max(1, width // 8)
    span = width - gram + 1
    b = vec.Block(docs, lower=False)
    n = len(b.buf)
    starts = n - width + 1
    if starts <= 0:
        return (np.zeros(0, np.int64),) * 5 + (np.zeros(0, np.uint64),) * 2
    run = vec.prefix(b.buf)
    _, down = vec._POWERS[vec.BASE_A].get(n + 1)
    h = vec.mix((run[gram:] - run[: n - gram + 1]) * down[: n - gram + 1] + np.uint64(gram))
    at = _smallest(h, span, starts)
    edge = np.zeros(n + 1, np.int8)  # +1 where a document's windows begin, -1 after its last
    long = np.flatnonzero(b.size >= width)
    edge[b.first[long]] += 1
    edge[b.first[long] + b.size[long] - width + 1] -= 1
    inside = np.cumsum(edge)[:starts] > 0
    change = np.append(True, (at[1:] != at[:-1]) | (inside[1:] != inside[:-1]))
    change[b.first[b.first < starts]] = True
    first = np.flatnonzero(change)
    last = np.append(first[1:], starts) - 1
    use = inside[first]
    first, last = first[use], last[use]
    doc = np.searchsorted(b.first, first, "right") - 1
    other = vec.spans(vec.prefix(b.buf, vec.BASE_B), first, last + width, vec.BASE_B)
    fp = h[at[first]]
    lead, stop = _units(doc, first, last, fp, other)
    own = doc[lead]
    return own, first[lead] - b.first[own], last[stop] - first[lead] + width, last[lead] - first[lead] + width, stop - lead + 1, fp[lead], other[lead]


def word_anchors(docs: list[bytes], words: int) -> tuple[np.ndarray, ...]:
    """As ``anchors``, but of windows of so many words, from the first one's start to the last one's end."""
    gram = max(1, words // 4)
    b = vec.Block(docs, lower=False)
    b.words(WORD)
    starts = len(b.start) - words + 1
    if starts <= 0:
        return (np.zeros(0, np.int64),) * 5 + (np.zeros(0, np.uint64),) * 2
    h = vec.spans(vec.prefix(b.buf), b.start[: len(b.start) - gram + 1], b.end[gram - 1 :])
    at = _smallest(h, words - gram + 1, starts)
    inside = b.doc[:starts] == b.doc[words - 1 :]
    first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (inside[1:] != inside[:-1]) | (b.doc[1:starts] != b.doc[: starts - 1])))
    last = np.append(first[1:], starts) - 1
    use = inside[first]
    first, last = first[use], last[use]
    doc, end = b.doc[first], b.end[last + words - 1]
    other = vec.spans(vec.prefix(b.buf, vec.BASE_B), b.start[first], end, vec.BASE_B)
    fp = h[at[first]]
    lead, stop = _units(doc, first, last, fp, other)
    own, s = doc[lead], b.start[first[lead]]
    return own, s - b.first[own], end[stop] - s, end[lead] - s, stop - lead + 1, fp[lead], other[lead]


def _smallest(h: np.ndarray, span: int, starts: int) -> np.ndarray:
    """For each window of ``span`` grams the one with the smallest hash, the leftmost of several."""
    v = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    rows = -(-len(v) // span) + 1
    grid = np.full(rows * span, np.uint64(0xFFFFFFFFFFFFFFFF))
    grid[: len(v)] = v
    grid = grid.reshape(rows, span)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return (np.minimum(behind[:starts], ahead[span - 1 : span - 1 + starts]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _units(doc: np.ndarray, first: np.ndarray, last: np.ndarray, fp: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last run of each row: neighbouring runs of the same bytes are one."""
    again = (doc[1:] == doc[:-1]) & (fp[1:] == fp[:-1]) & (other[1:] == other[:-1]) & (first[1:] == last[:-1] + 1)
    lead = np.flatnonzero(np.append(True, ~again)[: len(doc)])
    return lead, np.append(lead[1:], len(doc))[: len(lead)] - 1


def _anchor_rows(width: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = vec.texts(batch.column(2))
            for i, j in vec.blocks(docs):
                found = [anchors(docs[i:j], width)]
                if words:
                    found.append(word_anchors(docs[i:j], words))
                    for kind, x in enumerate(found):  # the last bit tells windows of bytes from windows of words
                        found[kind] = (*x[:5], x[5] & ~np.uint64(1) | np.uint64(kind), x[6])
                doc, *places, fp, rh = (np.concatenate(x) for x in zip(*found, strict=True))
                own = pa.array(doc + i)
                cols = [batch.column(0).take(own), batch.column(1).take(own), *(pa.array(p.astype(np.int32)) for p in places), pa.array(fp.view(np.int64)), pa.array(rh.view(np.int64))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "th", "s", "len", "unit", "units", "fp", "rh"])

    return run


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, wanted in zip(vec.texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            rows += [(w["fp"], w["rh"], w["c"], text[w["s"] : w["s"] + w["len"]]) for w in wanted]
        for k in range(0, max(len(rows), 1), 4096):
            part = rows[k : k + 4096]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()), pa.array([r[2] for r in part], pa.int64()), pa.array([r[3] for r in part], pa.binary())], ["fp", "rh", "c", "bytes"])


def _word_windows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = vec.texts(batch.column(3))
            for i, j in vec.blocks(strings):
                b = vec.Block(strings[i:j], lower=False)
                b.words(WORD)
                k = np.arange(max(len(b.start) - words + 1, 0))
                k = k[b.doc[k] == b.doc[k + words - 1]]
                own, a, z = b.doc[k], b.start[k], b.end[k + words - 1]
                h1, h2 = (vec.spans(vec.prefix(b.buf, base), a, z, base).view(np.int64) for base in (vec.BASE_A, vec.BASE_B))
                cols = [batch.column(c).take(pa.array(own + i)) for c in range(3)]
                cols += [pa.array((x - b.first[own]).astype(np.int32)) for x in (a, z)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(h1), pa.array(h2)], ["fp", "rh", "c", "a", "z", "h1", "h2"])

    return run


class Strings:
    """The suffix array of some strings, cut down to the starts of whole windows."""

    def __init__(self, strings: list[bytes], width: int):
        size = np.array([len(x) for x in strings], np.int64)
        self.first = np.cumsum(size + 1) - size - 1
        self.text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
        self.width = width
        valid = np.zeros(len(self.text) + 1, np.int64)
        np.add.at(valid, self.first, 1)
        np.add.at(valid, self.first + np.maximum(size - width + 1, 0), -1)
        self.valid = np.cumsum(valid)[:-1] > 0
        self.order = suffix_array(*pack(self.text))

    def repeated(self) -> np.ndarray:
        """Starts whose window stands at another start of a window too."""
        group = np.cumsum(common_prefixes(self.text, self.order) < self.width)
        own = self.valid[self.order]
        return self.order[own & (np.bincount(group, own)[group] >= 2)]

    def found_in(self, other: Strings) -> np.ndarray:
        """Starts whose window is one of ``other``'s: each is searched by halving in the other's order."""
        mine = np.flatnonzero(self.valid)
        into = other.order[other.valid[other.order]]
        low, high = np.zeros(len(mine), np.int64), np.full(len(mine), len(into), np.int64)
        key, step = pack(self.text)
        theirs, _ = pack(other.text)
        same = np.zeros(len(mine), bool)
        while (go := np.flatnonzero((low < high) & ~same)).size:
            mid = (low[go] + high[go]) // 2
            a, b = mine[go], into[mid]
            sign, left = np.zeros(len(go), np.int64), np.arange(len(go))
            for k in [*range(0, self.width - step + 1, step), self.width - step]:
                x, y = key[a[left] + k], theirs[b[left] + k]
                sign[left] = np.where(x < y, -1, np.where(x > y, 1, 0))
                left = left[x == y]
                if not len(left):
                    break
            same[go] = sign == 0
            high[go] = np.where(sign < 0, mid, high[go])
            low[go] = np.where(sign > 0, mid + 1, low[go])
        return mine[same]

    def runs(self, starts: np.ndarray) -> dict[int, list[int]]:
        """By string: first byte and end of what the windows at ``starts`` cover, run after run."""
        out: dict[int, list[int]] = {}
        if not len(starts):
            return out
        starts = np.sort(starts)
        lead = np.flatnonzero(np.append(True, np.diff(starts) > 1))
        stop = np.append(lead[1:], len(starts)) - 1
        which = np.searchsorted(self.first, starts, "right") - 1
        for a, z in zip(lead, stop, strict=True):
            cut = np.flatnonzero(np.diff(which[a : z + 1])) + a + 1
            for p, q in zip([a, *cut], [*cut, z + 1], strict=True):
                k = int(which[p])
                out.setdefault(k, []).extend((int(starts[p] - self.first[k]), int(starts[q - 1] - self.first[k]) + self.width))
        return out


def _search(width: int):
    """Cells (fp, i, j) in order. i = j: strings of one part, many such cells under one suffix array; else two parts."""

    def emit(rows: list[tuple], strings: Strings, starts: np.ndarray) -> pa.RecordBatch:
        found = [(rows[k], r) for k, r in strings.runs(starts).items() if rows[k][2] == 1]
        return pa.RecordBatch.from_arrays([pa.array([f[0][0] for f in found], pa.int64()), pa.array([f[0][1] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int32()))], ["fp", "rh", "runs"])

    def alone(rows: list[tuple]) -> pa.RecordBatch:
        s = Strings([r[4] for r in rows], width)
        return emit(rows, s, s.repeated())

    def across(i: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        sides = [r for r in rows if r[3] == i], [r for r in rows if r[3] != i]
        if all(sides):
            a, b = (Strings([r[4] for r in side], width) for side in sides)
            yield emit(sides[0], a, a.found_in(b))
            yield emit(sides[1], b, b.found_in(a))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, size, cell, held = [], 0, None, []
        for batch in batches:
            for fp, i, j, part, rh, c, data in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (fp, i, j) != cell:
                    if held and cell[1] == cell[2]:
                        own += held
                        size += sum(len(r[4]) for r in held)
                        if size >= SHARD_BYTES:
                            yield alone(own)
                            own, size = [], 0
                    elif held:
                        yield from across(cell[1], held)
                    cell, held = (fp, i, j), []
                held.append((fp, rh, c, part, data))
        if held and cell[1] == cell[2]:
            own += held
        elif held:
            yield from across(cell[1], held)
        if own:
            yield alone(own)

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, spans = vec.texts(batch.column(1)), batch.column(2).to_pylist()
        n_bytes, removed, n_spans, sha, kept = [], [], [], [], []
        for d, found in zip(docs, spans, strict=True):
            gone, pieces, at, k = 0, [], 0, 0
            if found:
                flat = [(s["s"], s["s"] + s["len"]) if s["runs"] is None else (s["s"] + s["runs"][i], s["s"] + s["runs"][i + 1]) for s in found for i in range(0, 2 if s["runs"] is None else len(s["runs"]), 2)]
                flat.sort()
                end = -1
                for a, z in flat:
                    if a > end:
                        k += 1
                        pieces.append(d[at:a])
                        gone += z - a
                        at = end = z
                    elif z > end:
                        gone += z - end
                        at = end = z
            rest = b"".join([*pieces, d[at:]]) if pieces else d
            n_bytes.append(len(d))
            removed.append(gone)
            n_spans.append(k)
            sha.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
        whole = [k.decode("utf-8", "ignore") for k in kept]
        cols = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha, pa.string()), pa.array(whole, pa.string()), batch.column(3)]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "carried"])


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), width: int = 400, words: int = 0, part_bytes: int = PART_BYTES) -> DataFrame:
    """Remove every byte of the texts that lies in a ``width``-byte string which starts at another place too.

    Windows are dealt to shards by their anchor, a gram that depends on the window alone. Where all strings around an
    anchor are the same, their count decides; the others, one of each kind, come under suffix arrays by shard, and an
    anchor with many kinds is spread over parts that are searched in each other by halving. Returns ``doc_id, n_bytes,
    n_removed, n_spans, kept_sha256, kept_text, carried``: the digest is that of the remaining bytes, their text leaves
    out characters that were cut in two, and ``carried`` holds the columns named in ``carry``. Strings are judged on the
    input.

    With ``words``, every byte goes as well that lies in so many words in a row, from the first one's start to the last
    one's end, which stand at another place too, however short they are. A word is a run of letters, digits and
    non-ASCII characters. Runs of such windows are dealt by anchors in the same way; where the strings around an anchor
    differ, the windows of one of each kind are counted by their hashes.

    Null texts are empty; texts shorter than ``width`` stay whole, very long ones are read whole. Of several equal
    strings none is kept, so there are no ties to settle. Repeated rows repeat each other and so lose all
    their windows. A removed string may begin or end inside a character. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    least = -(1 << 63)
    plain = docs.select(F.col(id_col).cast("long").alias("own"), F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"), F.struct(id_col, *carry).alias("carried"))
    some = plain.where(F.octet_length("text") >= (min(width, 2 * words - 1) if words else width)).select("doc_id", "th", "text")
    found = stage_table(some.transform(arrow, _anchor_rows(width, words), "doc_id long, th long, s int, len int, unit int, units int, fp long, rh long"), "anchors")
    twice = stage_table(found.groupBy("fp").agg(F.sum("units").alias("k")).where("k > 1").select("fp"), "shared")
    shared = stage_table(found.join(twice, "fp"), "shared")
    kinds = shared.groupBy("fp", "rh").agg(F.sum("units").alias("c"), F.min(F.struct("doc_id", "th", "s", F.col("unit").alias("len"))).alias("one"))
    kinds = stage_table(kinds, "kinds")
    mixed = kinds.groupBy("fp").agg(F.count("*").alias("k"), F.min("c").alias("c"), F.sum("one.len").alias("total")).where("k > 1 and c = 1")
    part = F.greatest(F.lit(part_bytes), F.least(F.lit(LARGE_PART), F.col("total") / SOME_PARTS))
    mixed = stage_table(mixed.select("fp", F.ceil(F.col("total") / part).cast("int").alias("parts")), "mixed")

    wanted = kinds.join(mixed.select("fp"), "fp").select("one.doc_id", "one.th", F.struct("fp", "rh", "c", "one.s", "one.len").alias("w"))
    wanted = wanted.groupBy("doc_id", "th").agg(F.collect_list("w").alias("w"))
    strings = some.dropDuplicates(["doc_id", "th"]).join(wanted, ["doc_id", "th"]).select("text", "w").transform(arrow, _slices, "fp long, rh long, c long, bytes binary")
    by_words = []
    if words:
        strings = stage_table(strings, "strings")
        windows = strings.where("(fp & 1) = 1").transform(arrow, _word_windows(words), "fp long, rh long, c long, a int, z int, h1 long, h2 long")
        windows = stage_table(windows, "windows")
        again = windows.groupBy("h1", "h2").agg(F.count("*").alias("k")).where("k > 1").select("h1", "h2")
        again = windows.where("c = 1").join(again, ["h1", "h2"]).groupBy("fp", "rh")
        by_words.append(again.agg(F.flatten(F.collect_list(F.array("a", "z"))).alias("runs")))
        strings = strings.where("(fp & 1) = 0")
    strings = strings.join(mixed, "fp").withColumn("part", F.pmod(F.xxhash64("rh"), "parts").cast("int"))
    cells = strings.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = cells.select("fp", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "rh", "c", "bytes")
    runs = cells.repartition("fp", "i", "j").sortWithinPartitions("fp", "i", "j").transform(arrow, _search(width), "fp long, rh long, runs array<int>")
    runs = runs.groupBy("fp", "rh").agg(F.flatten(F.collect_list("runs")).alias("runs"))

    whole = kinds.where("c > 1").select("fp", "rh", F.lit(None).cast("array<int>").alias("runs"))
    gone = stage_table(reduce(DataFrame.unionByName, by_words, whole.unionByName(runs)), "runs")
    spans = shared.join(gone, ["fp", "rh"]).groupBy("doc_id", "th").agg(F.collect_set(F.struct("s", "len", "runs")).alias("spans"))
    out = plain.join(spans, ["doc_id", "th"], "left").select("own", "text", "spans", "carried")
    schema = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType()), ("kept_text", T.StringType()), ("carried", out.schema["carried"].dataType))])
    return out.transform(arrow, _remove, schema)
