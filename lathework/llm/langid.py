"""Language identification: prediction by partial matching with frozen statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.llm import vec
from lathework.llm.runtime import arrow, prepare

#: Bytes of context at most; shallower contexts stand where a deeper one was met less than LEAST_SEEN times.
ORDER, LEAST_SEEN = 3, 48
#: Bytes of training text a language, by expectation; every text is used whole.
TRAIN_BYTES = 6 << 20

#: Letters keep their lower case, every other ASCII byte is a blank, bytes from 0x80 stand for themselves.
FOLD = np.array([b if 97 <= b <= 122 or b >= 0x80 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], np.uint8)


def symbols(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes of a block, runs of blanks as one, ORDER blanks in front of each text; where each text starts."""
    b = vec.Block([b" " * ORDER + d for d in docs], lower=False)
    s = FOLD[b.buf]
    blank = s == 32
    keep = np.append(True, ~(blank[1:] & blank[:-1]))
    for k in range(ORDER):
        keep[b.first + k] = True
    first = np.cumsum(keep)[b.first] - 1
    return s[keep], first


def grams(s: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Code of each symbol with its ORDER predecessors, from the first symbol of a text on; -1 in the padding."""
    code = np.zeros(len(s), np.int64)
    for k in range(ORDER, -1, -1):
        code[ORDER:] = (code[ORDER:] << 8) | s[ORDER - k : len(s) - k]
    for k in range(ORDER):
        code[first + k] = -1
    return code


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        docs = vec.texts(batch.column(1))
        for lang in set(langs.tolist()):
            own = [docs[i] for i in np.flatnonzero(langs == lang)]
            for i, j in vec.blocks(own):
                code = grams(*symbols(own[i:j]))
                parts = held.setdefault(lang, [])
                parts.append(np.unique(code[code >= 0], return_counts=True))
                if len(parts) > 16:
                    held[lang] = [_merge(parts)]
    for lang, parts in held.items():
        code, n = _merge(parts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code)), pa.array(code), pa.array(n)], ["lang", "code", "n"])


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code, inverse = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return code, np.bincount(inverse, np.concatenate([n for _, n in parts]), len(code)).astype(np.int64)


class Trees:
    """Context trees of all languages as one table: code length of a symbol after a context, for each language.

    A context met in training continues with its own counts; a symbol not met there costs an escape, d / (n + d) with
    d distinct symbols in n, and goes on in the context shortened by its first byte, at last to equal odds.
    """

    def __init__(self, langs: list[str], lang: np.ndarray, code: np.ndarray, n: np.ndarray):
        self.langs = langs
        seen = np.unique(np.concatenate([(code >> (8 * k)) & 255 for k in range(ORDER + 1)] + [np.array([32])]))
        self.size = a = len(seen) + 1  # the last stands for bytes not met
        self.symbol = np.full(256, a - 1, np.int64)
        self.symbol[seen] = np.arange(len(seen))
        part = [self.symbol[(code >> (8 * k)) & 255] for k in range(ORDER + 1)]  # part[0] is the symbol itself
        m = len(langs)
        cost = np.full((1, a, m), np.log2(a))
        context = np.zeros(len(code), np.int64)
        for order in range(ORDER):
            if order:
                context = context + part[order] * a ** (order - 1)
                cost = np.tile(cost, (a, 1, 1))
            cost = self._extend(cost, context, part[0], lang, n, a**order)
        # the deepest order has only the contexts that were met often enough
        deep = context + part[ORDER] * a ** (ORDER - 1)
        name, inverse = np.unique(deep, return_inverse=True)
        often = np.bincount(inverse, n, len(name)) >= LEAST_SEEN
        kept = name[often]
        row = np.full(len(name), -1, np.int64)
        row[often] = np.arange(len(kept))
        use = row[inverse] >= 0
        last = self._extend(cost[kept % a ** (ORDER - 1)], row[inverse][use], part[0][use], lang[use], n[use], len(kept))
        self.cost = np.concatenate((cost, last)).reshape(-1, m).astype(np.float32)
        self.state = np.tile(np.arange(a ** (ORDER - 1), dtype=np.int32), a)
        self.state[kept] = a ** (ORDER - 1) + np.arange(len(kept), dtype=np.int32)

    @staticmethod
    def _extend(shorter: np.ndarray, context: np.ndarray, symbol: np.ndarray, lang: np.ndarray, n: np.ndarray, rows: int) -> np.ndarray:
        a, m = shorter.shape[1:]
        count = np.bincount((context * a + symbol) * m + lang, n, rows * a * m).reshape(rows, a, m)
        total, kinds = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            own = np.log2(total + kinds) - np.log2(count)
            escape = np.where(total > 0, np.log2(total + kinds) - np.log2(kinds), 0.0)
        return np.where(count > 0, own, escape + shorter)

    def lengths(self, docs: list[bytes]) -> np.ndarray:
        """Bits that each text takes in each language."""
        s, first = symbols(docs)
        at = self.symbol[s]
        a = self.size
        context = np.zeros(len(s), np.int64)
        for k in range(ORDER, 0, -1):
            context[ORDER:] = context[ORDER:] * a + at[ORDER - k : len(s) - k]
        where = self.state[context].astype(np.int64) * a + at
        cost = self.cost[where]
        for k in range(ORDER):
            cost[first + k] = 0
        return np.stack([np.add.reduceat(cost[:, k].astype(float), first) for k in range(cost.shape[1])], 1)


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def identify_language(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_bytes: int = TRAIN_BYTES) -> DataFrame:
    """Predict the language of whole texts; learn from ``lang_col`` of documents outside the held-out fifth.

    Training reads a sample of whole documents, ``train_bytes`` a language by expectation, chosen by a hash of the id;
    the counted context trees, bounded by that, go to the workers. Returns ``doc_id, held_out, lang_pred, score``;
    the score is the predicted language's share of the likelihood 2**-bits. Contexts have ORDER bytes at most; one that
    was met less than LEAST_SEEN times in a language gives way to a shorter one there, which bounds the trees and keeps
    what few texts happen to share from telling.

    Very long texts are read whole. Texts that are null or have no letter get ``und`` and 0, as do all texts when nothing can be learnt. Equal
    likelihoods go to the language that sorts first. Repeated rows are each predicted; other columns are ignored.
    """
    prepare(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    train = plain.where(~held & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = train.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("b")).collect()
    share = F.lit(0.0)
    for r in sizes:
        share = F.when(F.col("lang") == r.lang, min(1.0, train_bytes / max(r.b, 1))).otherwise(share)
    chosen = train.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20)).select("lang", "text")
    counted = chosen.transform(arrow, _count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(counted["lang"]))
    number = {x: i for i, x in enumerate(langs)}
    model = docs.sparkSession.sparkContext.broadcast((langs, counted["lang"].map(number).to_numpy(np.int64), counted["code"].to_numpy(np.int64), counted["n"].to_numpy(np.int64)))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees(*model.value) if model.value[0] else None
        for batch in batches:
            docs = vec.texts(batch.column(1))
            names, scores = [], []
            for i, j in vec.blocks(docs):
                if trees is None:
                    names += ["und"] * (j - i)
                    scores += [0.0] * (j - i)
                    continue
                bits = trees.lengths(docs[i:j])
                best = bits.argmin(1)
                odds = 1 / np.exp2(np.clip(bits.min(1, keepdims=True) - bits, -1000, 0)).sum(1)
                letter = [has_letter(d) for d in docs[i:j]]
                names += [trees.langs[b] if ok else "und" for b, ok in zip(best, letter, strict=True)]
                scores += [float(o) if ok else 0.0 for o, ok in zip(odds, letter, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    found = plain.select("doc_id", "text").transform(arrow, predict, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
