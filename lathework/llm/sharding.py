"""Sharding: minimax contiguous partition of ordered atomic groups."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lathework.llm.runtime import stage_table

#: Hex digits of the group key by which sizes are first summed, and digits added where a cut may fall.
FIRST_DIGITS, MORE_DIGITS, KEY_DIGITS = 4, 2, 32
#: Rows of a cell in which slots are numbered by one task, and the least number of cells.
CELL_ROWS, LEAST_CELLS = 100_000, 1024


@dataclass
class Blocks:
    """Runs of groups in key order: first key digits, bytes, largest group, number of groups."""

    key: list[str]
    size: np.ndarray
    most: np.ndarray
    groups: np.ndarray

    @property
    def sums(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.size)))


def whole_cuts(sums: np.ndarray, capacity: int, shards: int) -> list[int] | None:
    """Greedy cuts between blocks that are never split; None if ``shards`` of ``capacity`` don't hold all."""
    cuts = [0]
    while cuts[-1] < len(sums) - 1:
        if len(cuts) > shards:
            return None
        to = int(np.searchsorted(sums, sums[cuts[-1]] + capacity, "right")) - 1
        if to == cuts[-1]:
            return None
        cuts.append(to)
    return cuts


def free_cuts(blocks: Blocks, sums: np.ndarray, capacity: int, shards: int) -> list[int] | None:
    """As ``whole_cuts``, but blocks of several groups may be cut at any byte: never later than the true cuts allow."""
    cuts, total = [0], int(sums[-1])
    while cuts[-1] < total:
        if len(cuts) > shards:
            return None
        to = min(total, cuts[-1] + capacity)
        b = int(np.searchsorted(sums, to, "right")) - 1
        if to < total and to > sums[b] and blocks.groups[b] == 1:
            to = int(sums[b])
        if to <= cuts[-1]:
            return None
        cuts.append(to)
    return cuts


def least(feasible, low: int, high: int) -> int:
    """Smallest feasible capacity in [low, high]; ``high`` is feasible."""
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if feasible(mid) else (mid + 1, high)
    return low


def solve(blocks: Blocks, shards: int) -> tuple[int, list[int], set[int]]:
    """Capacity and cuts with blocks kept whole, and the blocks of several groups in which a true cut could fall."""
    sums, total = blocks.sums, int(blocks.size.sum())
    floor = max(int(blocks.most.max()), -(-total // shards))
    top = least(lambda c: whole_cuts(sums, c, shards) is not None, max(floor, int(blocks.size.max())), max(total, 1))
    low = least(lambda c: free_cuts(blocks, sums, c, shards) is not None, floor, top)
    cuts = whole_cuts(sums, top, shards)
    early = [0]  # cuts that come no later than the true ones at the lowest capacity
    while early[-1] < len(sums) - 1 and len(early) <= shards:
        early.append(max(early[-1], int(np.searchsorted(sums, sums[early[-1]] + low, "right")) - 1))
    late = free_cuts(blocks, sums, top, shards)
    late += [total] * (len(early) - len(late))
    open_ = set()
    if low < top:
        for a, z in zip(early[1:], late[1:], strict=False):
            last = min(int(np.searchsorted(sums, z, "left")), len(blocks.key))
            open_ |= {b for b in range(a, last) if blocks.groups[b] > 1}
    return top, cuts, open_


def sized_groups(groups: DataFrame, digits: int, within: list[str] | None) -> list:
    """Bytes, largest group and number of groups by the first ``digits`` of the key; only under ``within``, if given."""
    if within is not None:
        groups = groups.where(F.substring("key", 1, len(within[0])).isin(within))
    return groups.groupBy(F.substring("key", 1, digits).alias("p")).agg(F.sum("bytes").alias("b"), F.max("bytes").alias("m"), F.count("*").alias("n")).collect()


def plan_cuts(groups: DataFrame, shards: int) -> list[str]:
    """First keys of shards 1, 2, ... of the minimax partition of ``groups`` (key, bytes) in key order.

    The driver sees sums by key prefix only: 16**FIRST_DIGITS rows at most, then 16**MORE_DIGITS for each of the few
    blocks in which a cut could fall, until those hold one group each.
    """
    rows = sorted(sized_groups(groups, FIRST_DIGITS, None), key=lambda r: r.p)
    if not rows:
        return []
    cells = {r.p: (r.b, r.m, r.n) for r in rows}
    while True:
        keys = sorted(cells)
        blocks = Blocks(keys, *(np.array([cells[k][i] for k in keys], np.int64) for i in range(3)))
        _, cuts, open_ = solve(blocks, shards)
        by_length: dict[int, list[str]] = {}
        for b in open_:
            if len(keys[b]) < KEY_DIGITS:
                by_length.setdefault(len(keys[b]), []).append(keys[b])
        if not by_length:
            return [keys[c] for c in cuts[1:-1]]
        for length, within in by_length.items():
            for k in within:
                del cells[k]
            cells |= {r.p: (r.b, r.m, r.n) for r in sized_groups(groups, length + MORE_DIGITS, within)}


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put documents into ``shards`` shards of nearly equal bytes (law ``bytes``), copies of a text together.

    Groups are equal texts, in this order: those above a fair share of what is left, largest first, then the others by
    the MD5 of their text. The contiguous cuts of that order are minimax shard by shard: a group above a fair share
    bounds the capacity from below, so it fills a shard alone, and the next capacity is the smallest that suffices for
    the rest in the shards that are left. With one capacity for all, such a group's size would be the capacity of every
    shard, and the last shards would stay empty. Returns ``doc_id, size,
    text_crc32, law, shard, slot, grown_shard`` and ``group_key``.

    Very long texts are sized whole; groups of equal size go by their key. Null text: no bytes, size 1, checksum 0, a group of its own; empty text: size 1 too. Repeated rows each get a slot.
    An empty table gives no rows; with fewer groups than shards some shards stay empty. Other columns are ignored.
    """
    text = F.col(text_col)
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.encode(text, "UTF-8"), F.lit(b""))).alias("text_crc32"),
        F.coalesce(F.md5(text), F.lit("0" * KEY_DIGITS)).alias("key"),
    )
    base = stage_table(base, "sizes")
    groups = stage_table(base.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    top = groups.orderBy(F.desc("bytes"), "key").limit(shards).collect()
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    giants: list[str] = []
    for r in top:
        if len(giants) < shards - 1 and r.bytes * (shards - len(giants)) > total:
            giants.append(r.key)
            total -= r.bytes
    rest = groups.where(~F.col("key").isin(giants)) if giants else groups
    cuts = plan_cuts(rest, shards - len(giants))

    shard = F.lit(len(giants))
    for c in cuts:
        shard = shard + (F.col("key") >= c).cast("int")
    for i, g in enumerate(giants):
        shard = F.when(F.col("key") == g, i).otherwise(shard)
    n_cells = max(LEAST_CELLS, -(-base.count() // CELL_ROWS))
    placed = base.withColumn("shard", shard.cast("int")).withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.lit(n_cells)))
    counts = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.withColumn("o", F.coalesce(F.sum("n").over(before), F.lit(0))).groupBy("cell").agg(F.map_from_entries(F.collect_list(F.struct("shard", "o"))).alias("o"))
    numbered = placed.repartition(F.col("cell")).withColumn("i", F.row_number().over(W.partitionBy("cell", "shard").orderBy("doc_id", "key")))
    return numbered.join(offsets, "cell").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("i") - 1 + F.try_element_at("o", F.col("shard"))).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("key").alias("group_key"),
    )
