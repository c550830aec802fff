"""Relational operators: clusters, ledgers, splits, islands, scenes, as-of joins, histograms, distributions."""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def exact_clusters(items: DataFrame, sha: str = "sha256", item: str = "id") -> DataFrame:
    """Items of equal content: id, representative (smallest id) and size; members come from a join, not a list."""
    grouped = items.groupBy(F.col(sha).alias("sha256")).agg(F.min(item).alias("representative_id"), F.count("*").alias("n_items"))
    return grouped.withColumn("cluster_id", F.concat(F.lit("exact-"), F.substring("sha256", 1, 16)))


def cluster_members(items: DataFrame, clusters: DataFrame, sha: str = "sha256") -> DataFrame:
    return items.join(clusters.withColumnRenamed("sha256", "_sha"), F.col(sha) == F.col("_sha")).drop("_sha")


def upsert(ledger: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``fresh`` replace those of the ledger with the same keys, the others are kept."""
    return ledger.join(fresh.select(keys), keys, "left_anti").unionByName(fresh)


def not_in(df: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(ledger.select(keys), keys, "left_anti")


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """A row for each rule that a row breaks; one pass, whatever the number of rules.

    Each row is made once, before its rules, as a generator isn't merged with what stands below it: else every rule
    would make the parts it needs again. Broken rules are bits of a number, 62 of them each.
    """
    names = list(rules)
    parts = [names[i : i + 62] for i in range(0, len(names), 62)]
    bit = lambda name, j: F.when(F.coalesce(rules[name], F.lit(False)), F.lit(0)).otherwise(F.lit(1 << j)).cast("long")
    masks = [reduce(Column.bitwiseOR, [bit(name, j) for j, name in enumerate(part)]).alias(f"_broken{k}") for k, part in enumerate(parts)]
    broken = lambda part, mask: F.filter(F.array(*map(F.lit, part)), lambda _, j: F.getbit(mask, j) == 1)
    made = df.select(F.explode(F.array(F.struct(*df.columns))).alias("_row")).select("_row.*")
    found = F.concat(*(broken(part, F.col(f"_broken{k}")) for k, part in enumerate(parts))) if names else F.array().cast("array<string>")
    return made.select(F.col(key).alias("id"), *masks).select("id", F.explode(found).alias("rule"))


def reasons(rules: dict[str, Column]) -> Column:
    """Names of the conditions that hold against a row, in order; empty means allowed."""
    return F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules.items())))


def duplicates(df: DataFrame, key: str, order: str) -> DataFrame:
    """All rows of a key but its first."""
    n = F.row_number().over(W.partitionBy(key).orderBy(order))
    return df.withColumn("_n", n).where("_n > 1").drop("_n")


def non_decreasing(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    prior = F.lag(value).over(W.partitionBy(key).orderBy(*order))
    return df.withColumn("_ok", F.coalesce(F.col(value) >= prior, F.lit(True))).groupBy(key).agg(F.bool_and("_ok").alias("monotone"))


def islands(df: DataFrame, key: str, position: str, gap: int, least: int) -> DataFrame:
    """Runs of positions at most ``gap`` missing ones apart and ``least`` long: start and end, the end excluded."""
    w = W.partitionBy(key).orderBy(position)
    new = (F.col(position) - F.lag(position).over(w) - 1 > gap).cast("int")
    marked = df.select(key, position).distinct().withColumn("_new", F.coalesce(new, F.lit(0)))
    named = marked.withColumn("_run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    runs = named.groupBy(key, "_run").agg(F.min(position).alias("start"), (F.max(position) + 1).alias("end"))
    return runs.where(F.col("end") - F.col("start") >= least).drop("_run")


def intervals(df: DataFrame, key: str, cut: str) -> DataFrame:
    """Half-open intervals between neighbouring cuts of a key; the last has none after it and is left out."""
    return df.withColumn("next", F.lead(cut).over(W.partitionBy(key).orderBy(cut))).where(F.col("next").isNotNull() & (F.col("next") > F.col(cut)))


def asof_forward(left: DataFrame, right: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """First right row at or after each left row's time within its key: one sort of both sides, no range join.

    Both sides are put in one descending order, right rows before left rows of the same time, and each left row takes
    the last value so far; equal times give the smallest value.
    """
    a = left.withColumn("_v", F.lit(None).cast(right.schema[value].dataType)).withColumn("_side", F.lit(0)).withColumn("_payload", F.struct(*left.columns))
    b = right.select(key, time, F.col(value).alias("_v")).withColumn("_side", F.lit(1)).withColumn("_payload", F.lit(None).cast(a.schema["_payload"].dataType))
    both = a.select(key, time, "_v", "_side", "_payload").unionByName(b.select(key, time, "_v", "_side", "_payload"))
    w = W.partitionBy(key).orderBy(F.desc(time), F.desc("_side"), F.desc("_v")).rowsBetween(W.unboundedPreceding, 0)
    return both.withColumn(value, F.last("_v", ignorenulls=True).over(w)).where("_side = 0").select("_payload.*", value)


def bucket_histogram(df: DataFrame, value: str, buckets: DataFrame) -> DataFrame:
    """Counts by bucket (lo, hi, weight), both ends included; empty buckets stay. Buckets are a few configured rows.

    Values are counted first, so the join of the ranges sees each distinct value once.
    """
    counted = df.groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    hit = counted.join(F.broadcast(buckets), F.col("_v").between(F.col("lo"), F.col("hi")))
    own = hit.groupBy("lo", "hi").agg(F.sum("_n").alias("n"))
    total = df.agg(F.count(value).alias("total"))
    out = buckets.join(own, ["lo", "hi"], "left").crossJoin(F.broadcast(total)).withColumn("n", F.coalesce("n", F.lit(0)))
    share = F.coalesce(F.try_divide(F.col("n"), F.col("total")), F.lit(0.0))
    target = F.col("weight") / F.sum("weight").over(W.partitionBy(F.lit(1)))
    return out.withColumn("actual", share).withColumn("target", target).withColumn("deviation", F.col("actual") - F.col("target")).drop("total")


def frequencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts of each value of each column in one pass over the data, as (field, value, n); null counts as unknown."""
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias("value")) for c in columns))
    return df.select(F.explode(pairs).alias("p")).groupBy("p.field", "p.value").agg(F.count("*").alias("n"))


def hash_split(bucket: Column, ratios: dict[str, float]) -> Column:
    """Split by a 32-bit hash: the scalable allocation, whose shares hold by expectation and which needs no order."""
    edges, total = [], 0.0
    for name, share in ratios.items():
        total += share
        edges.append((name, int(total * 2**32)))
    last = list(ratios)[-1]
    return reduce(lambda out, e: F.when(bucket < e[1], e[0]).otherwise(out), reversed(edges[:-1]), F.lit(last))


def group_shares(df: DataFrame, split: str, dimensions: list[str]) -> DataFrame:
    """Share of each value of each dimension within its split."""
    pairs = F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions))
    n = df.select(split, F.explode(pairs).alias("p")).groupBy(split, "p.dimension", "p.value").agg(F.count("*").alias("n"))
    sizes = df.groupBy(split).agg(F.count("*").alias("total"))
    return n.where("value is not null").join(F.broadcast(sizes), split).withColumn("share", F.col("n") / F.col("total"))


def round_robin(left: DataFrame, position: Column, right: DataFrame, right_position: str, size: int) -> DataFrame:
    """Row i of the left side with row i mod ``size`` of the right."""
    return left.withColumn("_slot", F.pmod(position, F.lit(size))).join(right.withColumnRenamed(right_position, "_slot"), "_slot").drop("_slot")


def rate_slots(df: DataFrame, key: str, order: list[str], now: str, step: int) -> DataFrame:
    """Earliest start of each request, ``step`` apart within a key: max over j <= i of now_j + (i - j) * step."""
    i = F.row_number().over(W.partitionBy(key).orderBy(*order))
    ranked = df.withColumn("_i", i)
    best = F.max(F.col(now) - F.col("_i") * step).over(W.partitionBy(key).orderBy("_i").rowsBetween(W.unboundedPreceding, 0))
    return ranked.withColumn("slot", best + F.col("_i") * step).drop("_i")


def weighted_choice(u: Column, options: list[tuple[str, float]]) -> Column:
    """Option at ``u`` in [0, 1) of the summed weights: the first whose running sum is not below it."""
    total, acc, out = sum(w for _, w in options), 0.0, F
    for name, w in options[:-1]:
        acc += w
        out = out.when(u * total <= acc, name)
    return out.otherwise(options[-1][0]) if out is not F else F.lit(options[-1][0])


def flips(width: int, most: int) -> list[int]:
    """All numbers of ``width`` bits with ``most`` of them set at most."""
    return [sum(1 << b for b in bits) for k in range(most + 1) for bits in combinations(range(width), k)]


def hamming_pairs(df: DataFrame, key: str, value: str, most: int, bands: int | None = None) -> DataFrame:
    """Pairs of 64-bit hashes at most ``most`` bits apart, each once.

    The bits are cut into ``bands`` (by default as many as keep the neighbours of a band's value below some hundreds).
    Of a close pair one band differs in ``most // bands`` bits at most, so one side is asked for under all values that
    near, the other stands under its own. A pair is given by its first such band only. Wide bands have few rows a value.
    """
    probes = lambda b: sum(comb(-(-64 // b), k) for k in range(most // b + 1))
    bands = bands or next(b for b in range(1, most + 2) if probes(b) <= 256)
    width, near = -(-64 // bands), most // bands
    bits = [min(width, 64 - k * width) for k in range(bands)]
    part = lambda c, k: F.shiftrightunsigned(c, k * width).bitwiseAND(F.lit((1 << bits[k]) - 1 if bits[k] < 64 else -1))
    own = F.array(*(F.struct(F.lit(k).alias("k"), part(F.col(value), k).alias("h")) for k in range(bands)))
    stored = df.select(F.col(key).alias("b"), F.col(value).alias("y"), F.explode(own).alias("band"))
    masks = F.array(*(F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in flips(width, near)))
    asked = df.select(F.col(key).alias("a"), F.col(value).alias("x"), F.explode(own).alias("o"))
    asked = asked.select("a", "x", "o.k", F.explode(F.transform(masks, lambda m: F.col("o.h").bitwiseXOR(m))).alias("h"))
    stored = stored.select("b", "y", "band.k", "band.h")
    diff = F.col("x").bitwiseXOR(F.col("y"))
    first = F.coalesce(*(F.when(F.bit_count(part(diff, k)) <= near, F.lit(k)) for k in range(bands)))
    pairs = stored.join(asked, ["k", "h"]).where((F.col("a") < F.col("b")) & (F.bit_count(diff) <= most) & (first == F.col("k")))
    return pairs.select("a", "b", F.bit_count(diff).alias("distance"))


def asof_nearest(left: DataFrame, right: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """Right row nearest in time to each left row within its key, before or after; of equally near ones the earliest,
    of one time the smallest value. One sort of both sides; no right row of the key gives null.
    """
    kind = right.schema[value].dataType
    a = left.withColumn("_at", F.lit(None).cast(right.schema[time].dataType)).withColumn("_v", F.lit(None).cast(kind)).withColumn("_side", F.lit(1)).withColumn("_payload", F.struct(*left.columns))
    names = [key, time, "_at", "_v", "_side", "_payload"]
    b = right.groupBy(key, time).agg(F.min(value).alias("_v")).withColumn("_at", F.col(time)).withColumn("_side", F.lit(0)).withColumn("_payload", F.lit(None).cast(a.schema["_payload"].dataType))
    both = a.select(names).unionByName(b.select(names))
    hit = F.when(F.col("_at").isNotNull(), F.struct("_at", "_v"))
    ahead, behind = W.partitionBy(key).orderBy(F.desc(time), F.desc("_side")), W.partitionBy(key).orderBy(time, "_side")
    upto = lambda w: F.last(hit, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    found = both.withColumn("_before", upto(behind)).withColumn("_after", upto(ahead)).where("_side = 1")
    closer = F.col("_before").isNull() | (F.col("_after._at") - F.col(time) < F.col(time) - F.col("_before._at"))
    return found.withColumn(value, F.when(closer, F.col("_after._v")).otherwise(F.col("_before._v"))).select("_payload.*", value)


def numbered(df: DataFrame, order: str, name: str = "position", ranges: int = 256) -> DataFrame:
    """Adds the place of each row in the order of a numeric column, from 0, without a task that holds all rows.

    Rows are dealt by ranges between approximate quantiles, which the driver sees with the ranges' sizes; equal values
    share a range and are numbered in any order.
    """
    bounds = sorted(set(df.agg(F.percentile_approx(order, [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0] or []))
    part = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col(order))) if bounds else F.lit(0)
    dealt = df.withColumn("_part", part)
    starts, total = {}, 0
    for r in dealt.groupBy("_part").count().orderBy("_part").collect():
        starts[r["_part"]], total = total, total + r["count"]
    begin = F.create_map(*(F.lit(x) for pair in starts.items() for x in pair)) if starts else F.create_map().cast("map<int,int>")
    own = F.row_number().over(W.partitionBy("_part").orderBy(order)) - 1
    return dealt.withColumn(name, F.try_element_at(begin, F.col("_part")).cast("long") + own).drop("_part")
