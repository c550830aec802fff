"""Every query of the library with its SQL twin, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.functions import geometry as G
from lathework.functions import ids, text
from lathework.functions import timebase as T
from lathework.operators import contracts, registry, reports, sampling
from lathework.operators import relational as R
from lathework.operators import sequential as S
from lathework.plans import export
from lathework.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

RATIOS = {"train": 0.8, "val": 0.1, "test": 0.1}
#: Fixed buckets of durations in milliseconds with their weights.
BUCKETS = [(0, 2699, 2.0), (2700, 2999, 1.0), (3000, 9999, 5.0), (10000, 99999, 2.0)]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def chars(s: str) -> str:
    return "||".join(f"chr({ord(c)})" for c in s)


# --- text ---------------------------------------------------------------------------------------------------------

FULL, HALF = quoted(text.FULL_WIDTH), quoted(text.HALF_WIDTH)
RULE_SQL = {
    "fullwidth_ascii": f"translate({{}}, {FULL}, {HALF})",
    "ideographic_space": "replace({}, chr(12288), ' ')",
    "newlines": "replace(replace({}, chr(13)||chr(10), chr(10)), chr(13), chr(10))",
    "whitespace": "regexp_replace({}, '[ \\t]+', ' ', 'g')",
    "punctuation_spacing": f"regexp_replace(regexp_replace({{}}, '[ \\t]+([{text.CLOSING}])', '\\1', 'g'), '([{text.OPENING}])[ \\t]+', '\\1', 'g')",
    "strip_lines": f"array_to_string(list_filter(list_transform(string_split({{}}, chr(10)), lambda x: trim(x, {chars(text.BLANKS)})), lambda x: x <> ''), chr(10))",
}
#: A text with everything that the rules change, made from plain prose on both sides alike.
MESSY = "concat(replace(replace(text, 'e', 'Ａ　'), ', ', ' ，  '), chr(13), chr(10), '  （ ', lang, '\t\t） ')"


def messy() -> F.Column:
    return F.concat(F.replace(F.replace("text", F.lit("e"), F.lit("Ａ　")), F.lit(", "), F.lit(" ，  ")), F.lit("\r\n  （ "), F.col("lang"), F.lit("\t\t） "))


def nested(rules: tuple[str, ...], inner: str) -> str:
    for r in rules:
        inner = RULE_SQL[r].format(inner)
    return inner


def script_sql(column: str) -> str:
    return "case " + " ".join(f"when regexp_matches({column}, {quoted(text.script_class(n))}) then '{n}'" for n in text.SCRIPTS) + " else 'Other' end"


@query("select sha256(text) as sha256, min(doc_id) as representative_id, count(*) as n_items, 'exact-' || substr(sha256(text), 1, 16) as cluster_id from documents group by text")
def exact_dedup_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))
    return R.exact_clusters(docs, "sha", "doc_id")


@query("select doc_id, min(doc_id) over (partition by text) as representative_id, count(*) over (partition by text) as n_items from documents")
def exact_cluster_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))
    return R.cluster_members(docs, R.exact_clusters(docs, "sha", "doc_id"), "sha").select("doc_id", "representative_id", "n_items")


@query("select count(*) as n, count(distinct text) as n_distinct, count(*) - count(distinct doc_id) as repeated_ids from documents")
def dedup_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))
    return docs.agg(F.count("*").alias("n"), F.countDistinct("sha").alias("n_distinct"), (F.count("*") - F.countDistinct("doc_id")).alias("repeated_ids"))


@query(f"select doc_id, sha256({nested(text.rules_of(), MESSY)}) as sha, length({nested(text.rules_of(), MESSY)}) as n from documents")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = read(spark, sf_dir, "documents").select("doc_id", text.normalize(messy()).alias("c"))
    return normal.select("doc_id", F.sha2("c", 256).alias("sha"), F.char_length("c").cast("long").alias("n"))


@query(
    " union all ".join(
        f"select '{r}' as rule, count(*) as hits from documents where {nested(text.rules_of()[: i + 1], MESSY)} <> {nested(text.rules_of()[:i], MESSY)} having count(*) > 0" for i, r in enumerate(text.rules_of())
    )
)
def normalize_rule_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = read(spark, sf_dir, "documents").select(F.explode(text.applied_rules(messy())).alias("rule"))
    return hits.groupBy("rule").agg(F.count("*").alias("hits"))


#: A sign of another script before the whole text of each document, or none.
SIGNED_TEXT = "case doc_id % 6 when 0 then 'あ' when 1 then '漢' when 2 then '한' when 3 then 'ع' else '' end || text"


@query(f"select doc_id, {script_sql('text')} as script, {script_sql(f'({SIGNED_TEXT})')} as signed from documents")
def detect_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("t", F.expr(SIGNED_TEXT))
    return docs.select("doc_id", text.detect_script(F.col("text")).alias("script"), text.detect_script(F.col("t")).alias("signed"))


@query("select lang as value, 'lang' as field, count(*) as n from documents group by lang union all select source, 'source', count(*) from documents group by source union all select cast(length(text) - length(replace(text, chr(10), '')) + 1 as varchar), 'lines', count(*) from documents group by 1")
def field_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("lines", text.line_count(F.col("text")))
    return R.frequencies(docs, ["lang", "source", "lines"])


@query(
    f"with l as (select doc_id, unnest(string_split(text, chr(10))) as line from documents), s as (select doc_id, trim(line, {chars(text.BLANKS)}) as line from l) select doc_id, count(*) as n, min(line) as first from s where line <> '' and line not like '#%' group by doc_id"
)
def corpus_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lathework.sources.readers import corpus

    lines = read(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("value"))
    line = F.btrim("value", F.lit(text.BLANKS))
    return corpus(lines.withColumn("value", F.concat_ws("\0", line, "doc_id"))).select(F.split("line", "\0").alias("p")).where(F.col("p")[0] != "").groupBy(F.col("p")[1].cast("long").alias("doc_id")).agg(F.count("*").alias("n"), F.min(F.col("p")[0]).alias("first"))


# --- ids ----------------------------------------------------------------------------------------------------------


@query("""select o_orderkey, sha256('{"crop_xywh":[0,0,' || o_custkey || ',9],"dataset_version":"v1","event_id":"' || o_orderpriority || '","native_frame_index":' || o_custkey || ',"pts":' || o_orderkey || ',"style_seed":7,"video_sha256":"' || o_orderstatus || '"}') as sample_id from orders""")
def canonical_json_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    crop = F.array(F.lit(0), F.lit(0), F.col("o_custkey"), F.lit(9))
    own = ids.sample_id(F.lit("v1"), F.col("o_orderstatus"), F.col("o_custkey"), F.col("o_orderkey"), crop, F.col("o_orderpriority"), F.lit(7))
    return read(spark, sf_dir, "orders").select("o_orderkey", own.alias("sample_id"))


@query("""select event_id, sha256('{"seed":1,"start_time_ms":' || event_id || ',"style_seed":1,"text_raw":"' || event_type || '"}') as content_id from events""")
def event_content_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = ids.event_id(F.col("event_type"), F.col("event_id"), F.lit(1), F.lit(1))
    return read(spark, sf_dir, "events").select("event_id", own.alias("content_id"))


DHASH = "list_reduce(list_prepend(0::bigint, list_transform(list_filter(range(64), lambda i: i%8<7), lambda i: case when embedding[i+2]>embedding[i+1] then 1::bigint else 0::bigint end)), lambda x, b: x*2+b)"


@query(f"select vec_id, {DHASH} as hash from embeddings")
def dhash_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select("vec_id", ids.difference_hash(F.col("embedding")).alias("hash"))


@query(f"with h as (select vec_id, {DHASH} as hash from embeddings) select a.vec_id as a, b.vec_id as b, cast(bit_count(xor(a.hash, b.hash)) as int) as distance from h a join h b on a.vec_id < b.vec_id and bit_count(xor(a.hash, b.hash)) <= 10")
def hamming_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "embeddings").select("vec_id", ids.difference_hash(F.col("embedding")).alias("hash"))
    return R.hamming_pairs(own, "vec_id", "hash", 10)


@query(f"""with recursive h as (select lpad(vec_id::varchar, 12, '0') as id, {DHASH} as hash from embeddings), o as (select id, hash, row_number() over (order by id) as i from h),
g(i, ids, hashes) as (select 0::bigint, []::varchar[], []::bigint[] union all
select o.i, case when n then ids else list_append(ids, o.id) end, case when n then hashes else list_append(hashes, o.hash) end
from (select g.*, o.id, o.hash, o.i as k, coalesce(list_bool_or(list_transform(g.hashes, lambda x: bit_count(xor(x, o.hash)) <= 14)), false) as n from g join o on o.i = g.i + 1) q join o on o.i = q.k),
r as (select unnest(ids) as rid, unnest(hashes) as rh from (select * from g order by i desc limit 1))
select o.id, min(rid) as representative_id from o join r on rid <= o.id and bit_count(xor(o.hash, rh)) <= 14 group by o.id""")
def near_clusters_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "embeddings").select(F.lpad(F.col("vec_id").cast("string"), 12, "0").alias("id"), ids.difference_hash(F.col("embedding")).alias("hash"))
    return S.near_clusters(own, 14)


# --- quality ------------------------------------------------------------------------------------------------------

RULES = {
    "quantity": "l_quantity between 1 and 45",
    "discount": "l_discount <= 0.08",
    "tax": "l_tax > 0",
    "price": "l_extendedprice / l_quantity < 1500",
    "flag": "l_returnflag in ('A', 'N') or l_linestatus = 'F'",
}


@query(" union all ".join(f"select l_orderkey as id, '{n}' as rule from lineitem where not ({r})" for n, r in RULES.items()))
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.violations(read(spark, sf_dir, "lineitem"), "l_orderkey", {n: F.expr(r) for n, r in RULES.items()})


#: A nested sample of each line item, and SQL's words for its parts: sound but for a defect in every row of some remainders.
SAMPLE_PARTS = {
    "version": "case when l_linenumber = 7 then 'one' else 'v1.' || l_linenumber end",
    "video": "sha256(cast(l_suppkey as varchar))",
    "frame": "l_suppkey",
    "pts": "l_partkey * 512 - case when l_partkey % 29 = 0 then 40000 else 0 end",
    "ms": "cast(round_even(l_partkey * 512 * 1000 / 15360.0::double, 0) as bigint)",
    "width": "case when l_partkey % 11 = 0 then 640 else 1280 end",
    "x0": "100 + l_partkey % 50",
    "y0": "440 + l_suppkey % 60",
    "x1": "case when l_orderkey % 31 = 0 then 90 when l_orderkey % 37 = 0 then 1300 else 600 + l_partkey % 90 end",
    "y1": "case when l_orderkey % 41 = 0 then 721 else 600 + l_suppkey % 110 end",
    "start_frame": "l_linenumber",
    "frames": "l_partkey % 7",
    "event": "'e' || l_partkey",
    "duration": "l_orderkey % 500",
    "opacity": "l_discount * 12",
    "split": "case when l_linenumber = 5 then 'dev' else 'val' end",
}


def nested_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem")
    c, one = F.col, F.lit(1).cast("long")
    digest = lambda x: F.sha2(x.cast("string"), 256)
    version = F.when(c("l_linenumber") == 7, "one").otherwise(F.concat(F.lit("v1."), "l_linenumber"))
    pts = c("l_partkey") * 512 - F.when(c("l_partkey") % 29 == 0, 40000).otherwise(0)
    ms = T.ticks_to_ms(c("l_partkey") * 512, F.lit(1), F.lit(15360))
    width = F.when(c("l_partkey") % 11 == 0, 640).otherwise(1280).cast("long")
    x1 = F.when(c("l_orderkey") % 31 == 0, 90).when(c("l_orderkey") % 37 == 0, 1300).otherwise(600 + c("l_partkey") % 90)
    y1 = F.when(c("l_orderkey") % 41 == 0, 721).otherwise(600 + c("l_suppkey") % 110)
    box = F.array(*(x.cast("long") for x in (100 + c("l_partkey") % 50, 440 + c("l_suppkey") % 60, x1, y1)))
    norm = F.transform(box, lambda x, i: F.round(x / F.when(i % 2 == 0, 1280).otherwise(720), 3))
    crop = F.array(*(F.lit(x).cast("long") for x in (0, 0, 640, 360)))
    event = F.concat(F.lit("e"), "l_partkey")
    own = ids.sample_id(version, digest(c("l_suppkey")), c("l_suppkey"), pts, crop, event, c("l_linenumber").cast("long"))
    end = c("l_linenumber") + c("l_partkey") % 7
    style = F.struct(digest(event).alias("font_sha256"), F.lit(0.04).alias("font_size_h_ratio"), F.lit(0.0).alias("letter_spacing"), F.lit(1.0).alias("line_spacing"), F.lit(0.0).alias("stroke_width_h_ratio"), (c("l_discount") * 12).cast("double").alias("opacity"), c("l_linenumber").cast("long").alias("style_seed"))
    rate = F.struct(F.lit(30).alias("avg_num"), one.alias("avg_den"), F.lit(30).alias("r_num"), one.alias("r_den"), F.lit(False).alias("is_vfr"))
    return rows.select(
        "l_orderkey", "l_linenumber", F.when(c("l_orderkey") % 43 == 0, F.repeat(F.lit("0"), F.lit(64))).otherwise(own).alias("sample_id"),
        F.struct(digest(c("l_suppkey")).alias("video_sha256"), c("l_suppkey").cast("long").alias("native_frame_index"), pts.cast("long").alias("pts"), ms.alias("timestamp_ms"), F.struct(one.alias("num"), F.lit(15360).cast("long").alias("den")).alias("time_base"), rate.alias("frame_rate")).alias("source"),
        F.struct(width.alias("width"), F.lit(720).cast("long").alias("height")).alias("image"),
        F.struct(
            event.alias("event_id"), c("l_linenumber").cast("long").alias("start_native_frame"), end.cast("long").alias("end_native_frame_exclusive"), F.lit(0).alias("start_pts"), (c("l_partkey") % 7).alias("end_pts_exclusive"),
            F.lit(10).alias("start_time_ms"), (10 + c("l_orderkey") % 500).alias("end_time_ms"), (c("l_orderkey") % 500 + F.when(c("l_orderkey") % 53 == 0, 1).otherwise(0)).alias("duration_ms"), (c("l_partkey") % 7).alias("native_duration_frames"),
            box.alias("bbox_xyxy"), norm.alias("bbox_normalized"), style.alias("style"),
        ).alias("subtitle"),
        F.struct(crop.alias("crop_xywh"), F.array(F.lit(1280), F.lit(720)).alias("target_size")).alias("transform"),
        F.struct(version.alias("dataset_version"), digest(version).alias("config_sha256"), F.lit(1).alias("seed")).alias("build"),
        F.when(c("l_linenumber") == 5, "dev").otherwise("val").alias("split"),
    )


_S = "(select l_orderkey, l_linenumber, l_partkey, " + ", ".join(f"{e} as {n}" for n, e in SAMPLE_PARTS.items()) + " from lineitem)"
_OWN = """sha256('{"crop_xywh":[0,0,640,360],"dataset_version":"' || version || '","event_id":"' || event || '","native_frame_index":' || frame || ',"pts":' || pts || ',"style_seed":' || l_linenumber || ',"video_sha256":"' || video || '"}')"""
SAMPLE_SQL = {
    "image has the target size": "width = 1280",
    "box is inside the image": "x0 >= 0 and y0 >= 0 and x1 <= width and y1 <= 720 and x1 > x0 and y1 > y0",
    "normalised box is the pixel box": "width = 1280",
    "centre is in its band": "(y0 + y1) / 2 / 720 between 0.6 and 0.9",
    "sample_id is that of its fields": "l_orderkey % 43 <> 0",
    "time is that of the ticks": "l_partkey % 29 <> 0",
    "frames are in order": "frames > 0",
    "ticks are in order": "frames > 0",
    "times are in order": "duration > 0",
    "duration": "l_orderkey % 53 <> 0",
    "normalised box is in order": "x1 > x0 and y1 > y0",
    "pixel box is in order": "x1 > x0 and y1 > y0",
    "subtitle.duration_ms is above 0": "duration + case when l_orderkey % 53 = 0 then 1 else 0 end > 0",
    "subtitle.native_duration_frames is above 0": "frames > 0",
    "opacity is within 0 and 1": "opacity <= 1",
    "normalised box is within 0 and 1": "x1 <= 1280 and round(y1 / 720, 3) <= 1",
    "dataset version": "version <> 'one'",
    "split": "split = 'val'",
}


@query(f"with s as {_S}, i as (select *, case when l_orderkey % 43 = 0 then repeat('0', 64) else {_OWN} end as sample_id from s) " + " union all ".join(f"select sample_id as id, '{n}' as rule from i where not ({r})" for n, r in SAMPLE_SQL.items()))
def sample_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.sample_violations(nested_samples(spark, sf_dir))


EVENT_SQL = {
    "number of frames": "event_id % 13 <> 0",
    "times are in order": "d > 0",
    "fades fit": "event_id % 300 + event_id % 400 <= d",
    "frames an event": "event_id % 5 between 1 and 3",
}


@query(" union all ".join(f"select event_id as id, '{n}' as rule from (select event_id, event_id % 700 as d from events) where not ({r})" for n, r in EVENT_SQL.items()))
def event_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    own = read(spark, sf_dir, "events").select(
        "event_id", e.alias("start_native_frame"), (e + 9).alias("end_native_frame_exclusive"), (F.lit(9) + F.when(e % 13 == 0, 1).otherwise(0)).alias("native_duration_frames"), e.alias("start_pts"), (e + 1).alias("end_pts_exclusive"),
        (e * 2).alias("start_time_ms"), (e * 2 + e % 700).alias("end_time_ms"), (e % 700).alias("duration_ms"), (e % 300).alias("fade_in_ms"), (e % 400).alias("fade_out_ms"), (e % 5).alias("frames_per_event"),
    )
    return contracts.event_violations(own)


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry made of the customers, some of them under the name of another."""
    k = F.col("c_custkey")
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    return read(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("s"), F.when(k % 9 == 0, k - 1).otherwise(k)).alias("source_id"), F.when(k % 4 == 0, F.lit(None)).when(k % 3 == 0, "unknown").otherwise("authorized").alias("license_status"),
        (k % 5 != 0).alias("allowed_to_download"), F.when(k % 7 != 0, k % 6 != 0).alias("allowed_for_derivative_work"), (k % 8 != 0).alias("allowed_for_ml_training"),
        F.when(k % 10 != 0, day(k % 300)).alias("authorization_start_at"), F.when(k % 11 != 0, day(k % 300 + k % 90 - 5)).alias("authorization_expire_at"),
    )


_SOURCES = """(select c_custkey as k, 's' || case when c_custkey % 9 = 0 then c_custkey - 1 else c_custkey end as source_id, case when c_custkey % 4 = 0 then null when c_custkey % 3 = 0 then 'unknown' else 'authorized' end as license,
c_custkey % 5 <> 0 as download, case when c_custkey % 7 <> 0 then c_custkey % 6 <> 0 end as derive, c_custkey % 8 <> 0 as train,
case when c_custkey % 10 <> 0 then date '2024-01-01' + cast(c_custkey % 300 as int) end as a, case when c_custkey % 11 <> 0 then date '2024-01-01' + cast(c_custkey % 300 + c_custkey % 90 - 5 as int) end as z from customer)"""
GATE = {
    "license is not authorised": "coalesce(license, '') <> 'authorized'",
    "download is not allowed": "not download",
    "derivative work is not allowed": "not coalesce(derive, false)",
    "training is not allowed": "not train",
    "authorisation has not begun": "a > date '2024-06-01'",
    "authorisation has expired": "z < date '2024-06-01'",
}


@query(f"select k as c_custkey, array_to_string(list_filter([{', '.join(f'case when {r} then {quoted(n)} end' for n, r in GATE.items())}], lambda x: x is not null), '; ') as reasons, not ({' or '.join(f'coalesce({r}, false)' for r in GATE.values())}) as authorized from {_SOURCES}")
def authorization_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = registry.authorised(sources(spark, sf_dir), F.lit("2024-06-01").cast("date"))
    return found.select("c_custkey", F.array_join("reasons", "; ").alias("reasons"), "authorized")


@query(f"""with s as {_SOURCES} select source_id, 'source_id is repeated' as rule from (select source_id, row_number() over (partition by source_id order by k) as n from s) where n > 1
union all select source_id, 'training needs an authorised license' from s where train and coalesce(license, '') <> 'authorized' union all select source_id, 'the window ends before it begins' from s where z < a""")
def registry_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.registry_violations(sources(spark, sf_dir), "c_custkey")



@query("select 'parse' as stage, 'event=' || event_id as input_ref, 'ValueError' as error_type, 'k is ' || coalesce(props->>'$.k', 'missing') as message, false as retryable from events where coalesce(try_cast(props->>'$.k' as int), 0) < 50")
def failures_deadletter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without a sufficient number, as failure records of the sink's schema."""
    from lathework.sources.writers import failures

    k = F.get_json_object("props", "$.k")
    bad = read(spark, sf_dir, "events").where(F.coalesce(k.try_cast("int"), F.lit(0)) < 50)
    return failures(bad, "parse", F.concat(F.lit("event="), "event_id"), "ValueError", F.concat(F.lit("k is "), F.coalesce(k, F.lit("missing"))), retryable=False)


@query("""select 'ev' || event_id as event_id, event_type as text_raw, lower(event_type) as text_normalized, 'v1' as normalization_version, event_id * 2 as start_time_ms, event_id * 2 + 500 as end_time_ms, 500::bigint as duration_ms, event_id as start_pts,
event_id + 9 as end_pts_exclusive, user_id as start_native_frame, user_id + 15 as end_native_frame_exclusive, 15::bigint as native_duration_frames, 1::bigint as frames_per_event, 0::bigint as fade_in_ms, event_id % 100 as fade_out_ms,
'f' || event_id % 3 as fonts, round(value / 1000, 6) as style_font_size_h_ratio, case when event_id % 2 = 0 then 'left' end as style_align, 'xx' as language from events""")
def flatten_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested events to the flat table of 19 columns."""
    e, u = F.col("event_id"), F.col("user_id")
    n = lambda x: F.lit(x).cast("long")
    style = F.struct(F.array(F.concat(F.lit("f"), e % 3)).alias("font_ids"), F.round(F.col("value") / 1000, 6).alias("font_size_h_ratio"), F.when(e % 2 == 0, "left").alias("align"), F.lit("xx").alias("language"))
    nested_events = read(spark, sf_dir, "events").select(
        F.concat(F.lit("ev"), e).alias("event_id"), F.col("event_type").alias("text_raw"), F.lower("event_type").alias("text_normalized"), F.lit("v1").alias("normalization_version"), (e * 2).alias("start_time_ms"), (e * 2 + 500).alias("end_time_ms"),
        n(500).alias("duration_ms"), e.alias("start_pts"), (e + 9).alias("end_pts_exclusive"), u.alias("start_native_frame"), (u + 15).alias("end_native_frame_exclusive"), n(15).alias("native_duration_frames"), n(1).alias("frames_per_event"),
        n(0).alias("fade_in_ms"), (e % 100).alias("fade_out_ms"), style.alias("style"),
    )
    flat = export.flat_events(nested_events)
    return flat.withColumn("style_font_ids", F.array_join("style_font_ids", ",")).withColumnRenamed("style_font_ids", "fonts")


@query("""select event_id as sample_index, coalesce((props->>'$.k')::int, -1) as k, case when event_id % 3 = 0 then 0.0::double else event_id / 8.0::double end as center_x, case when event_id % 3 = 0 then 0 else 7 end as transform_crop_x,
0 as transform_crop_h, case when event_id % 4 = 0 then '' else 'train' end as split, event_id % 5 = 0 as style_background_bar, 'v' || user_id as source_video_sha256, 25::bigint as source_avg_num, '' as missing, 65 as n_columns from events""")
def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested samples to the flat table of 65 columns: missing points, splits and maps get their defaults."""
    e, none = F.col("event_id"), F.lit(None)
    text_ = lambda names: [none.cast("string").alias(n) for n in names.split()]
    long = lambda names: [F.lit(25).cast("long").alias(n) for n in names.split()]
    style = F.struct(*text_("font_ids font_size_h_ratio letter_spacing_px line_spacing_px stroke_width_h_ratio opacity align fill_color stroke_color shadow_color shadow_offset_xy shadow_blur_px language direction rotation_degrees"), F.when(e % 5 == 0, "bar").alias("background_bar"))
    rate = F.struct(*long("avg_num avg_den r_num r_den"), F.lit(False).alias("is_vfr"))
    source = F.struct(*text_("platform creator_hash"), F.concat(F.lit("v"), "user_id").alias("video_sha256"), *long("native_frame_index pts timestamp_ms"), F.struct(*long("num den")).alias("time_base"), rate.alias("frame_rate"))
    plain = "sample_seed duration_ms text text_normalized normalization_version language script font_id font_sha256 fallback_used config_sha256 pairing_ok text_policy_ok effective_opacity polygon line_bboxes_xyxy effect_bbox_xyxy event_frame_index"
    nested_rows = read(spark, sf_dir, "events").select(
        e.alias("sample_index"), F.coalesce(F.from_json("props", "k int")["k"], F.lit(-1)).alias("k"), *(F.array().cast("array<int>").alias(n) if n == "effect_bbox_xyxy" else none.cast("string").alias(n) for n in plain.split()),
        none.cast("map<string,array<string>>").alias("missing_chars"), F.when(e % 3 != 0, F.array(e / 8.0)).alias("center"), F.when(e % 4 != 0, "train").alias("split"), style.alias("style"), source.alias("source"),
        F.struct(F.when(e % 3 != 0, F.array(F.lit(7))).alias("crop_xywh"), F.array(F.lit(1280), F.lit(720)).alias("target_size")).alias("transform"), F.struct(*text_("dataset_version config_sha256 renderer_version ffmpeg_version"), F.lit(1).alias("seed")).alias("build"),
    )
    flat = export.flat_samples(nested_rows)
    columns = len(flat.columns)
    kept = flat.select("sample_index", "center_x", "transform_crop_x", "transform_crop_h", "split", "style_background_bar", "source_video_sha256", "source_avg_num", F.array_join(F.map_keys("missing_chars"), ",").alias("missing"), F.lit(columns).alias("n_columns"))
    return kept.join(nested_rows.select("sample_index", "k"), "sample_index")


# --- ledgers and unions -------------------------------------------------------------------------------------------


@query("select doc_id, lang from documents where doc_id not in (select doc_id from labels)")
def ledger_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.not_in(read(spark, sf_dir, "documents").select("doc_id", "lang"), read(spark, sf_dir, "labels"), ["doc_id"])


@query("select doc_id, lang as state from documents where doc_id not in (select doc_id from labels) union all select doc_id, 'q' || quality from labels")
def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = read(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("state"))
    fresh = read(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("q"), "quality").alias("state"))
    return R.upsert(ledger, fresh, ["doc_id"])


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest manifests: an order is a video, its line items are the frames."""
    frame = F.struct(F.concat_ws("/", F.lit("frames"), "l_linenumber").alias("uri"), F.sha2(F.col("l_partkey").cast("string"), 256).alias("image_sha256"))
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(frame).alias("frames")).select(F.sha2(F.col("l_orderkey").cast("string"), 256).alias("video_sha256"), "frames")


@query("select 'video:' || v as id, v as sha256, v as group_id from (select distinct sha256(l_orderkey::varchar) as v from lineitem) union all select 'frame:' || sha256(l_orderkey::varchar) || ':frames/' || l_linenumber, sha256(l_partkey::varchar), sha256(l_orderkey::varchar) from lineitem")
def item_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.dedup_items(manifests(spark, sf_dir))


# --- splits -------------------------------------------------------------------------------------------------------

BUCKET = "('0x'||substr(sha256(cast(doc_id as varchar)),1,8))::bigint"
EDGES = [int(0.8 * 2**32), int(0.9 * 2**32)]
SPLIT_SQL = f"case when {BUCKET} < {EDGES[0]} then 'train' when {BUCKET} < {EDGES[1]} then 'val' else 'test' end"


def with_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return docs.withColumn("split", R.hash_split(ids.bucket32(F.col("doc_id").cast("string")), RATIOS))


@query(f"select doc_id, {SPLIT_SQL} as split from documents")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_split(spark, sf_dir).select("doc_id", "split")


SHARES_SQL = f"""with d as (select {SPLIT_SQL} as split, lang, source from documents), t as (select split, count(*) as total from d group by split),
n as (select split, 'lang' as dimension, lang as value, count(*) as n from d group by all union all select split, 'source', source, count(*) from d group by all)
select split, dimension, value, n, total, round(n / total, 9) as share from n join t using (split)"""


@query(SHARES_SQL)
def group_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.group_shares(with_split(spark, sf_dir), "split", ["lang", "source"]).withColumn("share", F.round("share", 9))


@query(f"select split, dimension, value, share from ({SHARES_SQL}) where share > 0.06")
def group_limit_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_shares(spark, sf_dir).where("share > 0.06").select("split", "dimension", "value", "share")


@query(f"select s.split, count(*) as n, sum(l.quality) as good from (select doc_id, {SPLIT_SQL} as split from documents) s join labels l using (doc_id) group by s.split")
def split_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels")
    return with_split(spark, sf_dir).join(labels, "doc_id").groupBy("split").agg(F.count("*").alias("n"), F.sum("quality").alias("good"))


@query()
def greedy_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.sha2("text", 256).alias("sha"))
    first = F.min_by(F.struct("lang", "source"), "doc_id")
    clusters = docs.groupBy("sha").agg(F.count("*").alias("n_items"), first.alias("f"))
    rows = clusters.select(F.concat(F.lit("exact-"), F.substring("sha", 1, 16)).alias("cluster_id"), "n_items", F.col("f.lang").alias("platform"), F.col("f.source").alias("creator"), F.lit(None).cast("string").alias("video"))
    return S.greedy_split(rows, S.SplitConfig(RATIOS, 42, {"platform": 0.9, "creator": 0.3}))


# --- distributions ------------------------------------------------------------------------------------------------

BUCKET_ROWS = ", ".join(f"({a}, {b}, {w})" for a, b, w in BUCKETS)


@query(f"""with b(lo, hi, weight) as (values {BUCKET_ROWS}), v as (select cast(floor(value * 100) as bigint) as ms from events),
n as (select lo, hi, count(*) as n from b join v on ms between lo and hi group by all)
select b.lo, b.hi, coalesce(n, 0) as n, round(coalesce(n, 0) / (select count(*) from v), 9) as actual, round(weight / (select sum(weight) from b), 9) as target from b left join n using (lo, hi)""")
def duration_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = read(spark, sf_dir, "events").select(F.floor(F.col("value") * 100).alias("ms"))
    buckets = spark.createDataFrame(BUCKETS, "lo int, hi int, weight double")
    return R.bucket_histogram(values, "ms", buckets).select("lo", "hi", "n", F.round("actual", 9).alias("actual"), F.round("target", 9).alias("target"))


@query("""select count(*) as n_samples, count(distinct source) as unique_configs, count(*) filter (n_chars > 500) as pairing_ok, min(n_chars)::double as font_size_min, max(n_chars)::double as font_size_max, round(avg(n_chars), 6) as font_size_mean,
min(doc_id)::double as x_min, max(doc_id)::double as x_max, round(avg(doc_id), 6) as x_mean, 0.0::double as y_min, 0.0::double as y_max, 0.0::double as y_mean from documents""")
def sample_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").select(F.col("source").alias("config_sha256"), (F.col("n_chars") > 500).alias("pairing_ok"), F.col("n_chars").alias("font_size"), F.col("doc_id").alias("x"), F.lit(None).cast("double").alias("y"))
    return reports.samples(rows).select(*(F.round(c, 6).alias(c) if c.endswith("_mean") else F.col(c) for c in reports.samples(rows).columns))


@query("""with f as (select p_brand as video, p_partkey as position, p_size as w, p_partkey % 2 + 1 as h, p_retailprice as pts from part), m as (select *, w || 'x' || h as size, (w // gcd(w, h)) || ':' || (h // gcd(w, h)) as aspect, lag(pts) over (partition by video order by position) as prior from f)
select video, count(*) as n_frames, count(distinct size) as unique_images, max(position) - min(position) as span_ms, bool_and(coalesce(pts >= prior, true)) as monotone from m group by video""")
def frame_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = F.col("p_size").cast("long"), (F.col("p_partkey") % 2 + 1).cast("long")
    rows = read(spark, sf_dir, "part").select(F.col("p_brand").alias("video"), F.col("p_partkey").alias("position"), w.alias("target_width"), h.alias("target_height"), F.col("p_retailprice").alias("pts"), F.col("p_partkey").alias("timestamp_ms"), F.concat_ws("x", w, h).alias("image_sha256"))
    return reports.frames(rows, "video").drop("size", "aspect")


@query("select p_size || 'x' || (p_partkey % 64 + 1) as size, (p_size // gcd(p_size, p_partkey % 64 + 1)) || ':' || ((p_partkey % 64 + 1) // gcd(p_size, p_partkey % 64 + 1)) as aspect, count(*) as n from part group by 1, 2")
def frame_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = F.col("p_size").cast("long"), F.col("p_partkey") % 64 + 1
    return read(spark, sf_dir, "part").groupBy(T.size_label(w, h).alias("size"), T.aspect_label(w, h).alias("aspect")).agg(F.count("*").alias("n"))


@query("select l_returnflag, l_linestatus, sum(l_quantity) as quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(*) as n from lineitem where l_shipdate <= timestamp '1998-09-02' group by all")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    revenue = F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2)
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("quantity"), revenue.alias("revenue"), F.count("*").alias("n"))


# --- ordered sequences --------------------------------------------------------------------------------------------


@query("select user_id, bool_and(coalesce(value >= p, true)) as monotone from (select user_id, value, lag(value) over (partition by user_id order by ts, event_id) as p from events) group by user_id")
def pts_monotonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.non_decreasing(read(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "value")


@query("""with p as (select distinct user_id, cast(floor(epoch(ts) / 3600) as bigint) as h from events), m as (select *, case when h - lag(h) over (partition by user_id order by h) - 1 > 6 then 1 else 0 end as new from p),
r as (select *, sum(new) over (partition by user_id order by h) as run from m) select user_id, min(h) as start, max(h) + 1 as "end" from r group by user_id, run having max(h) + 1 - min(h) >= 3""")
def islands_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = read(spark, sf_dir, "events").select("user_id", F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 3600).alias("h"))
    return R.islands(hours, "user_id", "h", 6, 3)


@query("select user_id, event_id, epoch_us(ts) // 1000 as start_ms, epoch_us(n) // 1000 - epoch_us(ts) // 1000 as duration_ms from (select *, lead(ts) over (partition by user_id order by ts) as n from events where event_type = 'click') where epoch_us(n) // 1000 > epoch_us(ts) // 1000")
def scene_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    cuts = read(spark, sf_dir, "events").where("event_type = 'click'").select("user_id", "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("start_ms"))
    return R.intervals(cuts, "user_id", "start_ms").select("user_id", "event_id", "start_ms", (F.col("next") - F.col("start_ms")).alias("duration_ms"))


@query("""with o as (select o_orderkey, o_custkey as k, (o_orderkey * 7919) % 2592000 as t from orders), e as (select user_id as k, event_id, cast(floor(epoch(ts)) as bigint) - 1704067200 as t from events)
select o_orderkey, (select event_id from e where e.k = o.k and e.t >= o.t order by e.t, event_id limit 1) as event_id from o""")
def asof_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), (F.col("o_orderkey") * 7919 % 2592000).alias("t"))
    right = read(spark, sf_dir, "events").select(F.col("user_id").alias("k"), "event_id", (F.unix_timestamp(F.col("ts").cast("timestamp")) - 1704067200).alias("t"))
    return R.asof_forward(left, right, "k", "t", "event_id").select("o_orderkey", "event_id")


@query("""with o as (select o_orderkey, o_custkey as k, (o_orderkey * 7919) % 2592000 as t from orders), e as (select user_id as k, event_id, cast(floor(epoch(ts)) as bigint) - 1704067200 as t from events)
select o_orderkey, (select event_id from e where e.k = o.k order by abs(e.t - o.t), e.t, event_id limit 1) as event_id from o""")
def asof_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), (F.col("o_orderkey") * 7919 % 2592000).alias("t"))
    right = read(spark, sf_dir, "events").select(F.col("user_id").alias("k"), "event_id", (F.unix_timestamp(F.col("ts").cast("timestamp")) - 1704067200).alias("t"))
    return R.asof_nearest(left, right, "k", "t", "event_id").select("o_orderkey", "event_id")


@query("select c_custkey, unnest(case when n <= 5 then range(n) else list_distinct(list_transform(range(5), lambda i: cast(round_even(i * (n - 1) / 4.0, 0) as bigint))) end) as pick from (select c_custkey, c_custkey % 23 as n from customer)")
def even_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select("c_custkey", F.explode(T.even_picks(F.col("c_custkey") % 23, 5)).alias("pick"))


@query("select l_orderkey, l_linenumber, l_orderkey * 10 + cast(round_even(l_linenumber * l_partkey / 6.0, 0) as bigint) as t7, l_orderkey * 10 + l_partkey // 2 as t1 from lineitem")
def representative_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, d = F.col("l_orderkey") * 10, F.col("l_partkey")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", T.representative_time(start, d, 7, F.col("l_linenumber")).alias("t7"), T.representative_time(start, d, 1, F.lit(0)).alias("t1"))


@query("with f as (select c_custkey, row_number() over (order by c_custkey) - 1 as pos from customer) select o_orderkey, c_custkey from orders join f on o_orderkey % (select count(*) from f) = pos")
def round_robin_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = read(spark, sf_dir, "customer")
    n = frames.count()
    pos = R.numbered(frames.select("c_custkey"), "c_custkey", "pos")
    return R.round_robin(read(spark, sf_dir, "orders").select("o_orderkey"), F.col("o_orderkey"), pos, "pos", n)


@query("select l_orderkey, l_linenumber, cast(round_even(l_orderkey * 1000 / 3000.0::double, 0) as bigint) as ms, cast(round_even(l_partkey * 15360 / 1000.0::double, 0) as bigint) as pts from lineitem")
def ticks_ms_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.lit(1)
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", T.ticks_to_ms(F.col("l_orderkey"), one, F.lit(3000)).alias("ms"), T.ms_to_pts(F.col("l_partkey"), one, F.lit(15360)).alias("pts"))


@query("""select event_id, round(case when i > 0 and t < i then greatest(0, t / i) when o > 0 and t > 1000 - o then greatest(0, (1000 - t) / o) else 1 end, 9) as factor
from (select event_id, event_id % 1100 as t, event_id % 7 * 50 as i, event_id % 5 * 60 as o from events)""")
def fade_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return read(spark, sf_dir, "events").select("event_id", F.round(T.fade_factor(e % 1100, F.lit(0), F.lit(1000), e % 7 * 50, e % 5 * 60), 9).alias("factor"))


@query("""select event_id, greatest(0, event_id * 3 - d // 2) as start_time_ms, greatest(0, event_id * 3 - d // 2) + d as end_time_ms, cast(round_even(greatest(0, event_id * 3 - d // 2) * 15360 / 1000.0::double, 0) as bigint) as start_pts,
greatest(cast(round_even(d / 1000.0::double * r, 0) as bigint), 1) as duration_frames, greatest(0, event_id - greatest(cast(round_even(d / 1000.0::double * r, 0) as bigint), 1) // 2) as start_frame
from (select event_id, event_id % 4000 + 300 as d, case when event_id % 3 = 0 then 30.0::double else 24.0::double end as r from events)""")
def event_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    own = T.event_timing(e % 4000 + 300, e * 3, e, F.when(e % 3 == 0, 0.0).otherwise(24.0), F.lit(1), F.lit(15360))
    return read(spark, sf_dir, "events").select("event_id", own.alias("t")).select("event_id", *(f"t.{c}" for c in ("start_time_ms", "end_time_ms", "start_pts", "duration_frames", "start_frame")))


@query("with r as (select user_id, event_id, epoch_us(ts) // 1000 as now, row_number() over (partition by user_id order by ts, event_id) as i from events) select event_id, max(now - i * 60000) over (partition by user_id order by i) + i * 60000 as slot from r")
def rate_limit_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("user_id", "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("now"))
    return R.rate_slots(rows, "user_id", ["now", "event_id"], "now", 60000).select("event_id", "slot")


# --- boxes --------------------------------------------------------------------------------------------------------

BOX = "(select vec_id, round(least(abs(embedding[1]) * 3, 0.9)::double, 6) as x0, round(least(abs(embedding[2]) * 4, 0.9)::double, 6) as y0, round(least(abs(embedding[3]), 0.3)::double, 6) as w, round(least(abs(embedding[4]), 0.3)::double, 6) as h from embeddings)"
BOXES = f"(select vec_id, x0, y0, x0 + w as x1, y0 + h as y1 from {BOX})"
CORNER_SQL = "(((x0 + x1) / 2 <= 0.25 or (x0 + x1) / 2 >= 0.75) and ((y0 + y1) / 2 <= 0.25 or (y0 + y1) / 2 >= 0.75) and (x1 - x0) * (y1 - y0) <= 0.06)"
ROLE_SQL = f"case when (y0 + y1) / 2 >= 0.55 then 'subtitle' when {CORNER_SQL} then 'watermark' else 'scene_text' end"


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda i, k, most: F.round(F.least(F.abs(F.get("embedding", i)) * F.lit(k).cast("float"), F.lit(most).cast("double")).cast("double"), 6)
    rows = read(spark, sf_dir, "embeddings").select("vec_id", at(0, 3, 0.9).alias("x0"), at(1, 4, 0.9).alias("y0"), at(2, 1, 0.3).alias("w"), at(3, 1, 0.3).alias("h"))
    return rows.select("vec_id", "x0", "y0", (F.col("x0") + F.col("w")).alias("x1"), (F.col("y0") + F.col("h")).alias("y1"))


def sides(prefix: str = "") -> G.Box:
    return tuple(F.col(prefix + c) for c in ("x0", "y0", "x1", "y1"))


@query(f"select vec_id, {ROLE_SQL} as role from {BOXES}")
def box_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes(spark, sf_dir).select("vec_id", G.geometric_role(sides()).alias("role"))


@query(f"select vec_id, ({ROLE_SQL} in ('subtitle', 'watermark') and greatest(x0, 0.34) < least(x1, 0.66) and greatest(y0, 0.61) < least(y1, 0.91)) as rejected from {BOXES}")
def text_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = G.widened(tuple(F.lit(x) for x in (0.35, 0.62, 0.65, 0.9)), 0.01)
    bad = G.geometric_role(sides()).isin("subtitle", "watermark") & G.intersects(sides(), target)
    return boxes(spark, sf_dir).select("vec_id", bad.alias("rejected"))


@query(f"""with b as (select *, vec_id // 50 as frame from {BOXES}), p as (select a.vec_id as a, b.vec_id as b, greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) as i,
(a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) as s from b a join b on a.frame = b.frame and a.vec_id < b.vec_id) select a, b, round(i / (s - i), 6) as iou from p where i > 0 and i / (s - i) >= 0.2""")
def box_iou_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = boxes(spark, sf_dir).withColumn("frame", F.floor(F.col("vec_id") / 50))
    names = ("vec_id", "x0", "y0", "x1", "y1")
    left, right = (own.select("frame", *(F.col(c).alias(side + c) for c in names)) for side in ("a_", "b_"))
    value = G.iou(sides("a_"), sides("b_"))
    pairs = left.join(right, "frame").where(F.col("a_vec_id") < F.col("b_vec_id")).withColumn("iou", value).where("iou >= 0.2 and iou > 0")
    return pairs.select(F.col("a_vec_id").alias("a"), F.col("b_vec_id").alias("b"), F.round("iou", 6).alias("iou"))


@query("""select p_partkey, x0, y0, x0 + w as x1, y0 + h as y1 from (select p_partkey, w, h, (a - w) // 2 as x0, (b - h) // 2 as y0 from
(select p_partkey, a, b, case when a * 9 > 16 * b then cast(round_even(b * 16 / 9.0::double, 0) as bigint) else a end as w, case when a * 9 > 16 * b then b else cast(round_even(a * 9 / 16.0::double, 0) as bigint) end as h
from (select p_partkey, p_partkey % 500 + 320 as a, p_size * 10 + 200 as b from part)))""")
def crop_rects(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = G.center_crop(F.col("p_partkey") % 500 + 320, (F.col("p_size") * 10 + 200).cast("long"), F.lit(16), F.lit(9))
    return read(spark, sf_dir, "part").select("p_partkey", own.alias("c")).select("p_partkey", "c.x0", "c.y0", "c.x1", "c.y1")


@query("with n as (select user_id, event_type, count(*) as n, min(event_id) as f from events group by all) select user_id, event_type from (select *, row_number() over (partition by user_id order by n desc, f) as r from n) where r = 1")
def majority_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.majority(read(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id")


_TRACKS = "(select vec_id, vec_id % 7 as video, vec_id % 40 as track, vec_id // 70 as frame, x0, y0, x1, y1 from {})"


def some_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("vec_id")
    return boxes(spark, sf_dir).select("vec_id", (v % 7).alias("video"), (v % 40).alias("track"), F.floor(v / 70).alias("frame"), "x0", "y0", "x1", "y1")


@query(f"""select video, track, round(count(distinct frame) / 8, 9) as persistence, round((stddev_pop((x0 + x1) / 2) + stddev_pop((y0 + y1) / 2)) / 2, 4) as position_std, round(avg(x0), 4) as x0, round(avg(y1), 4) as y1
from {_TRACKS.format(BOXES)} group by video, track having count(distinct frame) / 8 >= 0.25 and (stddev_pop((x0 + x1) / 2) + stddev_pop((y0 + y1) / 2)) / 2 <= 0.15""")
def track_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = S.persistent(some_tracks(spark, sf_dir), 8, 0.25, 0.15)
    return found.select("video", "track", F.round("persistence", 9).alias("persistence"), *(F.round(c, 4).alias(c) for c in ("position_std", "x0", "y1")))


MASK = "list_transform(embedding[1:16], lambda x: case when x > 0 then 1 else 0 end)"


@query(f"""with m as (select vec_id % 7 as video, vec_id % 40 as track, vec_id as frame, {MASK} as mask from embeddings), p as (select *, lead(mask) over (partition by video, track order by frame) as n from m),
q as (select video, track, list_sum(list_transform(range(1, 17), lambda i: mask[i] * n[i])) as common, list_sum(list_transform(range(1, 17), lambda i: greatest(mask[i], n[i]))) as joint, n is not null as paired from p)
select video, track, bool_or(paired and joint > 0 and common / joint < 0.2) as switched from q group by video, track""")
def content_switches(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("vec_id")
    mask = F.transform(F.slice("embedding", 1, 16), lambda x: F.when(x > 0, 1).otherwise(0))
    own = read(spark, sf_dir, "embeddings").select((v % 7).alias("video"), (v % 40).alias("track"), v.alias("frame"), mask.alias("mask"))
    return S.content_switches(own, 0.2)


@query(f"""with b as (select vec_id % 97 as video, {ROLE_SQL} as role from {BOXES} where vec_id % 97 < 90), v as (select distinct vec_id % 97 as video from embeddings)
select v.video, count(*) filter (role = 'subtitle') as subtitle_boxes, count(*) filter (role = 'watermark') as watermark_boxes, count(*) filter (role = 'scene_text') as scene_text_boxes, count(*) filter (role = 'subtitle') > 0 as subtitle_present from v left join b on v.video = b.video group by v.video""")
def video_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a video has subtitles of its own; the videos whose boxes are none of steady ones have no verdict against them."""
    own = boxes(spark, sf_dir).select((F.col("vec_id") % 97).alias("video"), G.geometric_role(sides()).alias("role"))
    return S.video_verdicts(own.where("video < 90"), own)


@query("select user_id as id, event_id, event_type as state, first from (select *, row_number() over (partition by user_id order by event_id desc) as n, min(event_id) over (partition by user_id) as first from events) where n = 1")
def last_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "event_id", F.col("event_type").alias("state"))
    return S.last_by_id(own, "id", "event_id")


@query()
def box_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = boxes(spark, sf_dir).withColumn("video", (F.col("vec_id") % 7).cast("string")).withColumn("frame", F.floor(F.col("vec_id") / 70)).withColumnRenamed("vec_id", "box")
    return S.tracks(own, 0.3).select("video", "frame", "box", "track")


# --- sampling and windows -----------------------------------------------------------------------------------------


@query("""with u as (select event_id, ('0x'||substr(sha256('7:' || event_id),1,8))::bigint / 4294967296.0::double as u from events) select event_id, case when u * 10 <= 2 then 'short' when u * 10 <= 7 then 'middle' else 'long' end as choice from u""")
def weighted_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = sampling.hash_uniform(F.lit("7"), F.col("event_id").cast("string"))
    return read(spark, sf_dir, "events").select("event_id", R.weighted_choice(u, [("short", 2.0), ("middle", 5.0), ("long", 3.0)]).alias("choice"))


@query()
def seeded_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.draw_samples_from(read(spark, sf_dir, "benchmark"), "text", ["item_id"], 5000, 42)


@query()
def random_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    videos = read(spark, sf_dir, "part").select(F.col("p_brand").alias("video"), F.col("p_partkey").alias("frame"), (F.col("p_partkey") % 500 + 320).alias("width"), (F.col("p_size") * 10 + 200).cast("long").alias("height"))
    return sampling.crops(videos, [(16, 9, 2.0), (1, 1, 1.0)], 42)


@query("select time_bucket(interval 1 hour, ts) as start, event_type, count(*) as n, round(sum(value), 6) as total from events group by 1, 2")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.windowed(read(spark, sf_dir, "events")).withColumn("total", F.round("total", 6))


@query("""with m as (select user_id, ts, case when ts >= lag(ts) over (partition by user_id order by ts) + interval 30 minutes then 1 else 0 end as new from events),
r as (select *, sum(new) over (partition by user_id order by ts) as run from m) select user_id, min(ts) as start, count(*) as n from r group by user_id, run""")
def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.sessions(read(spark, sf_dir, "events"))
