"""Queries and SQL of the training-data operators, by the tables of a test folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lathework.llm.decontam import contamination
from lathework.llm.langid import identify_language
from lathework.llm.neardup import near_duplicates
from lathework.llm.nearest import nearest
from lathework.llm.ngrams import score_language_model
from lathework.llm.pieces import piece_digests
from lathework.llm.quality import score_quality
from lathework.llm.repeats import remove_repeats
from lathework.llm.sharding import shard_documents
from lathework.llm.wrappers import extract_text


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(read(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).withColumnRenamed("kept_text", "text").drop("carried")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(read(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents")).drop("group_key")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_language_model(read(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), percent=85)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_extraction": op1_html_extraction,
        "op2_sentencepiece": op2_sentencepiece,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_language_id": op4_language_id,
        "op5_sharding": op5_sharding,
        "op6_lm_scoring": op6_lm_scoring,
        "op7_decontamination": op7_decontamination,
        "op8_quality": op8_quality,
        "op9_nearest": op9_nearest,
        "op10_minhash": op10_minhash,
    }


#: A-Z in lower case, and nothing else.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
with d as (select doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select cast(item_id as varchar) as item, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
s as (select item, w, least(len(w), 8) as n, unnest(range(greatest(len(w) - 7, 1))) as i from b where len(w) > 0),
windows as (select distinct item, n, array_to_string(w[i + 1 : i + n], ' ') as k from s),
sizes as (select distinct n from windows),
p as (select doc_id, w, n, unnest(range(len(w) - n + 1)) as i from d, sizes where len(w) >= n),
hits as (select doc_id, item, i, p.n from p join windows on p.n = windows.n and k = array_to_string(w[i + 1 : i + p.n], ' ')),
places as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from hits) group by doc_id),
names as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_items, 0) >= 2 as contaminated
from d left join places using (doc_id) left join names using (doc_id)"""

NEAR = rf"""
with recursive d as (select doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
g as (select doc_id, w, unnest(range(greatest(len(w) - 4, 1))) as i from d where len(w) > 0),
s as (select distinct doc_id, hash(w[i + 1 : i + 5]) as x, w[i + 1 : i + 5] as k from g),
n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as common from s a join s b on a.x = b.x and a.k = b.k and a.doc_id <> b.doc_id group by all),
links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * common >= 85 * (x.n + y.n - common)),
reach as (select doc_id as a, doc_id as b from d union select r.a, l.b from reach r join links l on l.a = r.b)
select d.doc_id, coalesce(n.n, 0) as n_shingles, r.c as component_id, d.doc_id = r.c as kept from d left join n using (doc_id) join (select a, min(b) as c from reach group by a) r on r.a = d.doc_id"""

#: Sums run from the first component on, as in the operator, so that scores are equal to the last bit.
NEAREST = """
with v as (select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
one as (select vec_id, min(e) as e from v group by vec_id),
n as (select vec_id, e, sqrt(list_reduce(list_transform(e, lambda x: x * x), lambda a, b: a + b)) as l from one where len(list_filter(e, lambda x: x <> 0)) > 0),
p as (select q.vec_id as query_id, c.vec_id, list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]), lambda a, b: a + b) / (q.l * c.l) as score
from n q join n c on len(q.e) = len(c.e) and q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from p)
select query_id, rank, vec_id, score from r where rank <= 5"""

#: Strings as two hex digits a byte; a removed run may cut a character, whose rest is no text.
REPEATS = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, row_number() over () as n from documents),
s as (select n, unnest(range(len(h) // 2 - 399)) as i from d where len(h) >= 800),
w as (select n, i, hash(substr(h, 2 * i + 1, 800)) as x, md5(substr(h, 2 * i + 1, 800)) as y from s join d using (n)),
again as (select n, i from (select n, i, count(*) over (partition by x, y) as c from w) where c > 1),
edge as (select n, i, coalesce(i > lag(i + 400) over (partition by n order by i), true) as fresh from again),
named as (select n, i, sum(fresh::int) over (partition by n order by i) as run from edge),
gone as (select n, run, min(i) as a, max(i) + 400 as z from named group by all),
parts as (select n, run as k, coalesce(lag(z) over (partition by n order by a), 0) as a, a as z from gone union all select n, 1000000000, max(z), 1000000000 from gone group by n),
kept as (select n, string_agg(substr(h, 2 * a + 1, 2 * (z - a)), '' order by k) as rest from parts join d using (n) group by n),
sums as (select n, sum(z - a) as removed, count(*) as spans from gone group by n),
o as (select doc_id, len(h) // 2 as n_bytes, coalesce(removed, 0) as n_removed, coalesce(spans, 0) as n_spans, coalesce(rest, h) as rest from d left join sums using (n) left join kept using (n))
select doc_id, n_bytes, cast(n_removed as bigint) as n_removed, n_spans, sha256(unhex(rest)) as kept_sha256, decode(unhex(array_to_string(list_filter(regexp_extract_all(rest,
'[0-7].|(?:C[2-9A-F]|D.)[89AB].|E0[AB].[89AB].|E[1-9ABCEF][89AB].[89AB].|ED[89].[89AB].|F0[9AB].[89AB].[89AB].|F[1-3][89AB].[89AB].[89AB].|F48.[89AB].[89AB].|..'), lambda x: len(x) > 2 or x < '80'), ''))) as text from o"""


def oracle_sql() -> dict[str, str]:
    return {"op3_suffix_dedup": REPEATS, "op7_decontamination": DECONTAMINATION, "op9_nearest": NEAREST, "op10_minhash": NEAR}
