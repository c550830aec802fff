"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

All stages read whole texts of any length. A null text counts as empty and stays null unless a stage says otherwise; a
null id is a document like any other, but is linked with none. Empty tables give empty ones, and columns other than
those of documents are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.llm.decontam import without_passages
from lathework.llm.neardup import near_duplicates
from lathework.llm.pieces import encode
from lathework.llm.quality import score_quality
from lathework.llm.repeats import remove_repeats
from lathework.llm.runtime import stage_table

#: Items of which a document may hold windows; with more it goes as a whole.
MOST_ITEMS = 1
#: Words in a row that are cut out where they stand at several places: over 50.
REPEATED_WORDS = 51
OTHERS = ("lang", "source")


def _documents(df: DataFrame, text: str) -> DataFrame:
    """The columns of documents, from a text that a stage has changed and what it carried."""
    return df.select("doc_id", F.col(text).alias("text"), *(F.col(f"carried.{c}").alias(c) for c in OTHERS), F.char_length(text).cast("long").alias("n_chars"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go: those with a score of 0.3 or more stay, null and empty texts by theirs."""
    scores = score_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = scores.where("predicted = 0").select(F.col("doc_id").alias("d"), F.col("th").alias("t")).distinct()
    return docs.join(out, F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("text") == F.col("t")), "left_anti")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id; without words or id all stay."""
    out = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(out, "doc_id", "left_anti").select(docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of REPEATED_WORDS words or of 400 bytes that stand at several places are cut out; a document keeps its row even if nothing is left."""
    return _documents(remove_repeats(docs, carry=OTHERS, words=REPEATED_WORDS), "kept_text")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with windows of several items go; from the others the hit words are cut out, and null texts stay null."""
    found = without_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=OTHERS)
    return _documents(found.where(F.col("n_items") <= MOST_ITEMS), "text")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, little-endian int32; a text of several chunks has a row for each, a null or empty one a row without ids."""
    return encode(docs).select("doc_id", "chunk", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("decontamination", decontamination), ("tokens", tokens)]

#: Neither the classifier nor the components nor the search for pieces can be said in SQL; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
