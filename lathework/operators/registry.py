"""Source registry: authorisation with reasons, rules of the table itself, joins that must find every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.operators.relational import duplicates, reasons


def refusals(at: Column) -> Column:
    """Why a source may not be used on a day; both ends of its window belong to it, a missing end is open."""
    no = lambda name: ~F.coalesce(F.col(name), F.lit(False))
    return reasons({
        "license is not authorised": F.coalesce(F.col("license_status"), F.lit("")) != "authorized",
        "download is not allowed": no("allowed_to_download"),
        "derivative work is not allowed": no("allowed_for_derivative_work"),
        "training is not allowed": no("allowed_for_ml_training"),
        "authorisation has not begun": F.col("authorization_start_at") > at,
        "authorisation has expired": F.col("authorization_expire_at") < at,
    })


def authorised(sources: DataFrame, at: Column) -> DataFrame:
    return sources.withColumn("reasons", refusals(at)).withColumn("authorized", F.size("reasons") == 0)


def registry_violations(sources: DataFrame, order: str) -> DataFrame:
    """Rows of the registry that break its rules: repeated ids, training without authorisation, a window that ends first."""
    again = duplicates(sources, "source_id", order).select("source_id", F.lit("source_id is repeated").alias("rule"))
    odd = reasons({
        "training needs an authorised license": F.col("allowed_for_ml_training") & (F.coalesce(F.col("license_status"), F.lit("")) != "authorized"),
        "the window ends before it begins": F.col("authorization_expire_at") < F.col("authorization_start_at"),
    })
    return again.unionByName(sources.select("source_id", F.explode(odd).alias("rule")))


def basename(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def join_all(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join that fails while running if a left row has no partner."""
    marked = right.withColumn("_found", F.lit(True))
    joined = left.join(marked, keys, "left")
    ok = F.when(F.col("_found"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no partner for "), F.to_json(F.struct(*keys)))).cast("boolean"))
    return joined.where(ok).drop("_found")
