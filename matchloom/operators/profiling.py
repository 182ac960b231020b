"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lists import parse_ids


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row: rows, columns and the nulls of each column."""
    nulls = [F.coalesce(F.sum(F.col(c).isNull().cast("int")), F.lit(0)).cast("long").alias(f"null_{c}") for c in df.columns]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"), *nulls)


def match_histogram(ground_truth: DataFrame) -> DataFrame:
    """(n_matches, n): entities by their number of matches."""
    counted = ground_truth.select(F.size(parse_ids(F.col("matched_entity_ids"))).cast("long").alias("n_matches"))
    return counted.groupBy("n_matches").agg(F.count(F.lit(1)).alias("n"))


def source_totals(ground_truth: DataFrame) -> DataFrame:
    """One row: matches in each target source and in all."""
    ids = ground_truth.select(F.explode(parse_ids(F.col("matched_entity_ids"))).alias("id"))
    return ids.agg(F.count_if(F.col("id").startswith("S2-")).alias("s2"), F.count_if(F.col("id").startswith("S3-")).alias("s3"), F.count(F.lit(1)).alias("total"))


def many_matches(ground_truth: DataFrame, least: int = 2, n: int = 3) -> DataFrame:
    """The first ``n`` entities (by id) with ``least`` matches or more."""
    sized = ground_truth.withColumn("ids", parse_ids(F.col("matched_entity_ids"))).where(F.size("ids") >= least)
    return sized.orderBy("source1_entity_id").limit(n)


def describe_matches(some: DataFrame, s2: DataFrame, s3: DataFrame) -> DataFrame:
    """(source1_entity_id, cand_id, found_in, business_name): each match looked up in S2 first, else in S3, else unknown."""
    pairs = some.select("source1_entity_id", F.explode("ids").alias("cand_id"))
    all_targets = s2.select(F.col("entity_id").alias("cand_id"), F.col("business_name"), F.lit("S2").alias("found_in")).unionByName(
        s3.select(F.col("entity_id").alias("cand_id"), F.col("business_name"), F.lit("S3").alias("found_in"))
    )
    first = all_targets.groupBy("cand_id").agg(F.min_by("business_name", "found_in").alias("business_name"), F.min("found_in").alias("found_in"))
    return pairs.join(first, "cand_id", "left").select("source1_entity_id", "cand_id", F.coalesce("found_in", F.lit("unknown")).alias("found_in"), "business_name")
