"""Scores, thresholds and result rows."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MatchConfig
from .trees import score_by_trees


def fallback_score() -> Column:
    """Weighted sum that scores pairs without a model."""
    return F.round(0.60 * F.col("name_token_set") + 0.30 * F.col("addr_token_set") + 0.10 * F.col("country_match"), 9)


def dashboard_score() -> Column:
    """Weighted sum of the interactive matcher, clamped to [0.01, 0.99]."""
    raw = 0.35 * F.col("name_token_set") + 0.25 * F.col("name_lev") + 0.20 * F.col("addr_token_set") + 0.10 * F.col("has_common_num") + 0.10 * F.col("country_match") - 0.25 * F.col("name_high_addr_low")
    return F.round(F.greatest(F.lit(0.01), F.least(F.lit(0.99), raw)), 9)


def score_pairs(features: DataFrame, model: PipelineModel | DataFrame | None = None) -> DataFrame:
    """Adds ``prob``: the probability of a match by a pipeline or a table of tree nodes, or the fallback score without a model."""
    if model is None:
        return features.withColumn("prob", fallback_score())
    if isinstance(model, DataFrame):
        return score_by_trees(features, model)
    scored = model.transform(features).withColumn("prob", F.round(vector_to_array("probability")[1], 9))
    return scored.select(*features.columns, "prob")


def resolve_threshold(override: float | None, config: dict | None, has_model: bool, match: MatchConfig = MatchConfig()) -> float:
    """With a model: the override, else the config's, else the default. Without one, the fallback's own threshold, always."""
    if not has_model:
        return match.fallback_threshold
    if override is not None:
        return override
    return (config or {}).get("optimal_threshold", match.default_threshold)


def resolved_threshold(override: Column, configured: Column, has_model: Column, match: MatchConfig = MatchConfig()) -> Column:
    """The same over a table of settings."""
    return F.when(has_model, F.coalesce(override, configured, F.lit(match.default_threshold))).otherwise(F.lit(match.fallback_threshold))


def accept(scored: DataFrame, threshold: float) -> DataFrame:
    """Pairs at or above the threshold."""
    return scored.where(F.col("prob") >= threshold)


def assemble(s1: DataFrame, scored: DataFrame, threshold: float) -> DataFrame:
    """(source1_entity_id, ordinal, matched, candidates) of every S1 row: accepted ids, and all candidates in order of rank."""
    lists = scored.groupBy("s1_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("prob") >= threshold, F.col("cand_id")))).alias("matched"),
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "cand_id"))), lambda x: x["cand_id"]).alias("candidates"),
    )
    none = F.array().cast("array<string>")
    left = s1.select(F.col("entity_id").alias("s1_id"), "ordinal").join(lists, "s1_id", "left")
    return left.select(F.col("s1_id").alias("source1_entity_id"), "ordinal", F.coalesce("matched", none).alias("matched"), F.coalesce("candidates", none).alias("candidates"))
