"""Normalized records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import normalize_country, numeric_tokens, sort_tokens, with_normalized


def normalize_records(df: DataFrame) -> DataFrame:
    """Adds norm_name, sorted_name, clean_name, norm_addr, clean_addr, norm_country and addr_numbers (clean_* repeat norm_*)."""
    out = with_normalized(df, {"norm_name": "business_name"}, {"norm_addr": "business_address"}).withColumn("norm_country", normalize_country("country"))
    return out.withColumns(
        {"sorted_name": sort_tokens("norm_name"), "clean_name": F.col("norm_name"), "clean_addr": F.col("norm_addr"), "addr_numbers": numeric_tokens("norm_addr")}
    )
