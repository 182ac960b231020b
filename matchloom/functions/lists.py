"""Lists of ids in cells, and set measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_ids(c: Column) -> Column:
    """Comma list -> distinct trimmed non-empty ids, in order; null and blank give an empty list."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def join_ids(c: Column) -> Column:
    """Sorted, comma-joined; '' for none."""
    return F.array_join(F.array_sort(c), ",")


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def jaccard(a: Column, b: Column) -> Column:
    """Of the distinct elements: 1 when both are empty, 0 when one is."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 1.0).otherwise(overlap(a, b) / F.greatest(both, F.lit(1)))
