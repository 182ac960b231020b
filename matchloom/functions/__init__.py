"""Column functions: normalization, string similarity, lists."""
