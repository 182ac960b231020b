"""Relational operators: blocking, features, scoring, training, evaluation, validation, profiling."""
