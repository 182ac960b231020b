"""Matchloom: multi-source record matching and training-data operators on Spark."""
