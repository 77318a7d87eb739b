"""Mesh operators: DataFrame in, DataFrame out, keyed by model_id."""
