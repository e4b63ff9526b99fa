"""Compositions of operators: the training pipeline, batch scoring and the report tables."""
