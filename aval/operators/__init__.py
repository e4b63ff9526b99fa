"""The operators: quality, cleaning, merge, target, aggregation, features, models, evaluation."""
