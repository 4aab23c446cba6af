"""DataFrame operators: star schema, data quality, prefix sums, model features and training."""
