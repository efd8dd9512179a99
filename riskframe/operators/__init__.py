"""DataFrame -> DataFrame operators: aggregation specs, encoders, joins, profiling, association, splits, ranking, metrics, models, explainability."""
