"""DataFrame operators (joins, groups, quantiles, impute, encode, stats,
folds, models, metrics, ensembles)."""
