"""DataFrame -> DataFrame operators: split, ranking, metrics, text, blend,
models and profiles."""
