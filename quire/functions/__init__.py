"""Column expressions: hash buckets, typed casts, clamps, blends, text cleaning,
tokenising and stop-word removal (all built-in Spark SQL expressions)."""
