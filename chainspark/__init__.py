"""Pairwise genome alignment chains on Spark: partitioning, pairing, alignment, chaining, filling, cleaning, comparison."""
