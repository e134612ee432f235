"""Column expressions: exact ratios, time, buckets, text, keys, geometry, filters."""
