"""Batch operators, DataFrame to DataFrame: windows, sequence (hot-key-safe per-key ordering), topn,
distinct, lateness, blocking, patterns, joins."""
