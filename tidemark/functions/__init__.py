"""Scalar column functions: time conversion and formatting, bitmap offsets, report text."""
