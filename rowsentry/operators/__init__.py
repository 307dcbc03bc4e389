"""Operators on tables: rows, splits, features, training, scoring, quality, merging, registry."""
