"""Hourly monitors and label merging on streams; every transformation also runs on tables."""
