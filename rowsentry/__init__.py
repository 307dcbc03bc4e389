"""Spark operators for training data, scoring and monitoring of a tabular classifier.

Every public operator is a plain function from DataFrames to a DataFrame.
"""
