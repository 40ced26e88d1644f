"""Operators for training-data pipelines, each on DataFrames of documents or pages."""
