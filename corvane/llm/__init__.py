"""Operators for training-data pipelines. Nothing else in corvane imports this subpackage."""
