"""Operators for training-data pipelines. Nothing else in gridmix imports this subpackage."""
