"""Operators of a training-data pipeline: formatting, filters, deduplication,
sharding, mixing, token output and packing. Nothing else in the package
imports this subpackage."""
