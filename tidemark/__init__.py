"""Incremental layered (bronze, silver, gold) analytics on Spark DataFrames."""

from tidemark.spec import Lake, TableSpec

__all__ = ["Lake", "TableSpec"]
