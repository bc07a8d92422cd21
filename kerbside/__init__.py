"""Batch trip analytics on Spark: a layered Parquet lake, six gold tables, served views, quality checks."""

from kerbside.settings import CleaningRules, LakeLayout, Period

__all__ = ["CleaningRules", "LakeLayout", "Period"]
