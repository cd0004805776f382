"""Text-table analytics on Spark: clean, label, tag, vectorise, classify, retrieve, report."""

from .session import durable, get_spark, scratch_path, spread

__all__ = ["durable", "get_spark", "scratch_path", "spread"]
