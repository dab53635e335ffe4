"""Catalog asset statistics on Spark.

Turns the change log of a lakehouse catalog (``table_info``, ``partition_info``,
``data_commit_info``) into four keyed result tables: table, namespace, domain and
creator level assets. Every step is a DataFrame function, so the same code runs as a
batch job over a whole change log and inside a Structured Streaming ``foreachBatch``.
"""

from assetlens.plans.batch import AssetResults, compute_assets

__all__ = ["AssetResults", "compute_assets"]
