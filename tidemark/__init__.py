"""Data-quality jobs for periodic, multi-tenant record extracts, written for Spark.

Read quoted text extracts, append them to a versioned history, look at any table as of any
extract, check every declared foreign key, compare validation runs and count across tenants.
"""

from tidemark.registry import ForeignKey, Registry, Table, Via

__all__ = ["ForeignKey", "Registry", "Table", "Via"]
