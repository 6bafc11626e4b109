"""tidemark: layered batch and streaming table history on Spark.

Type-2 history (batch merge and per-micro-batch stream), versioned parquet
tables with snapshots, nested facts, JSON event topics and a small catalogue
of named queries — all as DataFrame / Spark SQL / Structured Streaming plans.
"""

from .session import get_session, scale_settings, scratch_path, shared_root, stage

__all__ = ["get_session", "scale_settings", "scratch_path", "shared_root", "stage"]
