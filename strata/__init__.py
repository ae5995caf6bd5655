"""strata: typed, date-versioned history tables from delimited feeds, on Spark."""

from .session import ensure_checkpoint_dir, get_spark, scratch_path
from .specs import FEEDS, FeedSpec, ColumnSpec

__all__ = ["ensure_checkpoint_dir", "get_spark", "scratch_path", "FEEDS", "FeedSpec",
           "ColumnSpec"]
