"""Incremental layered tables (bronze, silver, gold) on plain Parquet and stock Spark."""

from tierline.plans.layers import Layers
from tierline.plans.pipeline import build, conform, ingest, ingest_all, publish
from tierline.schema import GOLD, SILVER, FeedSpec
from tierline.session import get_session
from tierline.sources.versioned import VersionedTable

__all__ = [
    "GOLD",
    "SILVER",
    "FeedSpec",
    "Layers",
    "VersionedTable",
    "build",
    "conform",
    "get_session",
    "ingest",
    "ingest_all",
    "publish",
]
