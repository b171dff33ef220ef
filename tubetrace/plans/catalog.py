"""All registered queries (importing the modules registers them)."""

from . import ingest_queries, relation_queries, stream_queries, window_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
