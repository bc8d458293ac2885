"""ragloom: retrieval-corpus jobs (chunk, embed, search, pack, prompt) as Spark DataFrame plans."""

from ragloom.params import ChunkParams, PackParams, SearchParams, CONFIGURED_PACK, GRAPH_PACK  # noqa: F401
from ragloom.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = [
    "ChunkParams",
    "PackParams",
    "SearchParams",
    "CONFIGURED_PACK",
    "GRAPH_PACK",
    "get_spark",
    "checkpoint_dir",
]
