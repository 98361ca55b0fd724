"""All queries of this subpackage."""

from trendloom.llm import (
    centroids, chat, decontam, jaccard, langid, maxent, merkle, pieces, quality, records, secrets, subwords, suffixes,
)
from trendloom.llm.base import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "centroids", "chat", "decontam", "jaccard", "langid", "maxent", "merkle", "pieces", "quality",
    "records", "secrets", "subwords", "suffixes",
]
