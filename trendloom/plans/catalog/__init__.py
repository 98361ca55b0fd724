"""All registered queries."""

from trendloom.plans.catalog import authors, counts, models, posts, terms, titles, vectors
from trendloom.plans.catalog.base import REGISTRY

__all__ = ["REGISTRY", "authors", "counts", "models", "posts", "terms", "titles", "vectors"]
