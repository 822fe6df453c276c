"""All registered queries."""

from lakeloom.queries import columns, layouts, mutation, policies, quality, reading, reports, streams
from lakeloom.queries.registry import REGISTRY

__all__ = ["REGISTRY", "columns", "layouts", "mutation", "policies", "quality", "reading", "reports", "streams"]
