"""All queries of this package."""

from lakeloom.llm import (
    queries_codes, queries_dedup, queries_mixing, queries_native, queries_neighbours, queries_quality, queries_repair,
    queries_tokens, queries_vectors,
)
from lakeloom.llm.registry import LLM_REGISTRY

__all__ = ["LLM_REGISTRY", "queries_codes", "queries_dedup", "queries_mixing", "queries_native", "queries_neighbours",
           "queries_quality", "queries_repair", "queries_tokens", "queries_vectors"]
