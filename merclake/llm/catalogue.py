"""Imports every module with a query, so that the registry is complete."""

from merclake.llm import alignment, decontam, language, licenses, lm_scoring, mixing, near_dup, passages, quality, spelling, suffix_dedup, token_counts, urls  # noqa: F401
from merclake.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
