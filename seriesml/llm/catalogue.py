"""All queries of the text operators; importing the query modules fills the registry."""

from seriesml.llm import queries_filters, queries_models, queries_search, queries_tokens  # noqa: F401
from seriesml.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
