"""All registered queries; importing the query modules fills the registry."""

from seriesml.plans import queries_lifecycle, queries_models, queries_profile, queries_scores, queries_series, queries_serving  # noqa: F401
from seriesml.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
