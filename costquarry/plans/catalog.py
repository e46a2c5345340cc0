"""All registered queries of the engine: importing this module registers them."""

from __future__ import annotations

from costquarry.plans import files, functions, indexes, operators  # noqa: F401
from costquarry.plans.queries import ORACLES, QUERIES, search_similar_cases

__all__ = ["ORACLES", "QUERIES", "search_similar_cases"]
