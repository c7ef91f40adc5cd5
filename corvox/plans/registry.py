"""All registered queries of the engine's operators, and their SQL."""

from __future__ import annotations

from . import chain_queries, cleaning_queries, evaluation_queries, lexicon_queries, markup_queries, meeting_queries, metadata_queries, mixture_queries, qa_queries, rebuild_queries, selection_queries, source_queries, synthesis_queries, timeline_queries, tree_queries, turn_queries  # noqa: F401  they register themselves
from .tables import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
