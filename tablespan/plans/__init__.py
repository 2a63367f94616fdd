"""Importing the package registers every query."""

from tablespan.plans import (  # noqa: F401
    change_queries, nested_queries, portal_queries, profile_queries, quality_queries, relational_queries,
    scalar_queries, stream_queries, synth_queries, tree_queries)
from tablespan.plans.registry import JOBS, SQL  # noqa: F401
