"""Whole runs put together from the operators."""

from chunkloom.plans.index import (
    describe_chunks,
    index_chunks,
    merge_indexes,
    route,
    summary,
)

__all__ = ["describe_chunks", "index_chunks", "merge_indexes", "route", "summary"]
