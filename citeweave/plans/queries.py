"""Queries over the driver's tables, one per operator, with SQL of the same meaning. catalogue/ has them by family."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from citeweave.plans.catalogue import documents, predicates, records, scalars, sequences
from citeweave.plans.catalogue.documents import flagship

__all__ = ["flagship", "oracle_sql", "queries"]

_ENTRIES = {name: entry for family in (documents, predicates, scalars, sequences, records) for name, entry in family.ENTRIES.items()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in _ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    """Without those that only a sequential program expresses: author and editor merges, exact DOI placement, whole pipelines."""
    return {name: sql for name, (_, sql) in _ENTRIES.items() if sql}
