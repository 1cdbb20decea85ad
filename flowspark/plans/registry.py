"""All registered queries (catalog + streaming + learned operators)."""

from __future__ import annotations


def _load() -> None:
    from flowspark.plans import catalog, files, learned, rawstream, streams  # noqa: F401


def all_queries():
    _load()
    from flowspark.plans.catalog import QUERIES
    return dict(QUERIES)


def all_oracles():
    _load()
    from flowspark.plans.catalog import ORACLE
    return dict(ORACLE)
