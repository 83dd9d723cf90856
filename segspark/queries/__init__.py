"""Registered queries: name -> (Spark callable, equivalent SQL or None)."""

from __future__ import annotations


def registry() -> dict:
    from segspark.queries import clusters, statistics, survey

    out = {}
    for module in (survey, statistics, clusters):
        out.update(module.QUERIES)
    return out
