"""Queries over the test tables, each with the SQL it must agree with."""

from __future__ import annotations

from opinionlake.registry import aggregates, ingest, pages, quality, text


def all_queries():
    found = {}
    for module in (text, quality, aggregates, pages, ingest):
        for query in module.QUERIES:
            if query.name in found:
                raise ValueError(f"query {query.name} is defined twice")
            found[query.name] = query
    return found
