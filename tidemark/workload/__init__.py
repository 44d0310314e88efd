"""Registered queries: every operator run over the given tables, with the equivalent plain SQL."""

from __future__ import annotations

from tidemark.workload import calendar, checks, entities, governance, marts, scalars, streams, tables
from tidemark.workload.registry import Query

ALL: dict[str, Query] = {}
for module in (marts, entities, streams, checks, tables, calendar, scalars, governance):
    clash = ALL.keys() & module.QUERIES.entries.keys()
    if clash:
        raise ValueError(f"query names used twice: {sorted(clash)}")
    ALL.update(module.QUERIES.entries)
