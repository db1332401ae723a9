"""All registered queries and their oracle SQL."""

from __future__ import annotations

from sparkmine.plans import cur, graph, layouts, matrix, quantiles, similarity

_DOMAINS = [graph, matrix, quantiles, similarity, cur, layouts]


def queries():
    out = {}
    for d in _DOMAINS:
        out.update(d.QUERIES)
    return out


def oracle_sql():
    out = {}
    for d in _DOMAINS:
        out.update(d.ORACLES)
    return out
