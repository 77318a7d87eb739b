"""All registered queries of the mesh engine."""

from __future__ import annotations

from meshquilt.plans import queries, queries_mesh, queries_more, queries_rules  # noqa: F401  registers

QUERIES, ORACLES = queries.QUERIES, queries.ORACLES
