"""The subpackage's queries and their SQL equivalents, gathered from its modules."""

from __future__ import annotations

from boxlake.llm import q_abuse, q_groups, q_leaks, q_packing, q_pictures, q_survivors

_MODULES = (q_pictures, q_survivors, q_groups, q_leaks, q_abuse, q_packing)

QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in _MODULES for k, v in getattr(m, "ORACLES", {}).items()}
