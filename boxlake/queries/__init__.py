"""The core's queries and their SQL equivalents, gathered from the modules of this package."""

from __future__ import annotations

from boxlake.queries import boxes, merging, more, nested, sourcing, training

_MODULES = (nested, boxes, merging, sourcing, training, more)

QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in _MODULES for k, v in getattr(m, "ORACLES", {}).items()}
FLAGSHIP = "a1_import_stats"
