"""All queries of the core by name, and their SQL."""

from __future__ import annotations

from . import coverage, findings, reports, review, screen, sequence, text, timing

_MODULES = (coverage, timing, text, reports, findings, screen, review, sequence)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
FLAGSHIP = timing.coverage_gap_regions
