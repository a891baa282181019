"""Registry of the library's own queries and their DuckDB twins."""

from __future__ import annotations

from tallyseq.plans import base, q_cohort, q_compare, q_conflict, q_intervals, q_misc, q_readers, q_rules, q_scores, q_search, q_sources, q_truth  # noqa: F401  importing registers
from tallyseq.plans import q_annotations  # noqa: F401  after the queries whose twins it reads

QUERIES, ORACLES, COVERS = base.QUERIES, base.ORACLES, base.COVERS
