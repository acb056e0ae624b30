"""Every registered query of the clinical-study operators, with its SQL."""

from __future__ import annotations

from cohortflow.plans import check_queries, file_queries, job_queries, run_queries
from cohortflow.plans.queries import QUERIES, SQL

FLAGSHIP = "global_concepts"

__all__ = ["FLAGSHIP", "QUERIES", "SQL", "check_queries", "file_queries", "job_queries", "run_queries"]
