"""No streaming operators: every job here is a bounded batch. Incremental work is a join against recorded state (``merge_plan``, ``to_resume``)."""
