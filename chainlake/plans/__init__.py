"""Silver and Gold plans, quality checks, orchestration."""
