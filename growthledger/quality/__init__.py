"""Data-quality checks: operators, the check lists of each table, and the gate."""
