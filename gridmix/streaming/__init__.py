"""Incremental refresh of the daily tables (the reference's late-data handling)."""
