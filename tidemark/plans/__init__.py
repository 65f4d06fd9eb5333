"""Incremental and backfill request planning over all jobs at once."""
