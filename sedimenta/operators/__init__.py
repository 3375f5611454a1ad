"""Relational steps: joins, dedupe, keys, star schema, enrichment, checks, reports."""
