"""Queries on the retail tables: staging, enrichment, marts and analyses."""
