"""Composite jobs (back-fill, incremental load, seam repair, consolidation) and the
registry of named queries."""
