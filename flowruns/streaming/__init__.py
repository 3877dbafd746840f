"""Incremental maintenance of the run table from a stream of new reading files."""
