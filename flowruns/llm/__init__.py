"""Operators for training-data pipelines over a ``documents`` table; see each module's docstring."""
