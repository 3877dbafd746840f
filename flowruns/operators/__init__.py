"""DataFrame -> DataFrame operators: run detection, run summary, extents and repair."""
