"""flowruns: runs of non-zero flow per device, their summaries, and their repair over batches,
as PySpark DataFrame jobs."""

from flowruns.operators.runs import island_bounds, island_ids, neighbours, nonzero_readings, zero_flag
from flowruns.operators.summary import summarize_runs

__all__ = ["island_bounds", "island_ids", "neighbours", "nonzero_readings", "summarize_runs", "zero_flag"]
