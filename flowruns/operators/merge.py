"""Run summaries that can be merged: the whole run from its fragments, without reading its readings again.

A summary row merges exactly if the numbers of non-null values behind its means are known, so ``summarize_parts``
gives them beside the row (``COUNTS``). Minima, maxima, sums and counts merge as they are, means by their counts, and
standard deviations by the pairwise rule: the squared deviations of all values from their common mean are those
inside the fragments plus, for each fragment, its count times the square of its mean's distance from the common mean.

Which fragments belong together is decided by the idle readings alone: two fragments are one run if no idle reading
lies between them. So a repair reads the device, time and flow of idle readings, and none of the flowing ones. Fragments stand in for
their readings in the ordinary run detection, so a device with very many fragments is split like any other.

The fragments must be disjoint pieces of runs (a load by batches). NULL means and spreads stay NULL; a NaN among
the values makes the mean NaN and the spread 0.0, as in the summary itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowruns import schema as S
from flowruns.functions import ntz
from flowruns.operators.runs import DEFAULT_CHUNK_SECONDS, clean, island_ids
from flowruns.operators.summary import duration, run_aggregates

#: Column of a run row's mean -> the number of values behind it.
COUNTS = {"AVG_FLOW_RATE": "N_FLOW_RATE", "AVG_TEMPERATURE": "N_TEMPERATURE", "AVG_PRESSURE": "N_PRESSURE"}
PART_COLUMNS = [*S.RUN_COLUMNS, *COUNTS.values()]


def summarize_parts(readings: DataFrame, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = (),
                    batch_cols: Sequence[str] = ()) -> DataFrame:
    """The run summary with the counts of non-null values (the same shuffle, three more columns)."""
    return numbered_parts(readings, chunk_seconds, tiebreak, batch_cols).select(*PART_COLUMNS)


def numbered_parts(readings: DataFrame, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = (),
                   batch_cols: Sequence[str] = ()) -> DataFrame:
    """``summarize_parts`` with RUN_ID: the idle readings up to the run, so 0 is a run that no idle reading of these precedes."""
    counts = [F.count(mean.removeprefix("AVG_")).alias(n) for mean, n in COUNTS.items()]
    ids = island_ids(readings, chunk_seconds, tiebreak, batch_cols)
    runs = ids.groupBy(S.DEVICE_ID, *batch_cols, S.RUN_ID).agg(*run_aggregates(), *counts)
    return runs.select(S.RUN_ID, *[c for c in S.RUN_COLUMNS if c != S.DURATION], duration(), *COUNTS.values())


def merge_rows(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` (which include the device) and PART_COLUMNS: one row from the fragments of each key.

    The common mean of a key's fragments comes from a window over them, so that the distances are taken from it
    directly and large means do not cancel; a key has at most one fragment per batch that its run crosses."""
    least, largest, total = (lambda c, f=f: f(c).alias(c) for f in (F.min, F.max, F.sum))
    w, means, spreads = Window.partitionBy(*keys), [], []
    for value in ("FLOW_RATE", "TEMPERATURE", "PRESSURE"):
        n, mean = F.col(f"N_{value}"), F.col(f"AVG_{value}")
        weighed = F.when(n > 0, mean * n)
        means.append((F.sum(weighed) / F.sum(F.when(n > 0, n))).alias(f"AVG_{value}"))
        if value != "TEMPERATURE":
            away = mean - F.sum(weighed).over(w) / F.sum(n).over(w)
            sd = F.col(f"SD_{value}")
            parts = parts.withColumn(f"_M2_{value}", F.when(n > 0, sd * sd * (n - 1) + n * away * away))
            all_n = F.sum(n)
            spreads.append(F.when(all_n == 1, F.lit(0.0)).when(all_n > 1, F.nanvl(F.sqrt(F.sum(f"_M2_{value}") / (all_n - 1)), F.lit(0.0)))
                           .alias(f"SD_{value}"))
    out = parts.groupBy(*keys).agg(
        least(S.START), largest(S.END), total(S.RECORDS), largest("MAX_FLOW_RATE"), total("SUM_FLOW_RATE"),
        least("MIN_TEMPERATURE"), largest("MAX_TEMPERATURE"), least("MIN_PRESSURE"), largest("MAX_PRESSURE"),
        *[total(f"SYSTEM_MODE_{k}") for k in (2, 3, 5)], *[total(n) for n in COUNTS.values()], *means, *spreads)
    return out.withColumn(S.DURATION, duration())


def merge_fragments(readings: DataFrame, parts: DataFrame, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """The whole runs (PART_COLUMNS) that the ``parts`` of a load by batches are fragments of.

    ``readings`` is only read for its idle readings between the first and the last fragment; the filter reaches the scan."""
    lo, hi = parts.agg(F.min(S.START), F.max(S.END)).first()
    if lo is None:
        return parts
    ts = F.col(S.TIMESTAMP)
    idle = clean(readings).where((F.col(S.FLOW_RATE) == F.lit(0.0)) & (ts >= ntz(lo)) & (ts <= ntz(hi)))
    row = F.struct(*PART_COLUMNS)
    marks = parts.select(S.DEVICE_ID, F.col(S.START).alias(S.TIMESTAMP), F.lit(1.0).alias(S.FLOW_RATE), row.alias("_PART"))
    marks = marks.unionByName(idle.select(S.DEVICE_ID, S.TIMESTAMP, S.FLOW_RATE), allowMissingColumns=True)
    # an idle reading at a fragment's START comes after it, as it does after the fragment's readings of that time
    of_runs = island_ids(marks, chunk_seconds).select(S.RUN_ID, "_PART.*")
    return merge_rows(of_runs, [S.DEVICE_ID, S.RUN_ID]).select(*PART_COLUMNS)
