"""DuckDB SQL for each registered query: an independent statement of the same result.

The runs are written the textbook way (a running count of idle readings over the whole
device, no chunks), so they check the chunked Spark plan rather than repeat it.
Floating columns are rounded the same way on both sides (see ``catalog.present``).
"""

from __future__ import annotations

from flowruns import schema as S
from flowruns.plans.catalog import CAP_DAYS, TIE_NUDGE
from flowruns.sources.fixtures import BACKFILL_FROM, BACKFILL_TO, CUT, LATE_EVERY, SEAM_SECONDS, SEAM_WINDOWS

CUT_TS = f"TIMESTAMP '{CUT}'"

READINGS = """readings AS (
  SELECT 'd' || CAST(user_id AS VARCHAR) AS DEVICE_ID,
         ts AS "TIMESTAMP",
         CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_type = 'error' THEN 0.0::DOUBLE ELSE value END AS FLOW_RATE,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE round(value * 2, 2) END AS PRESSURE,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS TEMPERATURE,
         CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'signup' THEN 5 ELSE 1 END AS MODE,
         CAST(event_id % 2 AS INTEGER) AS VALVE_STATE
  FROM events)"""

IDLE = "CASE WHEN FLOW_RATE = 0.0 THEN 1 ELSE 0 END"
KEPT = "(FLOW_RATE IS NULL OR FLOW_RATE <> 0.0)"


def sd(c: str) -> str:
    return (f"CASE WHEN count({c}) = 1 THEN 0.0 WHEN isnan(stddev_samp({c})) THEN 0.0 "
            f"ELSE stddev_samp({c}) END")


def epoch_s(c: str) -> str:
    return f"(epoch_us({c}) // 1000000)"


SUMMARY_COLS = f"""DEVICE_ID,
    min("TIMESTAMP") AS START_TIMESTAMP,
    max("TIMESTAMP") AS END_TIMESTAMP,
    CAST(count(*) AS BIGINT) AS RECORDS,
    max(FLOW_RATE) AS MAX_FLOW_RATE,
    avg(FLOW_RATE) AS AVG_FLOW_RATE,
    sum(FLOW_RATE) AS SUM_FLOW_RATE,
    min(TEMPERATURE) AS MIN_TEMPERATURE,
    max(TEMPERATURE) AS MAX_TEMPERATURE,
    avg(TEMPERATURE) AS AVG_TEMPERATURE,
    min(PRESSURE) AS MIN_PRESSURE,
    max(PRESSURE) AS MAX_PRESSURE,
    avg(PRESSURE) AS AVG_PRESSURE,
    {sd('PRESSURE')} AS SD_PRESSURE,
    {sd('FLOW_RATE')} AS SD_FLOW_RATE,
    CAST(count(CASE WHEN MODE = 2 THEN 1 END) AS BIGINT) AS SYSTEM_MODE_2,
    CAST(count(CASE WHEN MODE = 3 THEN 1 END) AS BIGINT) AS SYSTEM_MODE_3,
    CAST(count(CASE WHEN MODE = 5 THEN 1 END) AS BIGINT) AS SYSTEM_MODE_5,
    {epoch_s('max("TIMESTAMP")')} - {epoch_s('min("TIMESTAMP")')} AS DURATION"""


def ids_cte(name: str, source: str = "readings", where: str = "TRUE", batch: str = "NULL") -> str:
    """Readings with the running idle count per device (and batch), whole device at once."""
    return f"""{name} AS (
  SELECT *, sum({IDLE}) OVER (PARTITION BY DEVICE_ID, _B ORDER BY "TIMESTAMP"
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS RUN_ID
  FROM (SELECT *, {batch} AS _B FROM {source}
        WHERE DEVICE_ID IS NOT NULL AND "TIMESTAMP" IS NOT NULL AND ({where})))"""


def runs_cte(name: str, source: str = "readings", where: str = "TRUE", batch: str = "NULL") -> str:
    return (ids_cte(f"{name}_ids", source, where, batch) + f""",
{name} AS (
  SELECT {SUMMARY_COLS}
  FROM {name}_ids WHERE {KEPT}
  GROUP BY DEVICE_ID, _B, RUN_ID)""")


def rnd(expr: str, digits: int) -> str:
    scale = f"1e{digits}"
    return f"(floor(({expr}) * {scale} + {0.5 + TIE_NUDGE!r}) / {scale})"


def present(cols: list[str], prefix: str = "") -> str:
    out = []
    for c in cols:
        ref = f'{prefix}"{c}"'
        if c.startswith("SUM_"):
            out.append(f'{rnd(ref, 4)} AS "{c}"')
        elif c.startswith(("AVG_", "SD_")) or c == "DAY_DIFF":
            out.append(f'{rnd(ref, 6)} AS "{c}"')
        else:
            out.append(f'{ref} AS "{c}"')
    return ", ".join(out)


RUNS = S.RUN_COLUMNS
WHOLE = runs_cte("whole")
CUT_RUNS = runs_cte("cut", batch=f'("TIMESTAMP" >= {CUT_TS})')
DAILY = runs_cte("daily", batch='CAST("TIMESTAMP" AS DATE)')
BEFORE = runs_cte("before_runs", where=f'"TIMESTAMP" < {CUT_TS}')
AFTER = runs_cte("after_runs", where=f'"TIMESTAMP" >= {CUT_TS}')
CROSSING = f"""crossing AS (
  SELECT * FROM whole WHERE START_TIMESTAMP < {CUT_TS} AND END_TIMESTAMP >= {CUT_TS})"""
CUT_PLUS = f"""{WHOLE},
{CUT_RUNS},
{CROSSING},
cut_plus AS (SELECT * FROM cut UNION ALL SELECT * FROM crossing)"""

# J2 in the reference's form: two grouped aggregates joined on the device.
EXT = f"""ext AS (
  SELECT a.DEVICE_ID, b.START_TIMESTAMP, a.END_TIMESTAMP
  FROM (SELECT DEVICE_ID, min(END_TIMESTAMP) AS END_TIMESTAMP FROM cut
        WHERE START_TIMESTAMP >= {CUT_TS} GROUP BY DEVICE_ID) a
  JOIN (SELECT DEVICE_ID, max(START_TIMESTAMP) AS START_TIMESTAMP FROM cut
        WHERE END_TIMESTAMP < {CUT_TS} GROUP BY DEVICE_ID) b
    ON a.DEVICE_ID = b.DEVICE_ID)"""

SEAM_S = f"(SELECT min(START_TIMESTAMP) FROM daily WHERE START_TIMESTAMP >= {CUT_TS})"


def seam_cte(runs: str, s: str, name: str = "seam") -> str:
    w = SEAM_SECONDS
    return f"""{name} AS (
  SELECT * FROM {runs}
  WHERE (START_TIMESTAMP >= {s} AND START_TIMESTAMP < date_trunc('second', {s}) + INTERVAL {w} SECOND)
     OR (END_TIMESTAMP >= date_trunc('second', {s}) - INTERVAL {w} SECOND AND END_TIMESTAMP < {s}))"""


def seam_windows_cte(runs: str) -> str:
    start, start1, end, end1 = (f"TIMESTAMP '{t}'" for t in SEAM_WINDOWS)
    return f"""seam AS (
  SELECT * FROM {runs} WHERE (START_TIMESTAMP >= {start} AND START_TIMESTAMP < {start1})
     OR (END_TIMESTAMP >= {end} AND END_TIMESTAMP < {end1}))"""


DEV_EXT = """dev_ext AS (
  SELECT DEVICE_ID, min(START_TIMESTAMP) AS START_TIMESTAMP, max(END_TIMESTAMP) AS END_TIMESTAMP
  FROM seam GROUP BY DEVICE_ID)"""

R = ["DEVICE_ID", "TIMESTAMP", "FLOW_RATE", "PRESSURE", "TEMPERATURE", "MODE", "VALVE_STATE"]


def _w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _sel(cols: list[str]) -> str:
    return ", ".join(f'"{c}"' for c in cols)


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["island_summary"] = _w(READINGS, WHOLE) + f"SELECT {present(RUNS)} FROM whole"
    q["island_sql_view"] = q["island_summary"]
    q["neighbour_flow"] = _w(READINGS) + """SELECT DEVICE_ID, "TIMESTAMP", FLOW_RATE,
  lag(FLOW_RATE) OVER (PARTITION BY DEVICE_ID ORDER BY "TIMESTAMP") AS PREV_FLOW_RATE,
  lead(FLOW_RATE) OVER (PARTITION BY DEVICE_ID ORDER BY "TIMESTAMP") AS NEXT_FLOW_RATE
FROM readings WHERE DEVICE_ID IS NOT NULL AND "TIMESTAMP" IS NOT NULL"""
    q["neighbour_time"] = _w(READINGS) + f"""SELECT DEVICE_ID, "TIMESTAMP",
  lag("TIMESTAMP") OVER (PARTITION BY DEVICE_ID ORDER BY "TIMESTAMP") AS PREV_TIMESTAMP,
  lead("TIMESTAMP") OVER (PARTITION BY DEVICE_ID ORDER BY "TIMESTAMP") AS NEXT_TIMESTAMP
FROM readings WHERE DEVICE_ID IS NOT NULL AND "TIMESTAMP" IS NOT NULL AND {KEPT}"""
    q["zero_flag"] = _w(READINGS) + f'SELECT DEVICE_ID, "TIMESTAMP", FLOW_RATE, {IDLE} AS IS_SKIPPED FROM readings'
    q["nonzero_readings"] = _w(READINGS) + f"SELECT {_sel(R)} FROM readings WHERE {KEPT}"
    q["prune_readings"] = _w(READINGS) + f"SELECT {_sel(R[:-1])} FROM readings"
    q["ordered_readings"] = q["prune_readings"] + ' ORDER BY DEVICE_ID, "TIMESTAMP"'
    q["island_ids"] = _w(READINGS, ids_cte("ids")) + f'SELECT DEVICE_ID, "TIMESTAMP", FLOW_RATE, RUN_ID FROM ids WHERE {KEPT}'
    q["island_bounds"] = _w(READINGS, ids_cte("ids")) + f"""SELECT DEVICE_ID, "TIMESTAMP",
  min("TIMESTAMP") OVER (PARTITION BY DEVICE_ID, RUN_ID) AS START_TIMESTAMP,
  max("TIMESTAMP") OVER (PARTITION BY DEVICE_ID, RUN_ID) AS END_TIMESTAMP
FROM ids WHERE {KEPT}"""
    keys = ["DEVICE_ID", "START_TIMESTAMP", "END_TIMESTAMP"]
    for name, cols in {
        "flow_stats": ["MAX_FLOW_RATE", "AVG_FLOW_RATE", "SUM_FLOW_RATE"],
        "temperature_stats": ["MIN_TEMPERATURE", "MAX_TEMPERATURE", "AVG_TEMPERATURE"],
        "pressure_stats": ["MIN_PRESSURE", "MAX_PRESSURE", "AVG_PRESSURE"],
        "spread_single_reading": ["RECORDS", "SD_PRESSURE", "SD_FLOW_RATE"],
        "mode_counts": ["SYSTEM_MODE_2", "SYSTEM_MODE_3", "SYSTEM_MODE_5"],
        "run_duration": ["DURATION"],
    }.items():
        q[name] = _w(READINGS, WHOLE) + f"SELECT {present(keys + cols)} FROM whole"
    q["ordered_runs"] = q["island_summary"] + " ORDER BY DEVICE_ID, START_TIMESTAMP"

    # Scans
    q["scan_half_open"] = _w(READINGS) + (f"SELECT {_sel(R)} FROM readings WHERE \"TIMESTAMP\" >= TIMESTAMP '{BACKFILL_FROM}'"
                                          f" AND \"TIMESTAMP\" < TIMESTAMP '{BACKFILL_TO}'")
    q["scan_after_checkpoint"] = _w(READINGS, BEFORE) + (
        f'SELECT {_sel(R)} FROM readings WHERE "TIMESTAMP" > (SELECT max(END_TIMESTAMP) FROM before_runs)')
    q["scan_closed_devices"] = _w(READINGS, CUT_RUNS, EXT) + f"""SELECT {_sel(R)} FROM readings
WHERE "TIMESTAMP" >= (SELECT min(START_TIMESTAMP) FROM ext) AND "TIMESTAMP" <= (SELECT max(END_TIMESTAMP) FROM ext)
  AND DEVICE_ID IN (SELECT DEVICE_ID FROM ext)"""
    q["scan_seam"] = _w(READINGS, DAILY, seam_cte("daily", SEAM_S)) + f"SELECT {present(RUNS)} FROM seam"
    w = SEAM_SECONDS
    q["seam_bounds"] = _w(READINGS, DAILY) + f"""SELECT s AS "S", date_trunc('second', s) + INTERVAL {w} SECOND AS "S1",
  date_trunc('second', s) - INTERVAL {w} SECOND AS "E", s AS "E1"
FROM (SELECT {SEAM_S} AS s)"""

    # Extents
    seam = [READINGS, DAILY, seam_cte("daily", SEAM_S), DEV_EXT]
    q["device_extents"] = _w(*seam) + "SELECT DEVICE_ID, START_TIMESTAMP, END_TIMESTAMP FROM dev_ext"
    q["global_extent"] = _w(*seam) + ("SELECT min(START_TIMESTAMP) AS START_TIMESTAMP, max(END_TIMESTAMP) AS END_TIMESTAMP"
                                      " FROM dev_ext")
    q["seam_devices"] = _w(*seam) + "SELECT DISTINCT DEVICE_ID FROM dev_ext"
    q["batch_extent"] = _w(READINGS, AFTER) + ("SELECT min(START_TIMESTAMP) AS START_TIMESTAMP, max(END_TIMESTAMP) AS END_TIMESTAMP"
                                               " FROM after_runs")
    q["first_run_after"] = _w(READINGS, CUT_RUNS) + (f"SELECT DEVICE_ID, min(END_TIMESTAMP) AS END_TIMESTAMP FROM cut"
                                                     f" WHERE START_TIMESTAMP >= {CUT_TS} GROUP BY DEVICE_ID")
    q["last_run_before"] = _w(READINGS, CUT_RUNS) + (f"SELECT DEVICE_ID, max(START_TIMESTAMP) AS START_TIMESTAMP FROM cut"
                                                     f" WHERE END_TIMESTAMP < {CUT_TS} GROUP BY DEVICE_ID")
    q["consolidate_extents"] = _w(READINGS, CUT_RUNS, EXT) + "SELECT DEVICE_ID, START_TIMESTAMP, END_TIMESTAMP FROM ext"
    q["capped_extent"] = _w(READINGS, CUT_RUNS, EXT) + f"""SELECT
  CASE WHEN d > 2.0 THEN CAST(CAST(mn - INTERVAL 1 SECOND AS DATE) AS TIMESTAMP) ELSE mn END AS FROM_TS,
  CASE WHEN d > 2.0 THEN CAST(CAST(mn - INTERVAL 1 SECOND AS DATE) AS TIMESTAMP) + INTERVAL 2 DAY ELSE mx END AS TO_TS,
  {rnd('d', 6)} AS DAY_DIFF, d > 2.0 AS CAPPED
FROM (SELECT mn, mx, CAST({epoch_s('mx')} - {epoch_s('mn')} AS DOUBLE) / 86400.0 AS d
      FROM (SELECT min(START_TIMESTAMP) AS mn, max(END_TIMESTAMP) AS mx FROM ext))"""
    q["checkpoint_lookup"] = _w(READINGS, BEFORE) + """SELECT coalesce(
  (SELECT max(t) FROM (SELECT CAST(NULL AS TIMESTAMP) AS t) WHERE FALSE),
  (SELECT max(END_TIMESTAMP) FROM before_runs)) AS "TIMESTAMP\""""
    q["checkpoint_after_batch"] = _w(READINGS, BEFORE, AFTER) + """SELECT max(END_TIMESTAMP) AS "TIMESTAMP" FROM before_runs
UNION ALL SELECT max(END_TIMESTAMP) AS "TIMESTAMP" FROM after_runs"""

    # Repair
    closed = f"""closed AS (
  SELECT * FROM readings
  WHERE "TIMESTAMP" >= (SELECT min(START_TIMESTAMP) FROM ext) AND "TIMESTAMP" <= (SELECT max(END_TIMESTAMP) FROM ext)
    AND DEVICE_ID IN (SELECT DEVICE_ID FROM ext))"""
    joined = """joined AS (
  SELECT r.*, x.START_TIMESTAMP AS ACT_START_TIMESTAMP, x.END_TIMESTAMP AS ACT_END_TIMESTAMP
  FROM recomputed r JOIN ext x ON r.DEVICE_ID = x.DEVICE_ID)"""
    rep = [READINGS, CUT_RUNS, EXT, closed, runs_cte("recomputed", source="closed"), joined]
    q["extent_join"] = _w(*rep) + ("SELECT " + present(["DEVICE_ID", "START_TIMESTAMP", "END_TIMESTAMP", "RECORDS",
                                                        "ACT_START_TIMESTAMP", "ACT_END_TIMESTAMP"]) + " FROM joined")
    q["extent_exact"] = _w(*rep) + (f"SELECT {present(RUNS)} FROM joined WHERE "
                                    f"{epoch_s('ACT_START_TIMESTAMP')} = {epoch_s('START_TIMESTAMP')} AND "
                                    f"{epoch_s('ACT_END_TIMESTAMP')} = {epoch_s('END_TIMESTAMP')}")
    q["bridge_islands"] = _w(READINGS, WHOLE, CROSSING) + f"SELECT {present(RUNS)} FROM crossing"
    q["range_delete"] = _w(READINGS, CUT_RUNS, EXT) + f"""SELECT {present(RUNS)} FROM cut c
WHERE NOT EXISTS (SELECT 1 FROM ext x WHERE x.DEVICE_ID = c.DEVICE_ID AND c.START_TIMESTAMP >= x.START_TIMESTAMP
                  AND c.END_TIMESTAMP < date_trunc('second', x.END_TIMESTAMP) + INTERVAL 1 SECOND)"""
    q["duplicate_starts"] = _w(READINGS, CUT_PLUS) + """SELECT DEVICE_ID, START_TIMESTAMP, count(*) AS N,
  min(END_TIMESTAMP) AS END_TIMESTAMP FROM cut_plus GROUP BY DEVICE_ID, START_TIMESTAMP HAVING count(*) > 1"""
    q["duplicate_ends"] = _w(READINGS, CUT_PLUS) + """SELECT DEVICE_ID, END_TIMESTAMP, count(*) AS N,
  max(START_TIMESTAMP) AS START_TIMESTAMP FROM cut_plus GROUP BY DEVICE_ID, END_TIMESTAMP HAVING count(*) > 1"""
    q["dedupe_same_start"] = _w(READINGS, CUT_PLUS) + f"""SELECT {present(RUNS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY DEVICE_ID, START_TIMESTAMP ORDER BY END_TIMESTAMP DESC, RECORDS DESC) AS rn
  FROM cut_plus) WHERE rn = 1"""
    q["dedupe_same_end"] = _w(READINGS, CUT_PLUS) + f"""SELECT {present(RUNS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY DEVICE_ID, END_TIMESTAMP ORDER BY START_TIMESTAMP ASC, RECORDS DESC) AS rn
  FROM cut_plus) WHERE rn = 1"""
    q["append_by_name"] = _w(READINGS, BEFORE, AFTER) + (f"SELECT {present(RUNS)} FROM "
                                                         "(SELECT * FROM before_runs UNION ALL SELECT * FROM after_runs)")

    # Jobs
    q["job_backfill"] = _w(READINGS, runs_cte("bf", where=f"\"TIMESTAMP\" >= TIMESTAMP '{BACKFILL_FROM}' AND "
                                                          f"\"TIMESTAMP\" < TIMESTAMP '{BACKFILL_TO}'")) + \
        f"SELECT {present(RUNS)} FROM bf"
    q["job_consolidate"] = q["island_summary"]
    q["job_incremental"] = q["island_summary"]
    q["job_consolidate_daily"] = q["island_summary"]
    q["incremental_equals_full"] = q["island_summary"]
    q["incremental_late_rows"] = q["island_summary"]
    q["incremental_state"] = q["island_summary"]
    q["job_publish_recovery"] = q["island_summary"]
    q["job_consolidate_heal"] = q["island_summary"]
    q["job_concurrent_publish"] = q["island_summary"]
    q["merge_fragments"] = q["island_summary"]
    q["extent_bucket_join"] = _w(READINGS, CUT_RUNS, EXT) + f"""SELECT {_sel(R).replace('"DEVICE_ID"', 'r."DEVICE_ID"')}
FROM readings r JOIN ext x ON r.DEVICE_ID = x.DEVICE_ID AND "TIMESTAMP" BETWEEN x.START_TIMESTAMP AND x.END_TIMESTAMP"""
    q["checkpoint_observed"] = _w(READINGS, AFTER) + 'SELECT max(END_TIMESTAMP) AS "TIMESTAMP" FROM after_runs'
    q["job_range_delete"] = q["range_delete"]
    q["zone_map_scan"] = _w(READINGS, CUT_RUNS, seam_windows_cte("cut")) + f"SELECT {present(RUNS)} FROM seam"
    # Late readings: the runs of a device are disjoint, so their ENDs are in the order of their STARTs.
    is_late = f"""({epoch_s('"TIMESTAMP"')} % {LATE_EVERY} = 0)"""
    q["late_intervals"] = _w(READINGS, runs_cte("on_time", where=f"NOT {is_late}"), f"""spans AS (
  SELECT DEVICE_ID, min("TIMESTAMP") AS lo, max("TIMESTAMP") AS hi, bool_or({KEPT}) AS flows
  FROM readings WHERE DEVICE_ID IS NOT NULL AND "TIMESTAMP" IS NOT NULL AND {is_late}
  GROUP BY DEVICE_ID, date_trunc('hour', "TIMESTAMP"))""", """around AS (
  SELECT s.*, (SELECT max(START_TIMESTAMP) FROM on_time r WHERE r.DEVICE_ID = s.DEVICE_ID AND r.START_TIMESTAMP <= s.lo) AS p_start,
    (SELECT max(END_TIMESTAMP) FROM on_time r WHERE r.DEVICE_ID = s.DEVICE_ID AND r.START_TIMESTAMP <= s.lo) AS p_end,
    (SELECT max(END_TIMESTAMP) FROM on_time r WHERE r.DEVICE_ID = s.DEVICE_ID AND r.START_TIMESTAMP <= s.hi) AS q_end,
    (SELECT min(END_TIMESTAMP) FROM on_time r WHERE r.DEVICE_ID = s.DEVICE_ID AND r.START_TIMESTAMP > s.hi) AS n_end
  FROM spans s)""", """wide AS (
  SELECT DEVICE_ID, CASE WHEN flows AND p_end IS NULL AND q_end IS NULL AND n_end IS NULL THEN min(lo) OVER (PARTITION BY DEVICE_ID)
      WHEN p_start IS NOT NULL AND (flows OR p_end >= lo) THEN p_start ELSE lo END AS a,
    greatest(hi, coalesce(q_end, hi), CASE WHEN flows AND n_end IS NOT NULL AND (q_end IS NULL OR q_end < hi) THEN n_end ELSE hi END,
      CASE WHEN flows AND p_end IS NULL AND q_end IS NULL AND n_end IS NULL THEN max(hi) OVER (PARTITION BY DEVICE_ID) ELSE hi END) AS b,
    flows OR q_end >= lo AS used
  FROM around QUALIFY used)""", """marked AS (
  SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY DEVICE_ID ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    THEN 0 ELSE 1 END AS fresh FROM wide)""", """numbered AS (
  SELECT *, sum(fresh) OVER (PARTITION BY DEVICE_ID ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS k FROM marked)""") + \
        "SELECT DEVICE_ID, min(a) AS START_TIMESTAMP, max(b) AS END_TIMESTAMP FROM numbered GROUP BY DEVICE_ID, k"
    q["append_by_name_sink"] = q["append_by_name"]
    q["checkpoint_sink"] = q["checkpoint_after_batch"]
    q["scan_seam_windows"] = _w(READINGS, DAILY, seam_windows_cte("daily")) + f"SELECT {present(RUNS)} FROM seam"
    q["source_filtered"] = f"""SELECT event_id, ts, user_id, event_type FROM events
WHERE event_type <> 'error' AND ts >= {CUT_TS}"""
    near = f"ext WHERE CAST({epoch_s('END_TIMESTAMP')} - {epoch_s('START_TIMESTAMP')} AS DOUBLE) / 86400.0 <= {CAP_DAYS}"
    q["job_consolidate_capped"] = _w(READINGS, WHOLE, CUT_RUNS, CROSSING, EXT, f"""joined AS (
  SELECT * FROM crossing WHERE DEVICE_ID IN (SELECT DEVICE_ID FROM {near}))""") + f"""SELECT {present(RUNS)} FROM (
  SELECT c.* FROM cut c WHERE NOT EXISTS (SELECT 1 FROM joined j WHERE j.DEVICE_ID = c.DEVICE_ID
      AND c.START_TIMESTAMP >= j.START_TIMESTAMP AND c.END_TIMESTAMP <= j.END_TIMESTAMP)
  UNION ALL SELECT * FROM joined)"""
    seam_s = f"(SELECT min(START_TIMESTAMP) FROM cut WHERE START_TIMESTAMP >= {CUT_TS})"
    in_ext = """in_ext AS (
  SELECT r.* FROM readings r JOIN dev_ext x ON r.DEVICE_ID = x.DEVICE_ID
   AND r."TIMESTAMP" >= x.START_TIMESTAMP AND r."TIMESTAMP" <= x.END_TIMESTAMP)"""
    stored = """stored AS (
  SELECT c.* FROM cut c WHERE EXISTS (SELECT 1 FROM dev_ext x WHERE x.DEVICE_ID = c.DEVICE_ID
    AND c.START_TIMESTAMP <= x.END_TIMESTAMP AND c.END_TIMESTAMP >= x.START_TIMESTAMP))"""
    bridges = """bridges AS (
  SELECT r.* FROM recomputed r
  WHERE EXISTS (SELECT 1 FROM stored s WHERE s.DEVICE_ID = r.DEVICE_ID AND s.START_TIMESTAMP = r.START_TIMESTAMP)
    AND EXISTS (SELECT 1 FROM stored s WHERE s.DEVICE_ID = r.DEVICE_ID AND s.END_TIMESTAMP = r.END_TIMESTAMP)
    AND NOT EXISTS (SELECT 1 FROM stored s WHERE s.DEVICE_ID = r.DEVICE_ID AND s.START_TIMESTAMP = r.START_TIMESTAMP
                    AND s.END_TIMESTAMP = r.END_TIMESTAMP))"""
    for name, seam_part in (("job_repair_seam", seam_cte("cut", seam_s)), ("job_repair_seam_windows", seam_windows_cte("cut"))):
        q[name] = _w(READINGS, CUT_RUNS, seam_part, DEV_EXT, in_ext,
                     runs_cte("recomputed", source="in_ext"), stored, bridges) + f"""SELECT {present(RUNS)} FROM (
  SELECT * FROM cut c WHERE NOT EXISTS (SELECT 1 FROM bridges b WHERE b.DEVICE_ID = c.DEVICE_ID
      AND c.START_TIMESTAMP >= b.START_TIMESTAMP AND c.END_TIMESTAMP <= b.END_TIMESTAMP)
  UNION ALL SELECT * FROM bridges)"""
    return q
