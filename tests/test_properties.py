"""Property: for any readings and any chunk width, the runs equal the plain statement."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from brute import runs as brute_runs
from flowruns import schema as S
from flowruns.operators.summary import summarize_runs

T0 = dt.datetime(2024, 1, 1)

flows = st.one_of(st.just(0.0), st.just(-0.0), st.none(), st.just(float("nan")),
                  st.floats(min_value=0.1, max_value=50, allow_nan=False))
reading = st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 20_000), flows,
                    st.one_of(st.none(), st.floats(0, 9, allow_nan=False)), st.integers(0, 40),
                    st.sampled_from([1, 2, 3, 5]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(reading, min_size=0, max_size=60, unique_by=lambda r: (r[0], r[1])),
       chunk=st.sampled_from([7, 300, 3600, "auto"]))
def test_runs_match_plain_statement(spark, rows, chunk):
    recs = [{"DEVICE_ID": d, "TIMESTAMP": T0 + dt.timedelta(seconds=s), "FLOW_RATE": f, "PRESSURE": p,
             "TEMPERATURE": t, "MODE": m, "VALVE_STATE": 0} for d, s, f, p, t, m in rows]
    df = spark.createDataFrame([tuple(r[f.name] for f in S.READINGS_SCHEMA.fields) for r in recs], S.READINGS_SCHEMA)
    got = sorted((r[S.DEVICE_ID], r[S.START], r[S.END], r[S.RECORDS], r["SYSTEM_MODE_2"], r[S.DURATION])
                 for r in summarize_runs(df, chunk).collect())
    want = sorted((r["DEVICE_ID"], r["START_TIMESTAMP"], r["END_TIMESTAMP"], r["RECORDS"], r["SYSTEM_MODE_2"],
                   r["DURATION"]) for r in brute_runs(recs))
    assert got == want
