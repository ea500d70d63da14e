"""selection_decisions on flights with and without marginal frames, against its SQL."""

from __future__ import annotations

import datetime

import duckdb

import __spark_entry__ as entry


def test_flights_without_marginal_frames(spark, tmp_path):
    # flight 0 has no event_id that 3 divides, flight 1 some
    rows = [(user, 3 * k + 1 if user == 0 else 1000 + k, 40.0 + k % 50, datetime.datetime(2024, 1, 1, 0, k)) for user in (0, 1) for k in range(55)]
    events = spark.createDataFrame(rows, "user_id long, event_id long, value double, ts timestamp")
    events.write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = con.execute(entry.oracle_sql()["selection_decisions"])
    columns = [c[0] for c in want.description]
    got = sorted(tuple(r) for r in entry.queries()["selection_decisions"](spark, str(tmp_path)).select(*columns).collect())
    assert got == sorted(want.fetchall())
    assert got[0][columns.index("n_marginal")] == 0 and got[0][columns.index("marginal_frames")] is None and got[1][columns.index("marginal_frames")]
