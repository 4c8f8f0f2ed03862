from __future__ import annotations

import datetime

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from cuesheet.plans.queries import ORACLE_SQL, QUERIES


def test_a_point_just_before_the_start_is_negative_though_it_rounds_to_zero(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    at = [start + datetime.timedelta(milliseconds=x) for x in (99_994, 99_996, 99_999, 100_000, 100_004, 100_005)]
    n = len(at)
    events = pa.table({"event_id": pa.array(range(n), pa.int64()), "ts": pa.array(at, pa.timestamp("us")), "user_id": pa.array(range(n), pa.int64()), "event_type": ["view"] * n, "value": [1.0] * n, "props": ["{}"] * n})
    pq.write_table(events, tmp_path / "events.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    want = duck.execute(ORACLE_SQL["lookup_points"]).fetchall()
    got = [tuple(x) for x in QUERIES["lookup_points"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want) == [(3, 0.0), (4, 0.0), (5, 0.01)]
