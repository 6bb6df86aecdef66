"""The parcel table against its SQL."""

import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from furrow.operators import parcels
from furrow.plans import catalogue


def test_every_parcel_is_in_the_table(spark, tmp_path):
    """Over 1,000 parcels, and confidences whose means lie on a half."""
    n, draw = 2_400 * 100, random.Random(3)
    value = [draw.randint(0, 999) * 0.1 for _ in range(n)]
    t = pa.table({"event_id": pa.array(range(n), pa.int64()), "value": pa.array([round(x, 2) for x in value], pa.float64())})
    (tmp_path / "events.parquet").mkdir()
    for i in range(5):
        pq.write_table(t.slice(i * n // 5, n // 5), tmp_path / "events.parquet" / f"part-{i}.parquet")
    con = duckdb.connect()
    con.sql("SET threads = 1")
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    df = catalogue.QUERIES["parcel_table"](spark, str(tmp_path))
    theirs = sorted(con.sql(f"SELECT {', '.join(df.columns)} FROM ({catalogue.ORACLE_SQL['parcel_table']})").fetchall())
    ours = sorted(tuple(r) for r in df.collect())
    assert len(ours) == len(theirs) > 1_000
    assert ours == theirs


def test_ranks_without_a_limit(spark):
    sizes = spark.range(0, 12_000, 1, 7).selectExpr("id AS comp", "id * 7919 % 50 + 2 AS pixels")
    rows = parcels.filter_rank(sizes, most=None).collect()
    assert [r.parcel_no for r in sorted(rows, key=lambda r: (-r.pixels, r.comp))] == list(range(1, 12_001))
    assert parcels.filter_rank(sizes.where("comp < 0"), most=None).collect() == []
