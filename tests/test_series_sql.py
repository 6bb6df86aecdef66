"""Queries over series against their SQL, on events whose values meet thresholds exactly."""

import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from furrow.plans import catalogue

DAY = 24 * 3600 * 1_000_000
START = 1_704_067_200_000_000  #: 2024-01-01 in microseconds


def write_events(folder, values, files=1):
    """values: of each user eight lists, the bins of 90 hours. Events are numbered so that those of a bin lie far apart, and dealt to files by number."""
    rows = [(k, u, t, x) for u, bins in enumerate(values) for t, xs in enumerate(bins) for k, x in enumerate(xs)]
    rows.sort(key=lambda r: r[0])
    n = len(rows)
    columns = {
        "event_id": pa.array(range(n), pa.int64()), "ts": pa.array([START + t * 90 * DAY // 24 + k * 60_000_000 for k, _, t, _ in rows], pa.timestamp("us")),
        "user_id": pa.array([u for _, u, _, _ in rows], pa.int64()), "event_type": pa.array(["view"] * n), "value": pa.array([x for *_, x in rows], pa.float64()), "props": pa.array(["{}"] * n),
    }
    t = pa.table(columns)
    (folder / "events.parquet").mkdir()
    for i in range(files):
        pq.write_table(t.slice(i * n // files, (i + 1) * n // files - i * n // files), folder / "events.parquet" / f"part-{i:02}.parquet")


def both(spark, folder, name):
    """Sorted rows of a query and of its SQL, which adds in the order of events."""
    con = duckdb.connect()
    con.sql("SET threads = 1")
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet/*.parquet')")
    df = catalogue.QUERIES[name](spark, str(folder))
    sql = f"SELECT {', '.join(df.columns)} FROM ({catalogue.ORACLE_SQL[name]})"
    key = lambda r: r[:2]
    return sorted((tuple(r) for r in df.collect()), key=key), sorted(con.sql(sql).fetchall(), key=key)


#: Values whose series, shifted by three tenths, lie on a threshold of the priors and rules.
ON_THRESHOLDS = [27.5, 35.0, 39.0, 46.0, 51.0, 52.5, 54.0, 55.0, 56.0, 57.5, 60.0, 62.5, 67.5, 69.0, 70.0, 76.0]


@pytest.mark.parametrize("name", ["builtin_prior", "builtin_prior_lswi", "pseudo_labels", "score_rules"])
def test_shifted_series_on_thresholds(spark, tmp_path, name):
    draw = random.Random(5)
    write_events(tmp_path, [[[draw.choice(ON_THRESHOLDS[a : a + 6])] for _ in range(8)] for a in range(11) for _ in range(60)])
    ours, theirs = both(spark, tmp_path, name)
    assert len(ours) == 11 * 60 * 4
    assert ours == theirs


@pytest.mark.parametrize("name", ["cloud_spike_repair"])
def test_sums_do_not_depend_on_how_events_are_dealt(spark, tmp_path, name):
    """Means lie on a threshold, and a bin's events in all files: any other order of adding moves some to the other side."""
    draw = random.Random(9)

    def five(total):
        xs = [draw.randint(0, 9_999) for _ in range(4)]
        return [x / 100 for x in (*xs, total - sum(xs))]

    write_events(tmp_path, [[five(60_000 if t % 2 == 0 else 60_000 - 18_000) for t in range(8)] for _ in range(400)], 5)
    ours, theirs = both(spark, tmp_path, name)
    assert len(ours) == 400
    assert ours == theirs


@pytest.mark.parametrize("name", ["builtin_prior", "builtin_prior_lswi", "pseudo_labels", "score_rules"])
def test_series_with_null_values(spark, tmp_path, name):
    """A bin whose values are all null is left out of a series' mean, as SQL leaves it out; series of nulls alone stay null."""
    draw = random.Random(13)
    bins = lambda: [[None if draw.random() < 0.2 else draw.uniform(60, 400), None] for _ in range(8)]
    write_events(tmp_path, [bins() for _ in range(300)] + [[[None]] * 8])
    ours, theirs = both(spark, tmp_path, name)
    assert len(ours) == 301 * 4
    assert ours == theirs


@pytest.mark.parametrize("name", ["builtin_prior_lswi", "pseudo_labels", "score_rules"])
def test_sums_follow_the_files_where_events_are_not_numbered_in_order(spark, tmp_path, name):
    """Means lie on thresholds, numbers run backwards in three files and repeat: SQL adds as the files hold the events."""
    draw = random.Random(17)

    def five(total):
        xs = [draw.randint(0, 7_000) for _ in range(4)]
        return [x / 100 for x in (*xs, total - sum(xs))]

    mixed = [[five(draw.choice([25_000, 30_000, 35_000, 50_000, 60_000][a : a + 2])) for _ in range(8)] for a in range(4) for _ in range(200)]
    one = [[five(b if t == 6 else a) for t in range(8)] for a, b in ((25_000, 60_000), (120_000, 70_000)) for _ in range(200)]  # one bin decides
    write_events(tmp_path, mixed + one, 3)
    for path in (tmp_path / "events.parquet").glob("*.parquet"):
        t = pq.read_table(path)
        pq.write_table(t.set_column(0, "event_id", pa.array([(t.num_rows - i) // 2 for i in range(t.num_rows)], pa.int64())), path)
    ours, theirs = both(spark, tmp_path, name)
    assert len(ours) == 1200 * 4
    assert ours == theirs


def test_bins_without_a_time_come_last(spark, tmp_path):
    """As SQL's lists order them; a user has seven bins and one of events without a time."""
    draw = random.Random(19)
    write_events(tmp_path, [[[draw.uniform(40, 250)] for _ in range(8)] for _ in range(300)])
    path = tmp_path / "events.parquet" / "part-00.parquet"
    t = pq.read_table(path)
    ts = [None if x.as_py() < 300 * 4 and x.as_py() % 8 == 3 else s for x, s in zip(t["event_id"], t["ts"].to_pylist())]
    pq.write_table(t.set_column(1, "ts", pa.array(ts, pa.timestamp("us"))), path)
    ours, theirs = both(spark, tmp_path, "pseudo_labels")
    assert len(ours) == 300 * 4 and len({r[2:] for r in ours}) > 2
    assert ours == theirs


@pytest.mark.parametrize("name", ["builtin_prior_lswi", "pseudo_labels", "score_rules"])
def test_events_just_before_the_origin(spark, tmp_path, name):
    """Half an hour before the origin is a bin of its own: those users still have eight bins, that one first."""
    draw = random.Random(23)
    write_events(tmp_path, [[[draw.uniform(40, 250)] for _ in range(8)] for _ in range(300)])
    path = tmp_path / "events.parquet" / "part-00.parquet"
    t = pq.read_table(path)
    ts = [START - 30 * 60_000_000 if i.as_py() % 16 == 7 else s.value for i, s in zip(t["event_id"], t["ts"])]
    pq.write_table(t.set_column(1, "ts", pa.array(ts, pa.timestamp("us"))), path)
    ours, theirs = both(spark, tmp_path, name)
    assert len(ours) == 300 * 4
    assert ours == theirs
