from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siltworks import queries
from siltworks.functions.times import millis
from siltworks.operators import mongo
from siltworks.sources.log import whole_millis


def test_every_millisecond_is_exact():
    start = datetime(2024, 1, 30, 19, 44, 18, tzinfo=UTC)
    first = millis(start)
    assert [millis(start + timedelta(milliseconds=k)) for k in range(2000)] == list(range(first, first + 2000))
    assert millis(datetime(1969, 12, 31, 23, 59, 59, 999_500, tzinfo=UTC)) == -1


def test_local_times():
    when = datetime(2024, 1, 30, 19, 44, 18, 550_000)
    assert millis(when) == millis(when.astimezone(UTC))


def test_document_dates_keep_their_milliseconds():
    assert mongo.simple({"$date": "2024-01-30T19:44:18.550Z"}) == ("timestamp", 1706643858550)


def test_times_of_a_broker_are_the_nearest_milliseconds(spark):
    us = [-1501, -1500, -1499, -501, -500, -499, 0, 499, 500, 1500, 2500, 1706659084196499, 1706659084196500, 253402300799998999]
    df = spark.createDataFrame([(u,) for u in us], "us long").select(F.unix_micros(whole_millis(F.timestamp_micros("us"))).alias("us"))
    want = [-2, -2, -1, -1, -1, 0, 0, 0, 1, 2, 3, 1706659084196, 1706659084197, 253402300799999]
    assert df.schema["us"].dataType.simpleString() == "bigint" and [r[0] for r in df.collect()] == [1000 * w for w in want]


@pytest.mark.parametrize("us, want", [(1706643058549781, 1706643058550), (1706643058549499, 1706643058549), (1706643058549500, 1706643058550), (-1500, -2), (-1499, -1)])
def test_valid_through_time_is_that_of_the_sql(spark, tmp_path, us, want):
    rows = [(i, us + 400 * (i % 4) + 5_000 * (i < 4), i % 3, "view", 1.0, "{}") for i in range(8)]  # the first ones of each partition are later
    events = spark.createDataFrame(rows, "event_id long, us long, user_id long, event_type string, value double, props string")
    events.withColumn("ts", F.timestamp_micros("us").cast("timestamp_ntz")).drop("us").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(tuple(r) for r in queries.QUERIES["vtts_idle_partition"](spark, str(tmp_path)).collect())
    assert got == [(4, want), (5, None)]
    con = pytest.importorskip("duckdb").connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    assert got == sorted(con.execute(queries.ORACLE_SQL["vtts_idle_partition"]).fetchall())
