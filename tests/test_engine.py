import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.config import EngineConfig, TableConfig
from siltworks.functions import partition
from siltworks.operators import commits
from siltworks.plans import schema as schemas
from siltworks.sources.store import Conflict, Store
from siltworks.streaming.engine import Engine

EVENT = "id bigint, type string, payload string, op string"


def log(spark, rows, schema=EVENT, start=0):
    df = spark.createDataFrame([(start + i, r) for i, r in enumerate(rows)], T.StructType([T.StructField("offset", T.LongType()), T.StructField("value", T.StructType.fromDDL(schema))]))
    return df.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset", F.lit("2024-01-01").cast("timestamp").alias("timestamp"), "value")


def test_cdc_and_the_snapshot(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    config = EngineConfig(tables=("db.t",), auto_create=True, cdc_field="op", default_id_columns=("id",), default_commit_branch="test_branch")
    engine = Engine(spark, config, store)
    engine.run_batch(log(spark, [(1, "a", "x", "I"), (2, "b", "x", "I"), (3, "c", "x", "I")]), 0)
    engine.run_batch(log(spark, [(1, "a", "x", "D"), (3, "c", "updated!", "U")], start=3), 1)
    rows = store.table("db.t").scan("test_branch").select("id", "payload").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(2, "x"), (3, "updated!")]
    assert store.table("db.t").scan().count() == 0  # the commits are on the branch
    state = store.table("db.t").load("test_branch")
    assert state.operation == "overwrite" and state.summary["kafka.connect.vtts"] == "1704067200000"
    assert '"t-0": 5' in next(v for k, v in state.summary.items() if "offsets" in k)


def test_failure_of_one_table_is_made_good(spark, tmp_path, monkeypatch):
    store = Store(spark, f"file://{tmp_path}")
    config = EngineConfig(tables=("a", "b"), auto_create=True, route_field="type", per_table={"a": TableConfig("a"), "b": TableConfig("b")})
    engine = Engine(spark, config, store)
    batch = log(spark, [(1, "a", "x", "I"), (2, "b", "x", "I"), (3, "z", "x", "I")])
    whole = Engine._table

    def broken(self, name, *rest):
        if name == "b":
            raise OSError("lost")
        return whole(self, name, *rest)

    monkeypatch.setattr(Engine, "_table", broken)
    with pytest.raises(OSError):
        engine.run_batch(batch, 7)
    monkeypatch.setattr(Engine, "_table", whole)
    for _ in range(2):
        engine.run_batch(batch, 7)
    assert [store.table(t).scan().count() for t in "ab"] == [1, 1]


def test_missing_tables(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    batch = log(spark, [(1, "a", "Tbl1", "I"), (2, "b", "tbl2", "I"), (3, "b", None, "I")])
    with pytest.raises(LookupError):
        Engine(spark, EngineConfig(tables=("t",)), store).run_batch(batch)
    store.table("tbl1").create(T.StructType.fromDDL(EVENT))
    Engine(spark, EngineConfig(dynamic=True, route_field="payload"), store).run_batch(batch)
    assert store.table("tbl1").scan().count() == 1 and not store.exists("tbl2")


def test_many_tables_read_the_log_once(spark, tmp_path):
    batch = log(spark, [(1, "a", "007", "I"), (2, "b", "7", "I"), (3, "bc", "7", "I"), (4, None, None, "I")])
    by_regex = EngineConfig(tables=("a", "b", "c"), auto_create=True, route_field="type", per_table={n: TableConfig(f".*{n}.*") for n in "abc"})
    for config, want in ((by_regex, {"a": [1], "b": [2, 3], "c": [3]}), (EngineConfig(dynamic=True, auto_create=True, route_field="payload"), {"007": [1], "7": [2, 3]})):
        store = Store(spark, f"file://{tmp_path}/{config.dynamic}")
        events = Engine(spark, config, store).run_batch(batch)
        assert {n: sorted(r.id for r in store.table(n).scan().collect()) for n in want} == want
        assert [e["table"] for e in events[:-1]] == sorted(want)
        assert not list((tmp_path / str(config.dynamic)).glob("_staged*"))


def test_tombstones_only_move_offsets(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    batch = log(spark, [(1, "a", "x", "I")]).withColumn("value", F.when(F.col("offset") < 0, F.col("value")))
    events = Engine(spark, EngineConfig(tables=("t",), auto_create=True), store).run_batch(batch)
    assert events[-1]["type"] == "commit-complete" and len(events) == 1


def test_store_conflicts_and_creation(spark, tmp_path):
    table = Store(spark, f"file://{tmp_path}").table("t")
    state = table.create(T.StructType.fromDDL("a int"), ["nonsense(a)"])
    assert state.spec == () and table.create(T.StructType.fromDDL("b int")).schema == state.schema
    with pytest.raises(Conflict):
        table._publish(1, {})
    assert table.append(spark.createDataFrame([], "a int")).number == 1  # nothing to commit


def test_torn_entries_are_passed_over(spark, tmp_path):
    table = Store(spark, f"file://{tmp_path}").table("t")
    table.create(T.StructType.fromDDL("a int"))
    table.append(spark.createDataFrame([(1,)], "a int"))
    (tmp_path / "t/_log/000000000003.json").write_text("")
    (tmp_path / "t/_log/000000000004.json").write_text('{"branch": "ma')
    assert table.load().number == 2 and len(table.history()) == 2
    assert table.append(spark.createDataFrame([(2,)], "a int")).number == 5
    assert sorted(r["a"] for r in table.scan().collect()) == [1, 2]
    assert not [p for p in (tmp_path / "t/_log").iterdir() if p.name.startswith("_")]


def test_plans_do_not_grow_with_the_commits(spark, tmp_path):
    engine = Engine(spark, EngineConfig(tables=("t",), auto_create=True, cdc_field="op", default_id_columns=("id",), compact_after=0), Store(spark, f"file://{tmp_path}"))
    sizes, want = [], {}
    for k in range(6):
        engine.run_batch(log(spark, [(k % 3, "a", f"v{k}", "U"), (k + 10, "b", "x", "I")], start=2 * k), k)
        want |= {k % 3: f"v{k}", k + 10: "x"}
        table = engine.store.table("t").scan()
        sizes.append(table._jdf.queryExecution().optimizedPlan().toString().count("\n"))
    assert dict(table.select("id", "payload").collect()) == want and sizes[-1] == sizes[1]
    assert table._jdf.queryExecution().optimizedPlan().toString().count("Join LeftAnti") == 1


def test_tables_are_compacted(spark, tmp_path):
    engine = Engine(spark, EngineConfig(tables=("t",), auto_create=True, cdc_field="op", default_id_columns=("id",), compact_after=3), Store(spark, f"file://{tmp_path}"))
    for k in range(5):
        engine.run_batch(log(spark, [(1, "a", f"v{k}", "U")], start=k), k)
    table = engine.store.table("t")
    assert len(table.load().files) <= 5 and [r["payload"] for r in table.scan().collect()] == ["v4"]
    engine.run_batch(log(spark, [(1, "a", "again", "U")], start=4), 4)  # known, though compacted since
    assert [r["payload"] for r in table.scan().collect()] == ["v4"]


def test_changes_need_keys(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    batch = log(spark, [(1, "a", "x", "I"), (1, "a", "x", "D")])
    with pytest.raises(ValueError):
        Engine(spark, EngineConfig(tables=("t",), auto_create=True, cdc_field="op"), store).run_batch(batch)
    store.table("u").create(T.StructType.fromDDL(EVENT), (), {"identifier-fields": "id"})
    Engine(spark, EngineConfig(tables=("u",), cdc_field="op"), store).run_batch(batch)
    assert store.table("u").scan().count() == 0


def test_deletes_by_partition_value(spark, tmp_path):
    schema = "id bigint, ts timestamp, op string"
    rows = lambda *at: log(spark, [(1, dt.datetime(2024, 1, d, h), op) for d, h, op in at], schema)
    for spec in ("day(ts)", "hour(ts)", "bucket(id, 4)"):
        for properties in ({}, {"write.bucket-hash": "portable"}):
            config = EngineConfig(tables=("t",), auto_create=True, cdc_field="op", default_id_columns=("id",), delete_scope="partition", default_partition_by=(spec,), auto_create_props=properties)
            engine = Engine(spark, config, Store(spark, f"file://{tmp_path}/{spec[:3]}{len(properties)}"))
            engine.run_batch(rows((1, 1, "I"), (2, 1, "I")), 0)
            engine.run_batch(rows((1, 2, "U")), 1)
            left = sorted((r["ts"].day, r["ts"].hour) for r in engine.store.table("t").scan().collect())
            assert left == {"day": [(1, 2), (2, 1)], "hou": [(1, 1), (1, 2), (2, 1)], "buc": [(1, 2)]}[spec[:3]]


def test_idle_partitions_hold_the_time_back(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    config = EngineConfig(tables=("t",), auto_create=True)
    move = lambda df, p: df.withColumn("partition", F.lit(p))
    one = log(spark, [(1, "a", "x", "I")])
    assert Engine(spark, config, store, assigned=[("t", 7)]).run_batch(one, 0)[-1]["vtts"] is None
    engine = Engine(spark, config, store)
    assert engine.run_batch(move(one, 1), 1)[-1]["vtts"] is None  # partition 0 is known from the table
    assert engine.run_batch(one.unionByName(move(one, 1)), 2)[-1]["vtts"] == 1704067200000
    assert store.table("t").offsets(config.control_topic, config.control_group) == {"t-0": 1, "t-1": 1}
    assert store.table("none").offsets("x", "y") == {}


def test_target_file_size(spark, tmp_path):
    table = Store(spark, f"file://{tmp_path}").table("t")
    table.create(T.StructType.fromDDL("a bigint, b string"), (), {"write.target-file-size-bytes": "40000"})
    rows = spark.range(20_000, numPartitions=1).select(F.col("id").alias("a"), F.md5(F.col("id").cast("string")).alias("b"))
    for _ in range(2):
        table.append(rows)
    first, second = (len(list((tmp_path / "t/data" / f["path"].rsplit("/", 1)[1]).glob("*.parquet"))) for f in table.load().files)
    assert first > 1 and 15 <= second <= 40 and table.scan().count() == 40_000


def test_evolution(spark):
    table = T.StructType([T.StructField("i", T.IntegerType(), False), T.StructField("f", T.FloatType(), False), T.StructField("l", T.ArrayType(T.StructType.fromDDL("x int")))])
    record = T.StructType([T.StructField("i", T.LongType(), True), T.StructField("f", T.DoubleType(), False), T.StructField("s", T.StringType()), T.StructField("l", T.ArrayType(T.StructType.fromDDL("x int, y int")))])
    changes = schemas.diff(table, record)
    assert {(c.kind, c.path) for c in changes} == {("relax", ("i",)), ("widen", ("i",)), ("widen", ("f",)), ("add", ("s",)), ("add", ("l", "element", "y"))}
    new = schemas.evolved(table, changes)
    assert new["i"].nullable and new["i"].dataType == T.LongType() and new["l"].dataType.elementType.fieldNames() == ["x", "y"]
    assert schemas.diff(new, record) == []
    assert [c.kind for c in schemas.diff(table, record, has_schema=False)] == ["add", "add"]


def test_inference():
    assert schemas.inferred(1.0) == T.LongType() and schemas.inferred(1.5) == T.DoubleType()
    assert schemas.inferred(dt.date(2024, 1, 1)) == T.DateType()
    for nothing in (None, [], [None], [{}], {}, {"c": None}, {"n": {}}, b"x"):
        assert schemas.inferred(nothing) is None
    assert schemas.inferred({"a": [1], "b": None}) == T.StructType.fromDDL("a array<bigint>")


def test_partition_specs(spark):
    got = partition.parse(["year(a)", "hours(b)", "bucket(c, 4)", "truncate(d, 10)", "e"])
    assert [(f.transform, f.arg) for f in got] == [("year", None), ("hour", None), ("bucket", 4), ("truncate", 10), ("identity", None)]
    for bad in ("nope(a)", "bucket(a)", "truncate(a, x)", "day(a, b)"):
        with pytest.raises(ValueError):
            partition.parse([bad])
    df = spark.sql("SELECT timestamp'1969-12-31 23:30:00' AS ts, -7 AS n")
    row = df.select(partition.value(got[1].__class__("ts", "hour"), T.TimestampType()), partition.value(got[1].__class__("n", "truncate", 5), T.IntegerType())).first()
    assert tuple(row) == (-1, -10)


def test_portable_buckets(spark):
    assert partition.murmur3((34).to_bytes(8, "little")) == 2017239379
    assert partition.murmur3(b"iceberg") == 1210000089
    df = spark.createDataFrame([(34,), (None,)], "n int")
    assert [r[0] for r in df.select(partition.value(partition.PartitionField("n", "bucket", 16), T.IntegerType(), portable=True)).collect()] == [2017239379 % 16, None]


def test_commit_plans():
    f = commits.File
    a = commits.Response("c", 1, (f("x", 5), f("x", 5), f("e", 0)), progress={("t", 0): (4, 30), ("t", 1): (None, 20)})
    b = commits.Response("c", 2, (f("x", 5), f("y", 5, spec_id=1)))
    old = commits.Response("c", 0, (f("z", 5),))
    plan = commits.plan_commit([old, a, b], "c", {0: 1})
    assert [(s.operation, [x.path for x in s.files]) for s in plan] == [("append", ["x"]), ("append", ["y"])]
    assert "kafka.connect.vtts" not in plan[0].summary and plan[1].summary["kafka.connect.vtts"] == "20"
    assert plan[1].summary["kafka.connect.offsets.control.group"] == '{"0":3}'
    assert "kafka.connect.vtts" not in commits.plan_commit([a], "c", {}, partial=True)[-1].summary
    delta = commits.plan_commit([commits.Response("c", 5, (f("x", 5), f("d", 1, "deletes")))], "c", {})
    assert [s.operation for s in delta] == ["overwrite"] and commits.plan_commit([], "c", {}) == []


def test_vtts_needs_every_partition(spark):
    assigned = spark.createDataFrame([("t", 0), ("t", 1)], "topic string, partition int")
    progress = spark.createDataFrame([("t", 0, 5, dt.datetime(2024, 1, 1))], "topic string, partition int, next_offset long, last_timestamp timestamp")
    assert commits.valid_through(assigned, progress).first()[0] is None
    assert commits.valid_through(assigned.limit(1), progress).first()[0] == dt.datetime(2024, 1, 1)
    assert commits.valid_through(assigned.limit(1), progress, partial=True).first()[0] is None


def test_compaction_and_later_deletes(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    engine = Engine(spark, EngineConfig(tables=("t",), auto_create=True, cdc_field="op", default_id_columns=("id",)), store)
    engine.audit = "events"
    engine.run_batch(log(spark, [(1, "a", "x", "I"), (2, "b", "x", "I")]), 0)
    engine.run_batch(log(spark, [(1, "a", "y", "U")], start=2), 1)
    table = store.table("t")
    before = sorted(map(tuple, table.scan().collect()))
    assert len(table.compact().files) == 1 and sorted(map(tuple, table.scan().collect())) == before
    engine.run_batch(log(spark, [(2, "b", "x", "D")], start=3), 2)
    assert [r["id"] for r in table.scan().collect()] == [1]
    kinds = [r["type"] for r in store.table("events").scan().orderBy("id").collect()]
    assert kinds == ["commit-table", "commit-complete"] * 3


def test_formats_and_partitions(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    for name in ("parquet", "orc"):
        table = store.table(name)
        table.create(T.StructType.fromDDL("id bigint, data string"), ["data"], {"write.format.default": name})
        table.append(spark.createDataFrame([(123, "hello world!"), (234, "foobar")], "id bigint, data string"))
        (file,) = table.load().files
        assert file["record_count"] == 2 and sorted(r["id"] for r in table.scan().collect()) == [123, 234]
        assert sum("_p_data=" in p.name for p in tmp_path.glob(f"{name}/data/*/*")) == 2
