import json

import pytest
from pyspark.sql import functions as F

from siltworks.operators import mongo, route
from siltworks.operators import transforms as xf


def log(spark, values, key=None):
    df = spark.createDataFrame([(i, v, key) for i, v in enumerate(values)], "id int, value string, key string")
    at = [F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").cast("long").alias("offset"), F.lit("2024-01-01").cast("timestamp").alias("timestamp")]
    return df.select(*at, "key", "value")


def test_json_types(spark):
    rows = [
        {"int": 1, "long": 3147483647, "double": 3.0, "big": 2**70, "str": "s", "bool": True, "null": None, "obj": {"a": 1, "b": None}, "empty_obj": {}, "empty_arr": []},
        {"arr": [1, 2], "mixed": [1, "a", None], "nulls": [None], "objs": [{"k": [1, 2]}, {}], "nested": [[1], [2]], "uneven": [[1], ["a"]], "empties": [[], []]},
    ]
    found = {r["key"]: r["type"] for r in xf.json_types(log(spark, map(json.dumps, rows))).collect()}
    assert found == {
        "int": "int", "long": "bigint", "double": "double", "big": "decimal(38,0)", "str": "string", "bool": "boolean", "obj": "map<string,string>",
        "arr": "array<int>", "mixed": "array<string>", "nulls": "array<string>", "objs": "array<map<string,string>>", "nested": "array<array<int>>", "uneven": "array<array<string>>",
    }
    first = xf.json_to_struct(log(spark, [json.dumps(rows[0])])).select("value.*").first().asDict(True)
    assert first["obj"] == {"a": "1", "b": "null"} and first["big"] == 2**70 and first["double"] == 3.0


def test_later_values_of_another_type_are_kept(spark):
    texts = ['{"a":1,"b":1}', '{"a":3000000000,"b":"later"}', '{"a":1.5,"b":2}']
    got = [r.asDict() for r in xf.json_to_struct(log(spark, texts)).orderBy("offset").select("value.*").collect()]
    # 3000000000 is a double without loss, a text is none
    assert got == [{"a": 1.0, "b": "1"}, {"a": 3e9, "b": "later"}, {"a": 1.5, "b": "2"}]
    texts = ['{"a":9007199254740993,"b":[1],"c":{"k":1},"d":true,"e":1,"f":[[]],"g":1e400}', '{"a":0.5,"b":[2.5],"c":[1],"d":1,"e":100000000000000000000,"f":[[1]]}', '{"b":[3000000000],"c":7.50}']
    kinds = {r["key"]: r["type"] for r in xf.json_types(log(spark, texts)).collect()}
    assert kinds == {"a": "string", "b": "array<double>", "c": "string", "d": "string", "e": "decimal(38,0)", "f": "array<array<int>>", "g": "double"}
    got = [r.asDict(True) for r in xf.json_to_struct(log(spark, texts)).orderBy("offset").select("value.*").collect()]
    assert [r["a"] for r in got] == ["9007199254740993", "0.5", None] and [r["b"] for r in got] == [[1.0], [2.5], [3e9]]
    assert [r["c"] for r in got] == ['{"k":1}', "[1]", "7.5"] and [r["d"] for r in got] == ["true", "1", None]
    assert [int(r["e"]) for r in got[:2]] == [1, 10**20] and got[1]["f"] == [[1]]


@pytest.mark.parametrize("a, b, both", [("int", "bigint", "bigint"), ("long", "double", "string"), ("bigint", "double", "double"), ("array<int>", "array<>", "array<int>"), ("array<int>", "array<string>", "array<string>"), ("boolean", "int", "string"), ("long", "decimal(38,0)", "decimal(38,0)")])
def test_wider(a, b, both):
    assert xf.wider(a, b) == xf.wider(b, a) == both


def test_json_map_keeps_null_as_text(spark):
    out = xf.json_to_map(log(spark, ['{"key":1,"a":"a","n":null,"l":[1, 2]}', None])).select("value").collect()
    assert out[0][0].payload == {"key": "1", "a": "a", "n": "null", "l": "[1,2]"} and out[1][0] is None


@pytest.mark.parametrize("text", ["not_a_json_object", '{"key": 1,"""***', "[1]"])
def test_json_errors(spark, text):
    with pytest.raises(Exception):
        xf.json_to_map(log(spark, [text])).collect()
    with pytest.raises(Exception):
        xf.json_to_struct(log(spark, [text])).collect()


def test_metadata_config(spark):
    df = log(spark, ["x"]).withColumn("value", F.struct(F.lit(1).alias("id")))
    row = xf.log_metadata(df, "_f", external="k,v").select("value.*").first().asDict()
    assert row == {"id": 1, "_f_topic": "t", "_f_partition": 0, "_f_offset": 0, "_f_timestamp": 1704067200000, "_f_k": "v"}
    with pytest.raises(ValueError):
        xf.log_metadata(df, external="k")


def test_copy_value(spark):
    df = log(spark, ["x"]).withColumn("value", F.struct(F.lit(1).alias("a")))
    assert xf.copy_value(df, "a", "b").select("value.*").first().asDict() == {"a": 1, "b": 1}
    assert xf.copy_value(df, "no", "b", schemaless=True).select("value.b").first()[0] is None
    with pytest.raises(ValueError):
        xf.copy_value(df, "no", "b")


def test_regex_must_match_all_of_the_value(spark):
    df = spark.createDataFrame([("type1",), ("type1\n",), ("xtype1",), (None,)], "t string")
    out = route.by_regex(df, F.col("t"), {"a": "type1", "b": "type.", "c": None}).collect()
    assert sorted((r["t"], r["_table"]) for r in out) == [("type1", "a"), ("type1", "b")]


def test_mongo_update_is_rebuilt(spark):
    before = {"_id": {"$numberLong": "1004"}, "first_name": "Anne", "last_name": "K", "when": {"$date": 1000}}
    change = {"removedFields": ["last_name"], "updatedFields": json.dumps({"first_name": "Anne Marie", "n": {"$numberInt": "3"}})}
    events = [{"op": "u", "before": json.dumps(before), "updateDescription": change, "source": {"db": "d", "collection": "c"}}, {"op": "c", "after": json.dumps(before)}]
    out = mongo.mongo_unwrap(log(spark, [*map(json.dumps, events), None])).orderBy("offset").collect()
    after = out[0]["value"]["after"].asDict()
    assert after["_id"] == 1004 and after["first_name"] == "Anne Marie" and after["last_name"] is None and after["n"] == 3
    assert out[1]["value"]["after"]["when"].timestamp() == 1.0 and out[2]["value"] is None
    keyed = {"op": "u", "updateDescription": {"updatedFields": json.dumps({"a": 1})}}
    got = mongo.mongo_unwrap(log(spark, [json.dumps(keyed)], key='{"id": "7"}')).first()["value"]["after"]
    assert got.asDict() == {"_id": 7, "a": 1}
    with pytest.raises(Exception):
        mongo.mongo_unwrap(log(spark, ["{}"])).collect()


def test_mongo_arrays():
    assert mongo.simple([1, 2]) == ({"array": "int"}, [1, 2])
    assert mongo.simple([]) == ({"array": "string"}, [])
    with pytest.raises(ValueError):
        mongo.simple([11, "abc"])
    assert mongo.simple([11, "abc"], "document") == ({"struct": {"_0": "int", "_1": "string"}}, {"_0": 11, "_1": "abc"})
    united = mongo.simple([{"a": 1}, {"a": None, "b": "x"}])[0]
    assert united == {"array": {"struct": {"a": "int", "b": "string"}}}
