import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions.coerce import Options, coerce, coerce_field, project


def one(spark, value, src, dst, opts=None):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("x", src)]))
    return df.select(coerce(F.col("x"), src, dst, opts).alias("y")).first()["y"]


S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


@pytest.mark.parametrize(
    "value, src, dst, expected",
    [
        ("12", S, I, 12),
        ("+7", S, L, 7),
        (1 << 32 | 5, L, I, 5),
        (2147483648, L, I, -2147483648),
        (1.9, D, I, 1),
        (-1.9, D, L, -1),
        (1e30, D, I, 2147483647),
        (float("nan"), D, L, 0),
        ("123.45", S, T.DecimalType(10, 2), Decimal("123.45")),
        (2.345, D, T.DecimalType(10, 2), Decimal("2.35")),
        ("TRUE", S, T.BooleanType(), True),
        ("yes", S, T.BooleanType(), False),
        ("AQID", S, T.BinaryType(), bytearray(b"\x01\x02\x03")),
        ("2023-11-15", S, T.DateType(), dt.date(2023, 11, 15)),
        (19676, L, T.DateType(), dt.date(2023, 11, 15)),
        (1, I, S, "1"),
        (None, S, I, None),
    ],
)
def test_scalars(spark, value, src, dst, expected):
    assert one(spark, value, src, dst) == expected


@pytest.mark.parametrize("sep", ["T", " "])
@pytest.mark.parametrize("offset", ["Z", "+00", "+00:00", "+0000", ""])
def test_timestamp_spellings(spark, sep, offset):
    text = f"2023-05-18{sep}11:22:33{offset}"
    for strict in (False, True):
        opts = Options(strict_timestamps=strict)
        assert one(spark, text, S, T.TimestampNTZType(), opts) == dt.datetime(2023, 5, 18, 11, 22, 33)
        df = spark.createDataFrame([(text,)], "x string").select(F.unix_seconds(coerce(F.col("x"), S, T.TimestampType(), opts)))
        assert df.first()[0] == 1684408953


@pytest.mark.parametrize("text", [" 12 ", "1.0", "", "x"])
def test_bad_numbers_name_the_record(spark, text):
    with pytest.raises(Exception, match="events/1/7"):
        one(spark, text, S, I, Options(where=F.lit("events/1/7")))


@pytest.mark.parametrize("text", ["2023-05-18T11:22:33-05:00", "2023-05-18T11:22:33.1+00:00"])
def test_strict_timestamps_reject(spark, text):
    assert one(spark, text, S, T.TimestampType()) is not None
    with pytest.raises(Exception, match="cannot convert"):
        one(spark, text, S, T.TimestampType(), Options(strict_timestamps=True))


def test_uuid_and_time(spark):
    df = spark.createDataFrame([("F81D4FAE-7DEC-11D0-A765-00A0C91E6BF6", "07:14:21")], "u string, t string")
    u = T.StructField("u", S, True, {"logical": "uuid"})
    t = T.StructField("t", L, True, {"logical": "time-micros"})
    row = df.select(coerce_field(F.col("u"), S, u, Options()), coerce_field(F.col("t"), S, t, Options())).first()
    assert tuple(row) == ("f81d4fae-7dec-11d0-a765-00a0c91e6bf6", 26061000000)


def test_nested_records(spark):
    src = T.StructType.fromDDL("ii string, st struct<l:int, extra:int>, li array<int>, ma map<string,string>")
    dst = T.StructType.fromDDL("ii int, st struct<l:bigint, none:string>, li array<bigint>, ma map<int,int>, gone date")
    df = spark.createDataFrame([(("1", (2, 3), [4, None], {"5": "6"}),)], T.StructType([T.StructField("value", src)]))
    row = df.select(*project(F.col("value"), src, dst)).first()
    assert row.asDict(True) == {"ii": 1, "st": {"l": 2, "none": None}, "li": [4, None], "ma": {5: 6}, "gone": None}


def test_variants(spark):
    dst = T.StructType.fromDDL("a int, b double, c string, d array<int>, e struct<f:boolean>, g map<string,int>")
    df = spark.sql("""SELECT parse_json('{"a":"7","b":1.5,"c":{"x":null},"d":[1,"2"],"e":{"f":"True"},"g":{"h":3}}') AS value""")
    row = df.select(*project(F.col("value"), T.VariantType(), dst)).first().asDict(True)
    assert row == {"a": 7, "b": 1.5, "c": '{"x":null}', "d": [1, 2], "e": {"f": True}, "g": {"h": 3}}


def test_types_that_do_not_convert():
    with pytest.raises(TypeError):
        coerce(F.lit(1), I, T.BooleanType())
