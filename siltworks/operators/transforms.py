"""Reshaping of records before they are routed.

Records are DataFrames with the envelope ``topic, partition, offset, timestamp`` and the record in
``value`` (a struct, a map, or JSON text where said); every transform maps such a DataFrame to another.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def extract(value: Column, src: T.DataType, path: str) -> Column:
    """The field at a dotted ``path``; null where a map has no such key, an error where a struct has no such field."""
    for name in path.split("."):
        if isinstance(src, T.StructType):
            if name not in src.fieldNames():
                raise ValueError(f"no field {name} in {path}")
            value, src = value.getField(name), src[name].dataType
        elif isinstance(src, T.MapType):
            value, src = F.try_element_at(value, F.lit(name)), src.valueType
        elif isinstance(src, T.VariantType):
            value = F.try_variant_get(value, f"$['{name}']", "variant")
        else:
            raise ValueError(f"{path} goes through a {src.simpleString()}")
    return F.try_variant_get(value, "$", "string") if isinstance(src, T.VariantType) else value


def _fields(df: DataFrame, column: str = "value") -> list[str]:
    kind = df.schema[column].dataType
    if not isinstance(kind, T.StructType):
        raise TypeError(f"{column} must be a struct, not {kind.simpleString()}")
    return kind.fieldNames()


def _replaced(df: DataFrame, fields: list[Column]) -> DataFrame:
    return df.withColumn("value", F.when(F.col("value").isNotNull(), F.struct(*fields)))


def copy_value(df: DataFrame, source: str, target: str, schemaless: bool = False) -> DataFrame:
    """Adds ``target``, a copy of ``source``; without a schema a missing source is null and a target is replaced."""
    names = _fields(df)
    if source not in names and not schemaless:
        raise ValueError(f"no field {source}")
    copy = F.col("value").getField(source) if source in names else F.lit(None).cast("string")
    kept = [F.col("value").getField(n).alias(n) for n in names if n != target]
    return _replaced(df, [*kept, copy.alias(target)])


def dms_unwrap(df: DataFrame) -> DataFrame:
    """Promotes the fields of ``data`` and adds ``_cdc`` (op, ts, source) from ``metadata``; others are dropped."""
    data, meta = F.col("value.data"), F.col("value.metadata")
    op = F.when(meta["operation"] == "update", "U").when(meta["operation"] == "delete", "D").otherwise("I")
    source = F.concat(meta["schema-name"].cast("string"), F.lit("."), meta["table-name"].cast("string"))
    cdc = F.struct(op.alias("op"), meta["timestamp"].alias("ts"), source.alias("source"))
    names = df.schema["value"].dataType["data"].dataType.fieldNames()
    kept = df.where(F.col("value").isNull() | (data.isNotNull() & meta.isNotNull()))
    return _replaced(kept, [*[data[n].alias(n) for n in names], cdc.alias("_cdc")])


def debezium_unwrap(df: DataFrame, target: str | None = None, schemaless: bool = False, key: str | None = "key") -> DataFrame:
    """The row after a change (before it, if deleted) with ``_cdc`` (op, ts, offset, source, target, key).

    ``target`` is a pattern with {db} and {table}.  Without a schema the time stays milliseconds, and records
    without a row are dropped.  The key is there only if there is a ``key`` column that is a struct or map.
    """
    kind = df.schema["value"].dataType
    value, source = F.col("value"), F.col("value.source")
    names = kind["source"].dataType.fieldNames()
    op = F.when(value["op"] == "u", "U").when(value["op"] == "d", "D").otherwise("I")
    row = F.when(op == "D", value["before"]).otherwise(value["after"])
    db = source["schema" if "schema" in names else "db"]
    name = source["table" if "table" in names else "collection"]
    goal = F.replace(F.replace(F.lit(target or "{db}.{table}"), F.lit("{db}"), db), F.lit("{table}"), name)
    ts = value["ts_ms"].cast("long") if schemaless else F.timestamp_millis(value["ts_ms"].cast("long"))
    cdc = [op.alias("op"), ts.alias("ts"), F.col("offset").alias("offset"), F.concat(db, F.lit("."), name).alias("source"), goal.alias("target")]
    if key and key in df.columns and isinstance(df.schema[key].dataType, (T.StructType, T.MapType)):
        cdc.append(F.col(key).alias("key"))
    out = df.withColumn("_row", row)
    if schemaless:
        out = out.where(value.isNull() | F.col("_row").isNotNull())
    fields = [F.col("_row").getField(n).alias(n) for n in kind["after"].dataType.fieldNames()]
    return _replaced(out, [*fields, F.struct(*cdc).alias("_cdc")]).drop("_row")


def log_metadata(df: DataFrame, name: str = "_kafka_metadata", nested: bool = False, external: str | None = None) -> DataFrame:
    """Adds where a record stood in the log: topic, partition, offset and milliseconds, flat or as a struct."""
    fixed = []
    if external is not None:
        parts = external.split(",")
        if len(parts) != 2:
            raise ValueError("the external field is a name and a value, separated by a comma")
        fixed = [(parts[0], F.lit(parts[1]))]
    meta = [("topic", F.col("topic")), ("partition", F.col("partition").cast("int")), ("offset", F.col("offset").cast("long")), ("timestamp", F.unix_millis(F.col("timestamp").cast("timestamp"))), *fixed]
    fields = [F.col("value").getField(n).alias(n) for n in _fields(df)]
    if nested:
        return _replaced(df, [*fields, F.struct(*[c.alias(n) for n, c in meta]).alias(name)])
    return _replaced(df, [*fields, *[c.alias(f"{name}_{n}") for n, c in meta]])


def json_to_map(df: DataFrame) -> DataFrame:
    """JSON objects in ``value`` as one field ``payload``, a map of texts: strings as they are, others as JSON."""
    found = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    payload = F.transform_values(found, lambda k, v: F.coalesce(v, F.lit("null")))
    return df.withColumn("value", F.when(F.col("value").isNotNull(), F.struct(payload.alias("payload"))))


#: Largest whole number up to which every whole number is a double.
_EXACT = 1 << 53


def _class(value) -> str | None:
    """The column type of one JSON value, as DDL; None if it has none.  Whole numbers that a double can't hold are ``long``."""
    if value is None:
        return None
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        if -(1 << 31) <= value < 1 << 31:
            return "int"
        if -(1 << 63) <= value < 1 << 63:
            return "bigint" if abs(value) <= _EXACT else "long"
        return "decimal(38,0)" if abs(value) < 10**38 else "string"
    if isinstance(value, float):
        return "double"
    if isinstance(value, str):
        return "string"
    if isinstance(value, dict):
        return "map<string,string>" if value else None
    return _array(value) if value else None


def _array(values: list) -> str:
    """The type of an array: of its elements' one type; texts if they differ in more than width, or one is null."""
    if any(v is None for v in values):
        return "array<string>"
    kinds = {_class(v) or ("map<string,string>" if isinstance(v, dict) else "array<>") for v in values}
    return f"array<{functools.reduce(wider, sorted(kinds))}>"


#: Types of whole numbers, each of which holds the ones before it.
_WHOLE = ("int", "bigint", "long", "decimal(38,0)")


def wider(a: str, b: str) -> str:
    """The type that holds the values of both without loss: whole numbers widen, and to doubles if these hold them; else text."""
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if {a, b} <= {"int", "bigint", "double"}:
        return "double"
    if a.startswith("array<") and b.startswith("array<"):
        inner = [x[6:-1] for x in (a, b)]
        return f"array<{wider(*inner) if all(inner) else max(inner)}>"
    return "string"


def _settled(kind: str) -> str | None:
    """The DDL of a type of the whole batch; None if only empty arrays were seen."""
    return None if "array<>" in kind else kind.replace("long", "bigint")


def json_types(df: DataFrame, column: str = "value") -> DataFrame:
    """(key, type) of the top-level keys of JSON objects: of each key the type that holds all its values in the batch.

    One pass; each task keeps one row per key and type, few of which there are per key.  Keys whose values
    are all null, or empty objects or arrays, have no type and are left out.
    """

    def run(batches: Iterator):
        import pyarrow as pa

        seen: dict[str, str] = {}
        for batch in batches:
            for topic, partition, offset, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if text is None:
                    continue
                found = json.loads(text)
                if not isinstance(found, dict):
                    raise ValueError(f"not a JSON object in {topic}/{partition} at {offset}")
                for key, value in found.items():
                    kind = _class(value)
                    if kind:
                        seen[key] = wider(seen[key], kind) if key in seen else kind
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.string())], names=["key", "type"])

    own = df.select("topic", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("long").alias("offset"), F.col(column))
    seen = own.mapInArrow(run, "key string, type string").groupBy("key").agg(F.sort_array(F.collect_set("type")).alias("types"))
    found = [(r["key"], kind) for r in seen.collect() if (kind := _settled(functools.reduce(wider, r["types"])))]  # one row per column
    return df.sparkSession.createDataFrame(found, "key string, type string")


def _as_json(element: Column) -> Column:
    return F.coalesce(element, F.lit("null"))


def _shown(value: Column, kind: str) -> Column:
    """A parsed value in which JSON nulls within texts are the text ``null``."""
    if kind == "map<string,string>":
        return F.transform_values(value, lambda k, v: _as_json(v))
    if kind == "array<string>":
        return F.transform(value, _as_json)
    if kind.startswith("array<"):
        return F.transform(value, lambda x: _shown(x, kind[6:-1]))
    return value


def json_to_struct(df: DataFrame) -> DataFrame:
    """JSON objects in ``value`` as typed fields, one per top-level key; nested objects are maps of texts.

    A key's type holds all its values in the batch (:func:`json_types`): what differs in more than width is
    text, as it stands in the JSON (a fraction as the double that it is).  The text is parsed once for all keys.
    """
    kinds = {r["key"]: r["type"] for r in json_types(df).orderBy("key").collect()}  # one row per column
    if not kinds:
        return _replaced(df, [F.lit(None).cast("string").alias("_none")])
    whole = F.from_json("value", T.StructType([T.StructField(name, _ddl(kind)) for name, kind in kinds.items()]))
    fields = [_shown(F.col("_whole").getField(name), kind).alias(name) for name, kind in kinds.items()]
    return _replaced(df.withColumn("_whole", whole), fields).drop("_whole")


def _ddl(kind: str) -> T.DataType:
    return T.StructType.fromDDL(f"x {kind}")["x"].dataType
