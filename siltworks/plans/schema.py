"""Schemas: from declared types or from values, how they differ from a table's, and how a table's may change."""

from __future__ import annotations

import datetime as dt
import decimal
import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def declared(kind: T.DataType, force_optional: bool = False) -> T.DataType:
    """The table's type for a declared type: small ints widen, decimals have 38 digits, times of day keep their
    metadata, local timestamps gain the zone, and what has no type is text."""
    if isinstance(kind, (T.ByteType, T.ShortType)):
        return T.IntegerType()
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(38, kind.scale)
    if isinstance(kind, T.TimestampNTZType):
        return T.TimestampType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(declared(kind.elementType, force_optional), force_optional or kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(declared(kind.keyType, force_optional), declared(kind.valueType, force_optional), force_optional or kind.valueContainsNull)
    if isinstance(kind, T.StructType):
        fields = [T.StructField(f.name, declared(f.dataType, force_optional), force_optional or f.nullable, f.metadata) for f in kind.fields]
        return T.StructType(fields)
    plain = (T.BooleanType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BinaryType, T.DateType, T.TimestampType, T.StringType)
    return kind if isinstance(kind, plain) else T.StringType()


def inferred(value) -> T.DataType | None:
    """The table's type for a value without a schema; None if it tells none."""
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, str):
        return T.StringType()
    if isinstance(value, decimal.Decimal):
        _, digits, exponent = value.as_tuple()
        scale = max(0, -exponent)
        return T.DecimalType(max(len(digits) + max(0, exponent), scale), scale)
    if isinstance(value, (int, float)):
        return T.LongType() if isinstance(value, int) or value.is_integer() else T.DoubleType()
    if isinstance(value, dt.datetime):
        return T.TimestampType() if value.tzinfo else T.TimestampNTZType()
    if isinstance(value, dt.date):
        return T.DateType()
    if isinstance(value, dt.time):
        return T.LongType()
    if isinstance(value, (list, tuple)):
        inner = inferred(value[0]) if value else None
        return T.ArrayType(inner) if inner else None
    if isinstance(value, Mapping):
        fields = [T.StructField(str(k), t) for k, v in value.items() if (t := inferred(v))]
        return T.StructType(fields) if fields else None
    return None


def inferred_schema(log: DataFrame, column: str = "value") -> T.StructType:
    """The columns of JSON records in ``column``: of each path the type seen first in the log.

    One pass over the batch; each task keeps one row per path.
    """

    def run(batches: Iterator):
        import pyarrow as pa

        first: dict[str, tuple] = {}

        def walk(path: tuple, value, at: tuple) -> None:
            if isinstance(value, dict):
                for k, v in value.items():
                    walk((*path, k), v, at)
                return
            kind = inferred(value)
            name = json.dumps(path)
            if kind is not None and (name not in first or at < first[name][0]):
                first[name] = (at, kind.json())

        for batch in batches:
            for topic, partition, offset, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if text is not None:
                    walk((), json.loads(text), (topic, partition, offset))
        rows = [{"path": p, "type": t, "topic": a[0], "partition": a[1], "offset": a[2]} for p, (a, t) in first.items()]
        schema = pa.schema([("path", pa.string()), ("type", pa.string()), ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64())])
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    own = log.select("topic", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("long").alias("offset"), F.col(column))
    seen = own.mapInArrow(run, "path string, type string, topic string, partition int, offset bigint")
    at = F.struct("topic", "partition", "offset")
    rows = seen.groupBy("path").agg(F.min_by("type", at).alias("type"), F.min(at).alias("at")).orderBy("at", "path").collect()  # one per column
    root: dict = {}
    for r in rows:
        path, here = json.loads(r["path"]), root
        for name in path[:-1]:
            here = here.setdefault(name, {})
            if not isinstance(here, dict):
                break
        if isinstance(here, dict) and path:
            here.setdefault(path[-1], T._parse_datatype_json_string(r["type"]))

    def struct(fields: dict) -> T.StructType:
        return T.StructType([T.StructField(k, struct(v) if isinstance(v, dict) else v) for k, v in fields.items()])

    return struct(root)


@dataclass(frozen=True)
class Change:
    """``add`` a column of a type, ``widen`` one, or ``relax`` it to be nullable; ``path`` goes through element and value."""

    kind: str
    path: tuple[str, ...]
    type: T.DataType | None = None


def _wider(old: T.DataType, new: T.DataType) -> bool:
    return isinstance(old, T.IntegerType) and isinstance(new, T.LongType) or isinstance(old, T.FloatType) and isinstance(new, T.DoubleType)


def diff(table: T.DataType, record: T.DataType, *, has_schema: bool = True, case_insensitive: bool = False, path: tuple[str, ...] = ()) -> list[Change]:
    """What the table would need to hold the record: missing columns and, for records with a schema, wider and
    nullable ones."""
    out: list[Change] = []
    if isinstance(table, T.StructType) and isinstance(record, T.StructType):
        fold = (lambda s: s.lower()) if case_insensitive else (lambda s: s)
        own = {fold(f.name): f for f in table.fields}
        for f in record.fields:
            mine = own.get(fold(f.name))
            if mine is None:
                out.append(Change("add", (*path, f.name), f.dataType))
                continue
            at = (*path, mine.name)
            if has_schema and f.nullable and not mine.nullable:
                out.append(Change("relax", at))
            out += diff(mine.dataType, f.dataType, has_schema=has_schema, case_insensitive=case_insensitive, path=at)
    elif isinstance(table, T.ArrayType) and isinstance(record, T.ArrayType):
        out += diff(table.elementType, record.elementType, has_schema=has_schema, case_insensitive=case_insensitive, path=(*path, "element"))
    elif isinstance(table, T.MapType) and isinstance(record, T.MapType):
        out += diff(table.valueType, record.valueType, has_schema=has_schema, case_insensitive=case_insensitive, path=(*path, "value"))
    elif has_schema and path and _wider(table, record):
        out.append(Change("widen", path, record))
    return out


def evolved(table: T.DataType, changes: list[Change]) -> T.DataType:
    """The table's type after ``changes``: added, then widened, then relaxed; those that it meets already do nothing.

    Columns are never dropped, renamed, reordered or narrowed.
    """
    for kind in ("add", "widen", "relax"):
        for c in changes:
            if c.kind == kind:
                table = _changed(table, c, c.path)
    return table


def _changed(kind: T.DataType, c: Change, path: tuple[str, ...]) -> T.DataType:
    if not path:
        return c.type if c.kind == "widen" and _wider(kind, c.type) else kind
    name, rest = path[0], path[1:]
    if isinstance(kind, T.ArrayType) and name == "element":
        return T.ArrayType(_changed(kind.elementType, c, rest), kind.containsNull)
    if isinstance(kind, T.MapType) and name == "value":
        return T.MapType(kind.keyType, _changed(kind.valueType, c, rest), kind.valueContainsNull)
    if not isinstance(kind, T.StructType):
        raise ValueError(f"{'.'.join(c.path)}: no such column")
    if name not in kind.fieldNames():
        if rest or c.kind != "add":
            raise ValueError(f"{'.'.join(c.path)}: no such column")
        return T.StructType([*kind.fields, T.StructField(name, c.type, True)])
    out = []
    for f in kind.fields:
        if f.name == name:
            nullable = f.nullable or c.kind == "relax" and not rest
            f = T.StructField(f.name, _changed(f.dataType, c, rest), nullable, f.metadata)
        out.append(f)
    return T.StructType(out)
