"""Change events of document databases: extended JSON rebuilt into rows with a schema.

The documents are parsed in an Arrow pass that writes plain JSON and the types it sees; the planner turns
the types into a schema, and the rows are then read by ``from_json`` with it.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import millis


def simple(value, mode: str = "array"):
    """(type, plain value) of one extended-JSON value; the type is None if the field is left out.

    Types are DDL names, {"struct": {...}} or {"array": type}.
    """
    if value is None:
        return "null", None  # text, unless another document tells more
    if isinstance(value, str):
        return "string", value
    if isinstance(value, bool):
        return "boolean", value
    if isinstance(value, int):
        return ("int" if -(1 << 31) <= value < 1 << 31 else "bigint"), value
    if isinstance(value, float):
        return "double", value
    if isinstance(value, list):
        return _array(value, mode)
    tags = set(value)
    if tags == {"$oid"}:
        return "string", value["$oid"]
    if tags == {"$numberLong"}:
        return "bigint", int(value["$numberLong"])
    if tags == {"$numberInt"}:
        return "int", int(value["$numberInt"])
    if tags == {"$numberDouble"}:
        return "double", float(value["$numberDouble"])
    if tags == {"$numberDecimal"}:
        return "string", value["$numberDecimal"]
    if tags == {"$date"}:
        when = value["$date"]
        if isinstance(when, dict):
            when = int(when["$numberLong"])
        if isinstance(when, str):
            from datetime import datetime

            when = millis(datetime.fromisoformat(when.replace("Z", "+00:00")))
        return "timestamp", when
    if tags == {"$timestamp"}:
        return "timestamp", value["$timestamp"]["t"] * 1000
    if tags == {"$binary"}:
        inner = value["$binary"]
        return "binary", inner["base64"] if isinstance(inner, dict) else inner
    if tags == {"$binary", "$type"}:
        return "binary", value["$binary"]
    if tags == {"$code"}:
        return "string", value["$code"]
    if tags == {"$code", "$scope"}:
        kind, scope = _document(value["$scope"], mode)
        return {"struct": {"code": "string", "scope": kind}}, {"code": value["$code"], "scope": scope}
    if tags in ({"$regex", "$options"}, {"$regularExpression"}):
        inner = value.get("$regularExpression") or {"pattern": value.get("$regex"), "options": value.get("$options")}
        return {"struct": {"regex": "string", "options": "string"}}, {"regex": inner["pattern"], "options": inner["options"]}
    if tags & {"$undefined", "$minKey", "$maxKey"}:
        return None, None
    return _document(value, mode)


def _document(value: dict, mode: str):
    kinds, plain = {}, {}
    for k, v in value.items():
        kind, out = simple(v, mode)
        if kind is not None:
            kinds[k], plain[k] = kind, out
    return {"struct": kinds}, plain


def _array(values: list, mode: str):
    if mode == "document":
        kinds, plain = {}, {}
        for i, v in enumerate(values):
            kind, out = simple(v, mode)
            if kind is not None:
                kinds[f"_{i}"], plain[f"_{i}"] = kind, out
        return {"struct": kinds}, plain
    if not values:
        return {"array": "string"}, []
    found = [simple(v, mode) for v in values]
    kind = found[0][0]
    for other, _ in found[1:]:
        kind = merged(kind, other, "array")
    return {"array": kind}, [out for _, out in found]


def merged(a, b, where: str = "field"):
    """One type for two: a null yields to any, documents are united by key, other conflicts are errors."""
    if a == b or b == "null":
        return a
    if a == "null":
        return b
    if isinstance(a, dict) and isinstance(b, dict) and "struct" in a and "struct" in b:
        out = dict(a["struct"])
        for k, v in b["struct"].items():
            out[k] = merged(out[k], v, k) if k in out else v
        return {"struct": out}
    if isinstance(a, dict) and isinstance(b, dict) and "array" in a and "array" in b:
        return {"array": merged(a["array"], b["array"], where)}
    if {str(a), str(b)} == {"int", "bigint"}:
        return "bigint"
    raise ValueError(f"{where} mixes {a} and {b}")


def data_type(kind) -> T.DataType | None:
    """The Spark type; None for a struct without fields, which files can't hold."""
    if isinstance(kind, str):
        return T.StructType.fromDDL(f"x {'bigint' if kind == 'timestamp' else 'string' if kind == 'binary' else kind}")["x"].dataType
    if "array" in kind:
        inner = data_type(kind["array"])
        return T.ArrayType(inner) if inner else None
    fields = [T.StructField(k, t) for k, v in kind["struct"].items() if (t := data_type(v))]
    return T.StructType(fields) if fields else None


def _typed(c, kind):
    """The parsed column with dates and binaries in place of the numbers and texts that stand for them."""
    if kind == "timestamp":
        return F.timestamp_millis(c)
    if kind == "binary":
        return F.unbase64(c)
    if isinstance(kind, dict) and "array" in kind:
        return F.transform(c, lambda x: _typed(x, kind["array"]))
    if isinstance(kind, dict):
        fields = [_typed(c.getField(k), v).alias(k) for k, v in kind["struct"].items() if data_type(v)]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def rebuilt(event: dict, key: str | None) -> tuple[dict | None, dict | None]:
    """(before, after) of one event: an update without its row is made of the one before, what changed and what went."""
    parse = lambda x: json.loads(x) if isinstance(x, str) else x
    before, after, change = parse(event.get("before")), parse(event.get("after")), event.get("updateDescription")
    if before is None and after is None and change is None:
        raise ValueError("an event needs before, after or updateDescription")
    if after is None and change is not None and event.get("op") != "d":
        after = dict(before or {})
        after.update(parse(change.get("updatedFields")) or {})
        for name in change.get("removedFields") or ():
            after.pop(name, None)
        if "_id" not in after and key is not None:
            own = json.loads(key)
            own = own.get("id", own) if isinstance(own, dict) else own
            after["_id"] = json.loads(own) if isinstance(own, str) else own
    return before, after


def _united(batches: Iterator):
    """One type for all shapes of documents that a task sees."""
    import pyarrow as pa

    kind = None
    for batch in batches:
        for text in batch.column(0).to_pylist():
            kind = json.loads(text) if kind is None else merged(kind, json.loads(text))
    if kind is not None:
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(kind)])], names=["_kind"])


def mongo_unwrap(df: DataFrame, mode: str = "array") -> DataFrame:
    """Events (JSON text in ``value``, the record's key as JSON text in ``key``) with typed ``before`` and ``after``.

    Tombstones pass; other envelope fields stay as the texts that they are.
    """
    if mode not in ("array", "document"):
        raise ValueError("mode is array or document")

    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            out = [[] for _ in range(3)]
            for key, text in zip(batch.column("key").to_pylist(), batch.column("value").to_pylist(), strict=True):
                if text is None:
                    row = (None, None, None)
                else:
                    before, after = rebuilt(json.loads(text), key)
                    kind, plain = None, [None, None]
                    for i, part in enumerate((before, after)):
                        if part is not None:
                            own, plain[i] = _document(part, mode)
                            kind = own if kind is None else merged(kind, own)
                    row = (json.dumps(kind), *(None if p is None else json.dumps(p) for p in plain))
                for column, v in zip(out, row, strict=True):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.string()) for c in out)], names=[*batch.schema.names, "_kind", "_before", "_after"])

    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.StringType()) for n in ("_kind", "_before", "_after")]])
    parsed = df.mapInArrow(run, schema)
    kind = {"struct": {}}
    shapes = parsed.where("_kind is not null").select("_kind").distinct()
    for r in shapes.mapInArrow(_united, "_kind string").collect():  # one row per task
        kind = merged(kind, json.loads(r["_kind"]))
    own = data_type(kind) or T.StructType([T.StructField("_id", T.StringType())])
    for name in ("before", "after"):
        parsed = parsed.withColumn(name, _typed(F.from_json(f"_{name}", own), kind if data_type(kind) else {"struct": {"_id": "string"}}))
    envelope = F.from_json("value", "op string, ts_ms bigint, source struct<db:string,collection:string>")
    fields = [envelope.getField(n).alias(n) for n in ("op", "ts_ms", "source")]
    value = F.when(F.col("value").isNotNull(), F.struct(*fields, F.col("before"), F.col("after")))
    return parsed.withColumn("value", value).select(*df.columns)


def encoded(data: bytes) -> dict:
    """Bytes as extended JSON."""
    return {"$binary": {"base64": base64.b64encode(data).decode(), "subType": "00"}}
