"""Lenient conversion of a record's values to the types of a table's columns, as column expressions.

Every conversion is null for null.  A type that can't be converted at all is an error when the plan is
built; a value that can't be is an error of the task which names where the record came from.  All results
are Catalyst expressions, so a conversion stays in generated code and below a projection.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType)
#: Logical types that are stored as another type, by this key of a field's metadata.
LOGICAL = "logical"
UUID, TIME = {LOGICAL: "uuid"}, {LOGICAL: "time-micros"}

_INTEGER = r"\A[+-]?[0-9]+\z"
_DATE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_UUID = r"\A(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"
_LOCAL = r"[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?"
_TIMESTAMP = rf"\A{_LOCAL}(Z|[+-][0-9]{{2}}(:?[0-9]{{2}})?)?\z"
#: As above, but an offset with a colon only if positive and right after whole seconds.
_STRICT = rf"\A({_LOCAL}(Z|[+-][0-9]{{2}}([0-9]{{2}})?)?|[0-9-]{{10}}[T ][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}\+[0-9]{{2}}:[0-9]{{2}})\z"
_OFFSET = r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)\z"


@dataclass(frozen=True)
class Options:
    """``where`` says where a record came from, for errors; ``aliases`` maps a column's path to its other names."""

    case_insensitive: bool = False
    strict_timestamps: bool = False
    where: Column | None = None
    aliases: Mapping[str, tuple[str, ...]] | None = None


def _fail(c: Column, to: str, dst: T.DataType, opts: Options) -> Column:
    parts = [F.lit(f"cannot convert to {to}: "), F.coalesce(c.cast("string"), F.lit("null"))]
    if opts.where is not None:
        parts += [F.lit(" in "), opts.where]
    return F.raise_error(F.concat(*parts)).cast(dst)


def _guarded(c: Column, pattern: str, then: Column, to: str, dst: T.DataType, opts: Options) -> Column:
    return F.when(c.isNull(), F.lit(None).cast(dst)).when(c.rlike(pattern), then).otherwise(_fail(c, to, dst, opts))


def _whole(c: Column, src: T.DataType, dst: T.DataType, opts: Options) -> Column:
    """To int or long: whole numbers wrap, fractions are truncated and saturate, text is strictly an integer."""
    bits = 32 if isinstance(dst, T.IntegerType) else 64
    low, high = -(1 << bits - 1), (1 << bits - 1) - 1
    if isinstance(src, INTEGRAL):
        return F.shiftright(F.shiftleft(c.cast("long"), 32), 32).cast(dst) if bits == 32 and isinstance(src, T.LongType) else c.cast(dst)
    if isinstance(src, FRACTIONAL):
        d = c.cast("double")
        inside = F.when(d >= float(high), F.lit(high)).when(d <= float(low), F.lit(low)).otherwise(F.when((d > float(low)) & (d < float(high)), d).otherwise(0.0).cast("long"))
        return F.when(c.isNull(), F.lit(None)).when(F.isnan(d), F.lit(0)).otherwise(inside).cast(dst)
    if isinstance(src, T.DecimalType):
        # truncated, then the low bits of the two's complement
        cut = F.when(c < 0, F.ceil(c)).otherwise(F.floor(c)).cast("decimal(38,0)")
        span = F.lit(1 << bits).cast("decimal(38,0)") if bits == 32 else F.lit("18446744073709551616").cast("decimal(38,0)")
        rest = F.pmod(cut, span)
        return F.when(rest > F.lit(str(high)).cast("decimal(38,0)"), rest - span).otherwise(rest).cast(dst)
    if isinstance(src, T.StringType):
        return _guarded(c, _INTEGER, c.cast(dst), dst.simpleString(), dst, opts)
    raise TypeError(f"{src.simpleString()} does not convert to {dst.simpleString()}")


def _fraction(c: Column, src: T.DataType, dst: T.DataType, opts: Options) -> Column:
    if isinstance(src, (*INTEGRAL, *FRACTIONAL, T.DecimalType, T.StringType)):
        return c.cast(dst)
    raise TypeError(f"{src.simpleString()} does not convert to {dst.simpleString()}")


def _decimal(c: Column, src: T.DataType, dst: T.DataType, opts: Options) -> Column:
    """Rounded half up; doubles by their shortest text; what doesn't fit the precision is an error."""
    if isinstance(src, FRACTIONAL):
        return c.cast("double").cast("string").cast(dst)
    if isinstance(src, (*INTEGRAL, T.DecimalType, T.StringType)):
        return c.cast(dst)
    raise TypeError(f"{src.simpleString()} does not convert to {dst.simpleString()}")


def _boolean(c: Column, src: T.DataType, dst: T.DataType, opts: Options) -> Column:
    if isinstance(src, T.BooleanType):
        return c
    if isinstance(src, T.StringType):
        return F.lower(c) == "true"
    raise TypeError(f"{src.simpleString()} does not convert to boolean")


def _string(c: Column, src: T.DataType, dst: T.DataType, opts: Options) -> Column:
    if isinstance(src, T.StringType):
        return c
    if isinstance(src, (*INTEGRAL, *FRACTIONAL, T.DecimalType, T.BooleanType)):
        return c.cast("string")
    if isinstance(src, (T.MapType, T.ArrayType, T.StructType)):
        return F.to_json(c, {"ignoreNullFields": "false"})
    raise TypeError(f"{src.simpleString()} does not convert to string")


def _binary(c: Column, src: T.DataType, dst: T.DataType, opts: Options) -> Column:
    if isinstance(src, T.BinaryType):
        return c
    if isinstance(src, T.StringType):
        return F.to_binary(c, F.lit("base64"))
    raise TypeError(f"{src.simpleString()} does not convert to binary")


def _date(c: Column, src: T.DataType, dst: T.DataType, opts: Options) -> Column:
    if isinstance(src, T.DateType):
        return c
    epoch = F.lit("1970-01-01").cast("date")
    if isinstance(src, INTEGRAL):
        return F.date_add(epoch, c.cast("int"))
    if isinstance(src, T.StringType):
        return _guarded(c, _DATE, F.to_date(c, "yyyy-MM-dd"), "date", dst, opts)
    if isinstance(src, T.TimestampType):  # whole days of its milliseconds, toward zero
        millis = F.unix_millis(c)
        return F.date_add(epoch, F.when(millis < 0, F.ceil(millis / 86_400_000)).otherwise(F.floor(millis / 86_400_000)).cast("int"))
    raise TypeError(f"{src.simpleString()} does not convert to date")


def time_micros(c: Column, src: T.DataType, opts: Options | None = None) -> Column:
    """Microseconds of the day: of ISO local times, milliseconds of the day, or the UTC time of a timestamp."""
    opts = opts or Options()
    if isinstance(src, INTEGRAL):
        return c.cast("long") * 1000
    if isinstance(src, T.StringType):
        pattern = r"\A([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]{1,9})?)?\z"
        part = [F.regexp_extract(c, r"\A([0-9]{2}):([0-9]{2})(?::([0-9]{2}))?", k) for k in (1, 2, 3)]
        whole = part[0].cast("long") * 3600 + part[1].cast("long") * 60 + F.when(part[2] == "", "0").otherwise(part[2]).cast("long")
        fraction = F.rpad(F.regexp_extract(c, r"\.([0-9]{1,6})", 1), 6, "0").cast("long")
        return _guarded(c, pattern, whole * 1_000_000 + fraction, "time", T.LongType(), opts)
    if isinstance(src, T.TimestampType):
        return F.pmod(F.unix_micros(c), F.lit(86_400_000_000))
    raise TypeError(f"{src.simpleString()} does not convert to time")


def _timestamp_text(c: Column, dst: T.DataType, opts: Options) -> Column:
    if isinstance(dst, T.TimestampNTZType):
        then = F.to_timestamp_ntz(F.regexp_replace(c, _OFFSET, ""))  # the wall time; an offset is dropped
    else:
        with_colon = F.regexp_replace(c, r"([+-][0-9]{2})([0-9]{2})\z", "$1:$2")
        with_minutes = F.regexp_replace(with_colon, r"(:[0-9]{2}(?:\.[0-9]+)?[+-][0-9]{2})\z", "$1:00")
        has_offset = c.rlike(_OFFSET)
        then = F.when(has_offset, F.to_timestamp(with_minutes)).otherwise(F.to_timestamp(F.concat(c, F.lit("Z"))))
    return _guarded(c, _STRICT if opts.strict_timestamps else _TIMESTAMP, then.cast(dst), dst.simpleString(), dst, opts)


def _timestamp(c: Column, src: T.DataType, dst: T.DataType, opts: Options) -> Column:
    if isinstance(src, INTEGRAL):
        instant = F.timestamp_millis(c.cast("long"))
        return instant if isinstance(dst, T.TimestampType) else F.to_utc_timestamp(instant, "UTC").cast(dst)
    if isinstance(src, T.StringType):
        return _timestamp_text(c, dst, opts)
    if isinstance(src, (T.TimestampType, T.TimestampNTZType)):
        return c.cast(dst)  # local times are UTC, as the session's time zone is
    raise TypeError(f"{src.simpleString()} does not convert to {dst.simpleString()}")


def _variant(c: Column, dst: T.DataType, opts: Options) -> Column:
    """By the kind that each value has: texts, whole numbers, fractions and booleans under their own rules."""
    kind = F.schema_of_variant(c)
    out = F.when(c.isNull() | (kind == "VOID"), F.lit(None).cast(dst))
    for name, src in (("STRING", T.StringType()), ("BIGINT", T.LongType()), ("BOOLEAN", T.BooleanType())):
        try:
            out = out.when(kind == name, coerce(F.try_variant_get(c, "$", src.simpleString()), src, dst, opts))
        except TypeError:
            continue
    try:
        number = F.try_variant_get(c, "$", "double")
        out = out.when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), coerce(number, T.DoubleType(), dst, opts))
    except TypeError:
        pass
    if isinstance(dst, T.StringType):
        out = out.when(kind.rlike("^(OBJECT|ARRAY)"), F.to_json(c))
    return out.otherwise(_fail(F.to_json(c), dst.simpleString(), dst, opts))


def field_of(names: list[str], path: str, name: str, opts: Options) -> str | None:
    """Which of a record's ``names`` is the column ``name``: a mapped name if there are any, else its own.

    With a name mapping case always counts.
    """
    if opts.aliases is not None:
        wanted = opts.aliases.get(f"{path}{name}") or (name,)
        return next((n for n in names if n in wanted), None)
    if name in names:
        return name
    if opts.case_insensitive:
        return next((n for n in names if n.lower() == name.lower()), None)
    return None


def _struct(c: Column, src: T.DataType, dst: T.StructType, opts: Options, path: str) -> Column:
    fields = []
    for f in dst.fields:
        name, inner = None, None
        if isinstance(src, T.StructType):
            name = field_of(src.fieldNames(), path, f.name, opts)
            if name is not None:
                inner = coerce_field(c.getField(name), src[name].dataType, f, opts, f"{path}{f.name}.")
        elif isinstance(src, T.MapType):
            names = list((opts.aliases or {}).get(f"{path}{f.name}") or (f.name,))
            got = F.coalesce(*[F.try_element_at(c, F.lit(n)) for n in names])
            inner = coerce_field(got, src.valueType, f, opts, f"{path}{f.name}.")
        else:
            inner = coerce_field(F.try_variant_get(c, f"$['{f.name}']", "variant"), src, f, opts, f"{path}{f.name}.")
        fields.append((F.lit(None).cast(f.dataType) if inner is None else inner).alias(f.name))
    return F.when(c.isNotNull(), F.struct(*fields))


def coerce(c: Column, src: T.DataType, dst: T.DataType, opts: Options | None = None, path: str = "") -> Column:
    """The column ``c`` of type ``src`` as ``dst``."""
    opts = opts or Options()
    if isinstance(src, T.NullType):
        return c.cast(dst)
    if isinstance(dst, T.StructType):
        if isinstance(src, (T.StructType, T.MapType, T.VariantType)):
            return _struct(c, src, dst, opts, path)
    elif isinstance(dst, T.ArrayType):
        if isinstance(src, T.VariantType):
            c, src = F.try_variant_get(c, "$", "array<variant>"), T.ArrayType(T.VariantType())
        if isinstance(src, T.ArrayType):
            return F.transform(c, lambda x: coerce(x, src.elementType, dst.elementType, opts, f"{path}element."))
    elif isinstance(dst, T.MapType):
        if isinstance(src, T.VariantType):
            c, src = F.try_variant_get(c, "$", "map<string,variant>"), T.MapType(T.StringType(), T.VariantType())
        if isinstance(src, T.MapType):
            keys = F.transform_keys(c, lambda k, v: coerce(k, src.keyType, dst.keyType, opts, f"{path}key."))
            return F.transform_values(keys, lambda k, v: coerce(v, src.valueType, dst.valueType, opts, f"{path}value."))
    elif isinstance(src, T.VariantType):
        return c if isinstance(dst, T.VariantType) else _variant(c, dst, opts)
    else:
        rules: list[tuple[tuple, Callable]] = [
            ((T.IntegerType, T.LongType), _whole),
            ((T.FloatType, T.DoubleType), _fraction),
            ((T.DecimalType,), _decimal),
            ((T.BooleanType,), _boolean),
            ((T.StringType,), _string),
            ((T.BinaryType,), _binary),
            ((T.DateType,), _date),
            ((T.TimestampType, T.TimestampNTZType), _timestamp),
        ]
        for kinds, rule in rules:
            if isinstance(dst, kinds):
                return rule(c, src, dst, opts)
    raise TypeError(f"{src.simpleString()} does not convert to {dst.simpleString()}")


def coerce_field(c: Column, src: T.DataType, f: T.StructField, opts: Options, path: str = "") -> Column:
    """As :func:`coerce`, for a table's field: logical types have rules of their own."""
    logical = (f.metadata or {}).get(LOGICAL)
    if logical and isinstance(src, T.VariantType):
        kind = T.StringType()
        return coerce_field(F.try_variant_get(c, "$", "string"), kind, f, opts, path)
    if logical == "uuid" and isinstance(src, T.StringType):
        return _guarded(c, _UUID, F.lower(c), "uuid", T.StringType(), opts)
    if logical == "time-micros":
        return time_micros(c, src, opts)
    return coerce(c, src, f.dataType, opts, path)


def project(value: Column, src: T.DataType, table: T.StructType, opts: Options | None = None) -> list[Column]:
    """One column per column of ``table``, from the record in ``value``: what a scan returns after a write."""
    opts = opts or Options()
    out = []
    for f in table.fields:
        one = T.StructType([f])
        out.append(_struct(value, src, one, opts, "").getField(f.name).alias(f.name, metadata=f.metadata or {}))
    return out
