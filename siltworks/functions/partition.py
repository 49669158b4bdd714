"""Partition transforms: their parser, and their values as column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS = {"year": "year", "years": "year", "month": "month", "months": "month", "day": "day", "days": "day", "hour": "hour", "hours": "hour"}


@dataclass(frozen=True)
class PartitionField:
    """``transform`` of ``column``; ``arg`` is the number of buckets or the width."""

    column: str
    transform: str = "identity"
    arg: int | None = None

    @property
    def name(self) -> str:
        """The name of the partition's column."""
        kinds = {"identity": self.column, "truncate": f"{self.column}_trunc", "bucket": f"{self.column}_bucket"}
        return kinds.get(self.transform, f"{self.column}_{self.transform}").replace(".", "_")


def parse(specs: Iterable[str]) -> list[PartitionField]:
    """``column``, ``year(column)``, ``bucket(column, n)``, ``truncate(column, width)``..."""
    out = []
    for spec in specs:
        found = re.fullmatch(r"(\w+)\s*\((.*)\)", spec.strip())
        if not found:
            out.append(PartitionField(spec.strip()))
            continue
        name, args = found[1].lower(), [a.strip() for a in found[2].split(",")]
        if name in _UNITS:
            if len(args) != 1 or not args[0]:
                raise ValueError(f"{name} takes one column: {spec}")
            out.append(PartitionField(args[0], _UNITS[name]))
        elif name in ("bucket", "truncate"):
            if len(args) != 2 or not args[1].isdigit() or not int(args[1]):
                raise ValueError(f"{name} takes a column and a positive number: {spec}")
            out.append(PartitionField(args[0], name, int(args[1])))
        else:
            raise ValueError(f"unknown transform: {spec}")
    return out


def _rotl(x: int, r: int) -> int:
    return (x << r | x >> 32 - r) & 0xFFFFFFFF


def murmur3(data: bytes) -> int:
    """The 32-bit Murmur3 hash of bytes with seed 0, as a signed int."""
    h = 0
    whole = len(data) // 4 * 4

    def mixed(k: int) -> int:
        return _rotl(k * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF

    for at in range(0, whole, 4):
        h = (_rotl(h ^ mixed(int.from_bytes(data[at : at + 4], "little")), 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    if data[whole:]:
        h ^= mixed(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    for mult, shift in ((0x85EBCA6B, 16), (0xC2B2AE35, 13)):
        h = (h ^ h >> shift) * mult & 0xFFFFFFFF
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def _portable_bucket(c: Column, src: T.DataType, n: int) -> Column:
    """The bucket that other engines compute from the bytes of a value: whole numbers as 8 bytes, texts as UTF-8."""
    whole = isinstance(src, (T.IntegerType, T.LongType, T.ShortType, T.ByteType))

    @F.pandas_udf("int")
    def bucket(values: pd.Series) -> pd.Series:
        def one(v):
            if v is None or v != v:
                return None
            data = int(v).to_bytes(8, "little", signed=True) if whole else v.encode() if isinstance(v, str) else bytes(v)
            return (murmur3(data) & 0x7FFFFFFF) % n

        return values.map(one).astype("Int32")

    return bucket(c.cast("long") if whole else c)


#: Table property: "portable" gives buckets the hash that other engines compute, anything else Spark's own.
BUCKET_HASH = "write.bucket-hash"


def value(field: PartitionField, src: T.DataType, portable: bool = False) -> Column:
    """The partition value of a row: years, months and hours since 1970 as numbers, days as dates."""
    c = F.col(field.column)
    if field.transform == "identity":
        return c
    if field.transform == "bucket":
        return _portable_bucket(c, src, field.arg) if portable else F.when(c.isNotNull(), F.pmod(F.hash(c), F.lit(field.arg)))
    if field.transform == "truncate":
        if isinstance(src, T.StringType):
            return F.substring(c, 1, field.arg)
        if isinstance(src, T.BinaryType):
            return F.substring(c, 1, field.arg)
        if isinstance(src, T.DecimalType):  # the unscaled value is truncated
            step = F.lit(str(field.arg)).cast("decimal(20,0)") / F.lit(10).cast("decimal(2,0)") ** src.scale if src.scale else F.lit(field.arg)
            return (c - F.pmod(c, step)).cast(src)
        return (c - F.pmod(c, F.lit(field.arg))).cast(src)
    if field.transform == "year":
        return F.year(c) - 1970
    if field.transform == "month":
        return (F.year(c) - 1970) * 12 + F.month(c) - 1
    if field.transform == "day":
        return F.to_date(c)
    micros = F.unix_micros(c.cast("timestamp"))
    return F.floor(micros / F.lit(3_600_000_000)).cast("int")
