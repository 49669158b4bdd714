"""Row mutations by key: which operation a record is, and what a batch makes of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OP = "_op"


def operation(value: Column) -> Column:
    """I, U or D by the first letter of the trimmed, upper-cased text; anything else is an insert."""
    first = F.substring(F.upper(F.trim(value.cast("string"))), 1, 1)
    return F.when(first.isin("U", "D"), first).otherwise("I")


def resolved(cdc_field: Column | None, upsert: bool) -> Column:
    """The operation of a record: its own if there is a field for it, else update in upsert mode, else insert."""
    if cdc_field is not None:
        return operation(cdc_field)
    return F.lit("U" if upsert else "I")


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def touched(batch: DataFrame, keys: Sequence[str], order: Sequence[str], mode: str = "key", writer: Sequence[str] = ()) -> DataFrame:
    """The keys whose rows of earlier commits a batch removes.

    In mode "key" every key with an update or delete.  In mode "writer" a delete of a key that the same
    writer has already inserted in this batch takes back that row only: a key is removed if some update or
    delete of it comes first, or right after a delete.
    """
    if mode == "key":
        return batch.where(F.col(OP).isin("U", "D")).select(*keys).distinct()
    before = F.lag(OP).over(Window.partitionBy(*writer, *keys).orderBy(*order))
    return batch.withColumn("_before", F.coalesce(before, F.lit("D"))).where(F.col(OP).isin("U", "D") & (F.col("_before") == "D")).select(*keys).distinct()


def survivors(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key, unless that is a delete.

    ``max_by`` is combined before the shuffle, so a key with many changes doesn't land whole in one task.
    """
    columns = [c for c in batch.columns if c not in keys]
    last = batch.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_last"))
    return last.select(*keys, "_last.*").where(F.col(OP) != "D").select(*batch.columns)


def apply(
    table: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    mode: str = "key",
    writer: Sequence[str] = (),
    scope: Sequence[str] = (),
) -> DataFrame:
    """The table after ``batch`` (the table's columns, ``_op`` and the ``order`` columns).

    Keys are compared null-safe.  ``scope`` are the partition columns that must agree too, if mutations
    reach no further than a row's own partition.
    """
    on = [*keys, *[c for c in scope if c not in keys]]
    gone = touched(batch, on, order, mode, writer)
    kept = table.join(gone, _same(table, gone, on), "left_anti")
    return kept.unionByName(survivors(batch, on, order).select(*table.columns))
