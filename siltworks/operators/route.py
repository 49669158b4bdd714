"""Which tables a record goes to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig

TABLE = "_table"


def whole_match(value: Column, regex: str) -> Column:
    """Whether ``regex`` matches all of the text, a trailing newline included."""
    return value.rlike(rf"\A(?:{regex})\z")


def to_all(records: DataFrame, tables: list[str]) -> DataFrame:
    """Every record to every table."""
    return records.withColumn(TABLE, F.explode(F.array(*[F.lit(t) for t in tables])))


def by_regex(records: DataFrame, field: Column, regexes: dict[str, str | None]) -> DataFrame:
    """Each record to the tables whose regex matches its route value; none without a value, or a regex."""
    value = field.cast("string")
    hits = [F.when(whole_match(value, r), F.lit(t)) for t, r in regexes.items() if r is not None]
    if not hits:
        return records.withColumn(TABLE, F.lit("")).limit(0)
    return records.withColumn(TABLE, F.explode(F.array_compact(F.array(*hits))))


def dynamic(records: DataFrame, field: Column) -> DataFrame:
    """Each record to the table that its route value names, in lower case."""
    return records.withColumn(TABLE, F.lower(field.cast("string"))).where(F.col(TABLE).isNotNull())


def route(records: DataFrame, config: EngineConfig, field: Column | None = None) -> DataFrame:
    """``records`` with the column ``_table``, one row per record and table.

    ``field`` is the route value; it is needed when ``config`` has a route field.
    """
    if config.dynamic:
        return dynamic(records, field)
    if config.route_field is None:
        return to_all(records, list(config.tables))
    return by_regex(records, field, {t: config.table(t).route_regex for t in config.tables})


def existing(routed: DataFrame, listing: DataFrame) -> DataFrame:
    """The routed rows whose table is in the catalog's ``listing`` (_table); the others are dropped."""
    return routed.join(listing.select(TABLE).distinct(), TABLE, "left_semi")
