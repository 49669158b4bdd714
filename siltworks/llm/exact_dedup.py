"""Exact de-duplication with a heavy-hitter split.

A frequent-items sketch in the Misra-Gries family (``approx_top_k``: bounded counters, mergeable) names
the digests that may be frequent.  Their exact counts are taken, the verified winners - fewer than
``candidates`` rows whatever the input - are broadcast, and rows with a winning digest are settled on the
map side.  All other digests are settled by one ordinary aggregation and a join back, both of which cope
with what skew is left.  Everything is DataFrame or SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, normalised, parted, release


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``text_sha256`` and a row number, in a written table."""
    return materialise(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.sha2(normalised(F.col(text_col)).cast("binary"), 256).alias("text_sha256"),
        ).withColumn("_row", F.monotonically_increasing_id())
    )


def _settled(rows: DataFrame) -> DataFrame:
    """Per digest: the row that stays, how many rows, and how many of them repeat that row's id."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row"))
    return rows.groupBy("text_sha256").agg(first.alias("_first"), F.count("*").alias("group_size"))


def exact_dedup(rows: DataFrame, candidates: int = 1024, counters: int = 8192) -> DataFrame:
    """Settle the rows of :func:`digests`: adds ``keep_id``, ``group_size`` and ``kept``.

    Of equal texts the smallest ``doc_id`` stays; a null id comes last, and of rows that repeat the
    smallest id exactly one is kept.  Null texts are empty texts.  An empty table gives no rows.
    """
    n = rows.count()
    share = max(2, n // candidates)  # at most `candidates` digests can be as frequent
    top = rows.agg(F.expr(f"approx_top_k(text_sha256, {candidates}, {counters})").alias("t"))
    maybe = top.select(F.explode("t").alias("t")).select(F.col("t.item").alias("text_sha256"))
    exact = _settled(rows.join(F.broadcast(maybe), "text_sha256", "left_semi"))
    # at most `candidates` rows, all of them counted exactly
    winners = materialise(exact.where(F.col("group_size") >= share))
    hot = rows.join(F.broadcast(winners), "text_sha256")
    rest = rows.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
    cold = rest.join(_settled(rest), "text_sha256")
    return hot.unionByName(cold).select(
        "doc_id",
        F.col("_first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_first._row")).alias("kept"),
        "text_sha256",
        "_row",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns: of equal texts one row, the smallest id's.

    A null id comes last, whatever the ids' type.  Of rows that repeat that id and text the one whose columns
    come first as JSON stays, so reruns agree.  Only the ids of rows that go are looked for: a bitmap of them
    lets most rows pass where they are read, and only the rest are hashed again and shuffled.
    """
    rows = digests(docs, id_col, text_col)
    found = materialise(exact_dedup(rows))
    release(rows)
    removed = materialise(found.where("not kept").select(F.col("doc_id").alias("_sw_id")).distinct())
    keep = found.where("kept").select(F.col("doc_id").alias("_sw_id"), F.col("text_sha256").alias("_sw_sha"))
    tagged = docs.withColumn("_sw_id", F.col(f"`{id_col}`"))
    maybe, sure = parted(tagged, "_sw_id", removed.where("_sw_id is not null"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    # rows that share an id with one that goes, or have none: told apart by their texts
    unsure = maybe.unionByName(sure.where("_sw_id is null"))
    unsure = unsure.withColumn("_sw_sha", F.sha2(normalised(F.col(f"`{text_col}`")).cast("binary"), 256))
    same = F.col("_sw_id").eqNullSafe(F.col("_sw_other")) & (F.col("_sw_sha") == F.col("_sw_that"))
    stay = unsure.join(keep.withColumnsRenamed({"_sw_id": "_sw_other", "_sw_sha": "_sw_that"}), same, "left_semi")
    one = F.min_by(F.struct(*names), F.to_json(F.struct(*names), {"ignoreNullFields": "false"})).alias("_sw_row")
    once = stay.groupBy("_sw_id", "_sw_sha").agg(one).select(*[F.col("_sw_row").getField(c).alias(c) for c in docs.columns])
    return sure.where("_sw_id is not null").select(*names).unionByName(once)
