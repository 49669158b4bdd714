"""Mixing sources to target weights along a time-varying curriculum.

Every source has a schedule of weights over nominal time 0..1, linear between knots.  Its integral is the
source's weight in the whole mix; sizes are shared by these weights, and no source is asked for more than
``max_repeats`` times what it has (the excess is shared again by weight: water-filling, in closed form over
the sorted ratios).  A source's documents stand in a fixed pseudo-random order and are read epoch after
epoch until its target is met.  The word at which a document starts is demanded at the time found by
inverting the integral of its source's schedule; all sources together have then demanded D(time) words, the
sum of their integrals, each scaled to its target.  D is the document's training position, as a share of the
whole mix: at position x, the share x of all words has been read.  A range sort by position then gives the
training order.

Cumulative sizes are prefix sums in two levels (buckets of the order within a source, then rows within a
bucket), so that a source with a third of all rows is still spread over many tasks.  The table of sources,
one row each, is settled in one task.  All DataFrame code.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, n_words, row_hash

Schedule = Sequence[tuple[float, float]]
_PIECES = "array<struct<y0:double,t0:double,w0:double,slope:double>>"
STEADY: Schedule = ((0.0, 1.0),)


def integrate(schedule: Schedule) -> tuple[float, list[tuple[float, float, float, float]]]:
    """The integral over 0..1 of a piecewise-linear schedule, and (integral, t, weight, slope) at each knot."""
    knots = sorted((float(t), float(w)) for t, w in schedule)
    if not knots or any(w < 0 or not math.isfinite(w) for _, w in knots) or any(not 0 <= t <= 1 for t, _ in knots):
        raise ValueError("a schedule needs knots with 0 <= t <= 1 and finite weights >= 0")
    knots = [(0.0, knots[0][1]), *knots, (1.0, knots[-1][1])]
    pieces, y = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        if t1 > t0:
            if w0 + w1 > 0:
                pieces.append((y, t0, w0, (w1 - w0) / (t1 - t0)))
            y += (w0 + w1) / 2 * (t1 - t0)
    return y, pieces


def demand(schedule: Schedule, times: Sequence[float]) -> list[tuple[float, float, float]]:
    """(share of the integral met, its rate, the rate's slope) from each of ``times`` on; no knot lies between two of them."""
    area, pieces = integrate(schedule)
    out = []
    for t in times:
        past = [p for p in pieces if p[1] <= t]
        if not past or not area:
            out.append((0.0, 0.0, 0.0))
            continue
        y0, t0, w0, slope = past[-1]
        w = w0 + slope * (t - t0)
        after = min([x for x in [*(k for k, _ in schedule), 1.0] if x > t], default=1.0)
        if w + slope * (after - t) <= 0 and w <= 0:  # this piece is over, the weight is zero until another begins
            out.append((min(1.0, (y0 + (w0 + w) / 2 * (t - t0)) / area), 0.0, 0.0))
        else:
            out.append(((y0 + (w0 + w) / 2 * (t - t0)) / area, w / area, slope / area))
    return out


def _schedules(spark, cycle: Sequence[float | Schedule], schedules: Mapping[str | None, Schedule]) -> tuple[DataFrame, DataFrame, list[float]]:
    """Tables of the schedules by rank in the cycle and by source, each with weight, pieces and demand, and all times at which one has a knot."""
    own = [STEADY if isinstance(c, (int, float)) else c for c in cycle]
    times = sorted({0.0, *(float(t) for c in [*own, *schedules.values()] for t, _ in c if t < 1)})
    given = f"weight double, area double, pieces {_PIECES}, met array<struct<y:double,w:double,slope:double>>"

    def row(schedule: Schedule, weight: float | None = None) -> tuple:
        area, pieces = integrate(schedule)
        return (area if weight is None else float(weight), area, pieces, demand(schedule, times))

    ranks = [(i, *row(s, c if isinstance(c, (int, float)) else None)) for i, (c, s) in enumerate(zip(cycle, own, strict=True))]
    named = [(s, *row(knots)) for s, knots in schedules.items()]
    return spark.createDataFrame(ranks, f"place int, {given}"), spark.createDataFrame(named, f"own string, {given}"), times


def _targets(sources: DataFrame, cycle: Sequence[float | Schedule], schedules: Mapping[str | None, Schedule], max_repeats: int) -> DataFrame:
    """Per source: weight, target, quota (its target in whole words), the pieces of its schedule, and those of the whole demand."""
    by_code_point = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sources.withColumn("rank", F.row_number().over(by_code_point) - 1)
    ranks, named, times = _schedules(sources.sparkSession, cycle, schedules)
    # both are as large as the parameters
    ranked = ranked.withColumn("place", F.col("rank") % len(cycle)).join(F.broadcast(ranks), "place")
    ranked = ranked.join(F.broadcast(named.select("own", F.struct("weight", "area", "pieces", "met").alias("given"))), F.col("source").eqNullSafe(F.col("own")), "left")
    ranked = ranked.withColumns({c: F.coalesce(F.col("given")[c], F.col(c)) for c in ("weight", "area", "pieces", "met")})
    cap = F.col("source_size") * max_repeats
    ranked = ranked.withColumn("ratio", F.when(F.col("weight") > 0, cap / F.col("weight")).otherwise(F.lit(math.inf)))
    every = Window.orderBy("ratio", "rank")
    before = every.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    level = ranked.withColumns(
        {
            "total": F.sum("source_size").over(all_rows),
            "left_weight": F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
            "full": F.coalesce(F.sum(cap).over(before), F.lit(0)),
        }
    ).withColumn("level", F.when(F.col("left_weight") > 0, (F.col("total") - F.col("full")) / F.col("left_weight")))
    # sources in order of their ratio are full until one stands above the water level
    level = level.withColumn("open", F.col("level") <= F.col("ratio"))
    water = level.withColumn("water", F.min(F.when(F.col("open"), F.struct("ratio", "rank", "level"))).over(all_rows)["level"])
    target = F.when(F.col("weight") > 0, F.least(cap.cast("double"), F.coalesce("water", F.lit(math.inf)) * F.col("weight"))).otherwise(0.0)
    planned = water.withColumn("target", target).withColumn("quota", F.floor(F.col("target") + 0.5))

    def of_all(k: int, name: str):
        return F.sum(F.col("quota") * F.col("met")[k][name]).over(all_rows)

    whole = F.array(*[F.struct(F.lit(t).alias("t0"), of_all(k, "y").alias("y0"), of_all(k, "w").alias("w0"), of_all(k, "slope").alias("slope")) for k, t in enumerate(times)])
    return planned.select("skey", "source_size", "target", "quota", "area", "pieces", whole.alias("whole"), F.sum("quota").over(all_rows).alias("words"))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cycle: Sequence[float | Schedule] = (1, 2, 3),
    schedules: Mapping[str | None, Schedule] | None = None,
    max_repeats: int = 3,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken, positions, and the columns ``carry``.

    ``cycle`` gives weights, or schedules of knots (time, weight), to the sources by code point (null last),
    repeating; ``schedules`` does so for sources by name.  ``positions`` are the training positions in 0..1 at
    which the document starts, one per epoch it is taken in; the document at which a source's quota ends
    is taken in part, so a source's ``taken`` add up to its target to the nearest word.

    Null and empty texts have size 0 and are never taken; repeated rows count each; an empty table gives
    no rows; a table whose texts are all empty has targets 0.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").alias("source"),
        n_words(F.col(f"`{text_col}`")).alias("size"),
        F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")).alias("_order"),
        *carry,
    ).withColumn("skey", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    rows = materialise(rows)
    digits = min(4, max(2, math.ceil(math.log(max(rows.count(), 1) / 4096 + 1, 16))))
    rows = rows.withColumn("bucket", F.substring("_order", 1, digits))
    sums = rows.groupBy("skey", "bucket").agg(F.sum("size").alias("n"), F.first("source").alias("source"))
    sums = materialise(sums)
    sources = sums.groupBy("skey").agg(F.sum("n").alias("source_size"), F.first("source").alias("source"))
    along = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("skey", "bucket", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("base"))
    plan = starts.join(_targets(sources, cycle, schedules or {}, max_repeats), "skey")
    within = Window.partitionBy("skey", "bucket").orderBy("_order", "doc_id", "size", *carry).rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("upto", F.sum("size").over(within)).join(plan, ["skey", "bucket"])
    placed = placed.withColumn("at", F.col("base") + F.col("upto") - F.col("size"))
    takes = [F.greatest(F.lit(0), F.least("size", F.col("quota") - F.col("at") - e * F.col("source_size"))) for e in range(max_repeats)]
    placed = placed.withColumn("taken", sum(takes[1:], takes[0]).cast("long"))

    def time(e: int):
        """When the source's schedule has demanded the words before this one: the integral's inverse."""
        y = (F.col("at") + e * F.col("source_size")) / F.col("quota") * F.col("area")
        piece = F.element_at(F.filter("pieces", lambda p: (p["y0"] <= y) | (p["t0"] <= 0)), -1)
        more = F.greatest(y - piece["y0"], F.lit(0.0))
        root = F.sqrt(F.greatest(piece["w0"] * piece["w0"] + 2 * piece["slope"] * more, F.lit(0.0)))
        return F.when(takes[e] > 0, F.when(more > 0, piece["t0"] + 2 * more / (piece["w0"] + root)).otherwise(piece["t0"]))

    def position(t):
        """The share of all words that all sources together have demanded by then."""
        piece = F.element_at(F.filter("whole", lambda p: p["t0"] <= t), -1)
        more = t - piece["t0"]
        return (piece["y0"] + (piece["w0"] + piece["slope"] * more / 2) * more) / F.col("words")

    times = F.array_compact(F.array(*[time(e) for e in range(max_repeats)]))
    return placed.select("doc_id", "source", "size", "source_size", "target", "taken", F.transform(times, position).alias("positions"), *carry)


def training_order(mixed: DataFrame) -> DataFrame:
    """The mix as it is read: one row per document and epoch, range-sorted by ``position``."""
    return mixed.select("doc_id", "source", "size", F.posexplode("positions").alias("epoch", "position")).orderBy("position", "doc_id")


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` as the mix reads them: each once per epoch in which it is taken, range-sorted by position.

    Rows that the mix does not take are left out; the document at which a source's quota ends is kept whole.
    Rows are told apart by all their columns; those that are alike in all share their places.  Null and empty
    texts are never taken; an empty table gives no rows.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    key = F.concat_ws("/", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), row_hash(docs).cast("string"))
    tagged = docs.withColumn("_sw_key", key)
    mixed = mix(tagged, id_col=id_col, text_col=text_col, source_col=source_col, carry=["_sw_key"], **options).select("_sw_key", "positions")
    places = mixed.groupBy("_sw_key").agg(F.flatten(F.collect_list("positions")).alias("_sw_positions"), F.count("*").alias("_sw_n"))
    places = materialise(places)
    if not places.where("_sw_n > 1").isEmpty():  # rows repeated in full
        tagged = tagged.dropDuplicates(["_sw_key"])
    taken = tagged.join(places.where(F.size("_sw_positions") > 0), "_sw_key").withColumn("_sw_at", F.explode("_sw_positions"))
    return taken.orderBy("_sw_at", "_sw_key").select(*names)
