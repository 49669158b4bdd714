"""Near-duplicate vectors: p-stable hashing, exact cosine checks, components.

Vectors are normalised; each of ``tables`` tables quantises ``bits`` Gaussian projections with a random
shift (the Euclidean p-stable family), and the cells of one table are its buckets.  Identical vectors are
one class and go on once, with their number.  The number of projections grows with the vectors of the largest
label, so that the expected number of unrelated vectors in a bucket stays bounded, and the number of tables
with it, so that as few links are missed.  Within a bucket all cosines are taken in blocks of a bounded
number of rows; a bucket with more rows is dealt out as pairs of blocks.  What leaves a block is a count per
vector and a spanning forest, never the pairs.  A pair counts in the first table in which it meets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, mix64, release, whole_ids
from .components import components, spanning

#: Rows of a block: a bucket with more is split.
BLOCK = 1024
#: Unrelated vectors of a label that are expected in one bucket, at most.
STRANGERS = 512


def collision(distance: float, width: float) -> float:
    """The chance that two points fall into one cell of a Gaussian projection, by their distance and the cells' width."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - math.sqrt(2 / math.pi) / r * (1 - math.exp(-r * r / 2))


def tables_for(n: int, least: float, width: float = 2.0, miss: float = 1e-3) -> tuple[int, int]:
    """(tables, projections) for ``n`` vectors that may be linked.

    Orthogonal vectors meet in a bucket with at most ``STRANGERS`` others; a pair with the cosine ``least`` meets
    in no table with a chance of at most ``miss``.  Fewer projections need fewer tables: cosines within a bucket
    cost less than a vector's way to another one.
    """
    near, far = collision(max(math.sqrt(2 - 2 * least), 1e-9), width), collision(math.sqrt(2), width)
    bits = max(1, math.ceil(math.log(max(n, 1) / STRANGERS) / -math.log(far)))
    return max(1, math.ceil(math.log(miss) / math.log1p(-min(near**bits, 1 - 1e-12)))), bits


def _hash_family(dim: int, tables: int, bits: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.standard_normal((dim, tables * bits)) / width, rng.random(tables * bits)


def _cells(unit: np.ndarray, tables: int, bits: int, width: float, seed: int) -> np.ndarray:
    """An int32 per row and table that names the row's cell there."""
    a, b = _hash_family(unit.shape[1], tables, bits, width, seed)
    grid = np.floor(unit @ a + b).astype(np.int64).view(np.uint64).reshape(len(unit), tables, bits)
    out = np.zeros((len(unit), tables), np.uint64)
    for i in range(bits):
        out = mix64(out + grid[:, :, i] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i + 1))
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _matrix(column) -> tuple[np.ndarray, np.ndarray]:
    """For each length of vectors: the numbers of its rows, and these as a matrix of doubles (null components as NaN)."""
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.asarray(column.value_lengths().fill_null(0))
    for dim in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == dim)
        values = column.take(pa.array(rows)).flatten().cast(pa.float64()).fill_null(np.nan)
        yield rows, np.asarray(values).reshape(len(rows), dim) + 0.0


def _unit(values: np.ndarray) -> np.ndarray:
    """Rows at length 1, in doubles; scaled first, so that squares neither overflow nor vanish."""
    with np.errstate(all="ignore"):
        scaled = values / np.abs(values).max(1, keepdims=True)
        return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, single: bool) -> DataFrame:
    """vec_id, label, vec (its bytes, null if the vector links with nothing), d1 and d2 (identify the vector)."""

    def run(batches: Iterator):
        import hashlib

        import pyarrow as pa

        for batch in batches:
            vec: list = [None] * batch.num_rows
            d1, d2 = [None] * batch.num_rows, [None] * batch.num_rows
            label = batch.column(1).is_valid().to_pylist()
            for rows, values in _matrix(batch.column(2)):
                good = np.isfinite(values).all(1) & np.isfinite(_unit(values)).all(1)
                raw = values.astype(np.float32) if single else values
                for r, ok, v in zip(rows, good, raw, strict=True):
                    if ok and label[r]:
                        vec[r] = v.tobytes()
                        h = hashlib.blake2b(vec[r], digest_size=16).digest()
                        d1[r], d2[r] = int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(vec, pa.binary()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64())], names=["vec_id", "label", "vec", "d1", "d2"]
            )

    kind = "array<float>" if single else "array<double>"
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast(kind).alias("v"))
    return rows.mapInArrow(run, "vec_id bigint, label string, vec binary, d1 bigint, d2 bigint")


def _rows(raw: list[bytes], single: bool):
    """For each length: the numbers of its rows, and these at length 1."""
    kind = np.float32 if single else np.float64
    size = np.array([len(x) for x in raw], np.int64)
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        values = np.frombuffer(b"".join(raw[r] for r in rows), kind).reshape(len(rows), -1)
        yield rows, _unit(values.astype(np.float64))


def _keyed(tables: int, bits: int, width: float, seed: int, single: bool):
    """Representatives -> with their cells in all tables, and the keys of their buckets."""

    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            salt = np.array([_text_hash(x) for x in batch.column(3).to_pylist()], np.uint64)
            cells = np.zeros((batch.num_rows, tables), np.int32)
            for rows, unit in _rows(batch.column(4).to_pylist(), single):
                cells[rows] = _cells(unit, tables, bits, width, seed)
                salt[rows] += np.uint64(unit.shape[1])
            step = np.array([(t + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1 for t in range(tables)], np.uint64)
            key = mix64((mix64(salt)[:, None] ^ cells.view(np.uint32).astype(np.uint64)) + step).view(np.int64)
            keys = pa.ListArray.from_arrays(pa.array(np.arange(0, key.size + 1, tables, dtype=np.int32)), pa.array(key.ravel()))
            packed = pa.array([c.tobytes() for c in cells], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, packed, keys], names=["rep", "d1", "copies", "label", "vec", "cells", "keys"])

    return run


def _text_hash(s: str) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little")


def _compare(least: float, tables: int, single: bool):
    """Rows sorted by (key, i, j) -> (node, root, links) of each group of rows with one (key, i, j)."""

    def settle(group):
        key, own, t, rep, copies, vec, cells = group
        edge = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(1), [True])))
        x, y = [], []
        starts, sizes = edge[:-1], np.diff(edge)
        small = sizes <= 48
        # small groups together: each row with the one `s` rows further on, if that is in its group
        last = np.repeat(np.where(small, edge[1:], 0), sizes)
        place = np.arange(len(key))
        for s in range(1, 1 + int(sizes[small].max(initial=1))):
            a = place[place + s < last]
            if not len(a):
                break
            near = np.einsum("ij,ij->i", vec[a], vec[a + s]) >= least
            x.append(a[near])
            y.append(a[near] + s)
        for b, n in zip(starts[~small], sizes[~small], strict=True):
            i, j = np.nonzero(np.triu(vec[b : b + n] @ vec[b : b + n].T >= least, 1))
            x.append(b + i)
            y.append(b + j)
        x, y = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (x, y))
        # of two blocks only pairs across them; a pair found in an earlier table has been counted there
        across = (key[x, 1] == key[x, 2]) | (own[x] != own[y])
        x, y = x[across], y[across]
        fresh = np.ones(len(x), bool)
        for k in range(tables):
            fresh &= (t[x] <= k) | (cells[x, k] != cells[y, k])
        fx, fy = x[fresh], y[fresh]
        node = np.concatenate((rep[fx], rep[fy]))
        links = np.concatenate((copies[fy], copies[fx]))
        ids, flat = np.unique(node, return_inverse=True)
        total = np.bincount(flat, links, len(ids)).astype(np.int64)
        below, root = spanning(rep[fx], rep[fy])
        return ids, total, below, root

    def run(batches: Iterator):
        import pyarrow as pa

        def out(group):
            ids, total, below, root = settle(group)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((ids, below))), pa.array(np.concatenate((ids, root))), pa.array(np.concatenate((total, np.zeros(len(below), np.int64))))], names=["node", "root", "links"]
            )

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([np.asarray(batch.column(i)).astype(np.int64) for i in range(3)], 1)
            raw = batch.column(7).to_pylist()
            units = list(_rows(raw, single))
            vec = np.zeros((len(raw), max(unit.shape[1] for _, unit in units)))
            for rows, unit in units:
                vec[rows, : unit.shape[1]] = unit
            cells = np.frombuffer(b"".join(batch.column(8).to_pylist()), np.int32).reshape(len(raw), tables)
            now = [key, *(np.asarray(batch.column(i)) for i in (3, 4, 5, 6)), vec, cells]
            if held is not None:
                w = max(held[5].shape[1], vec.shape[1])
                pad = lambda v, w=w: np.pad(v, ((0, 0), (0, w - v.shape[1])))
                held[5], now[5] = pad(held[5]), pad(now[5])
                now = [np.concatenate((a, b)) for a, b in zip(held, now, strict=True)]
            cut = len(now[0]) - 1
            same = np.flatnonzero((now[0] != now[0][-1]).any(1))
            cut = int(same[-1]) + 1 if len(same) else 0
            held = [v[cut:] for v in now]
            if cut:
                yield from out([v[:cut] for v in now])
        if held is not None:
            yield from out(held)

    return run


def near_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = 0.93,
    tables: int | None = None,
    bits: int | None = None,
    width: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors with equal labels, not null, are linked by a cosine of at least ``least``, in doubles.  Without
    ``tables`` and ``bits`` these follow the number of different vectors of the largest label
    (:func:`tables_for`); a pair at ``least`` is missed once in a thousand and closer pairs less often.  A pair
    that is found is linked by its exact cosine.  Ids are whole numbers; an empty table gives no rows.  Null or zero vectors, and those with null or non-finite
    components, link with nothing; vectors of different lengths are not compared.  Repeated rows are vectors
    of their own that are linked; rows that share an id share the links of all its vectors; a null id gets
    a null component unless its class has another id.
    """
    whole_ids(vectors, id_col)
    single = "double" not in vectors.schema[vector_col].dataType.simpleString()
    base = materialise(classes(vectors, id_col, vector_col, label_col, single))
    rows = base.where("vec is not null")
    same = rows.groupBy("label", "d1", "d2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("vec").alias("vec"))
    if not (tables and bits):
        largest = same.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        tables, bits = tables_for(largest, least, width)
    reps = same.where("rep is not null").select("rep", "d1", "copies", "label", "vec")
    schema = "rep bigint, d1 bigint, copies bigint, label string, vec binary, cells binary, keys array<bigint>"
    reps = materialise(reps.mapInArrow(_keyed(tables, bits, width, seed, single), schema))
    keyed = reps.select("rep", "d1", F.posexplode("keys").alias("t", "key"))
    counts = keyed.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1")
    met = keyed.join(counts, "key").withColumn("_of", F.ceil(F.col("_n") / BLOCK).cast("int"))
    met = met.withColumn("_own", F.pmod(F.xxhash64("rep"), F.col("_of")).cast("int"))
    met = met.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_of") - 1)))
    met = met.select("key", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), "_own", "t", "rep", "d1")
    # only now, and only to buckets with several members, the vectors themselves
    met = met.join(reps.select("rep", "d1", "copies", "vec", "cells"), ["rep", "d1"]).select("key", "i", "j", "_own", "t", "rep", "copies", "vec", "cells")
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = met.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_compare(least, tables, single), "node bigint, root bigint, links bigint")
    found = materialise(found)
    release(reps)
    links = found.groupBy(F.col("node").alias("rep")).agg(F.sum("links").alias("_links"))
    tree = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    of = same.drop("vec").join(links, "rep", "left").join(tree.withColumnRenamed("node", "rep"), "rep", "left")
    of = of.select("label", "d1", "d2", (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("_n"), F.coalesce("component", "rep").alias("_c"))
    whole = base.drop("vec").join(of, ["label", "d1", "d2"], "left")
    return whole.select("vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_c", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
