"""Near-duplicate documents by SuperMinHash, banding, exact verification and union-find.

Signatures: each shingle seeds a pseudo-random permutation of the components, built one step at a time; at
step j it offers ``r + j`` to one component.  Ranks of one element are thus spread over all components
(lower variance than independent hashing), and a set stops as soon as no later step can lower any minimum.

Documents with the same set form a class, of which only the smallest id goes on.  Classes that agree in a
band meet in its bucket.  In every bucket all classes are compared with the bucket's smallest one, on full
sets, so large groups of copies cost one comparison a member.  Classes of a bucket that are then still in
different components are compared with one another, in blocks, by bitmaps of their sets: each bit in which
two bitmaps differ proves an element that only one set has, so a pair with too many such bits is no link.
The few pairs that are left are compared on full sets.  No link between classes that meet is lost.

Sets are sets of 64-bit hashes of shingles; two shingles that collide would count as one.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Blocks, WordHasher, materialise, mix64, release, semi_join, shingles, small_batches, whole_ids, word_hashes
from .components import components

_STEP = np.uint64(0x9E3779B97F4A7C15)


def super_minhash(s: np.ndarray, row: np.ndarray, n_rows: int, m: int, chunk: int = 1 << 15) -> np.ndarray:
    """The signatures (n_rows, m) of sets given as (element hash, row), sorted by row; inf for empty sets."""
    best = np.full((n_rows, m), np.inf)
    flat = best.ravel()
    for begin in range(0, len(s), chunk):
        seed, of = s[begin : begin + chunk], row[begin : begin + chunk].astype(np.int64)
        order = np.tile(np.arange(m, dtype=np.uint16), (len(seed), 1))  # each element's permutation so far
        live = np.arange(len(seed))
        first, last = int(of[0]), int(of[-1]) + 1
        for j in range(m):
            worst = best[first:last].max(1)
            live = live[worst[of[live] - first] > j]
            if not len(live):
                break
            z = mix64(seed[live] + np.uint64(int(_STEP) * (j + 1) & (1 << 64) - 1))
            rank = (z >> np.uint64(11)) * 2.0**-53
            k = j + ((z & np.uint64(0xFFFFFFFF)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
            chosen = order[live, k]
            order[live, k] = order[live, j]
            np.minimum.at(flat, of[live] * m + chosen, rank + j)
    return best


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per row and band; keys of different bands differ."""
    n, m = signatures.shape
    parts = signatures.view(np.uint64).reshape(n, bands, m // bands)
    out = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, (n, 1))
    for i in range(m // bands):
        out = mix64(out ^ parts[:, :, i]) + _STEP
    return out


def banding(percent: int) -> tuple[int, int]:
    """(bands, rows) that miss a link at ``percent`` once in 10**7 at most; from 80 on, 40 bands of 5."""
    if not 1 <= percent <= 100:
        raise ValueError("percent is a whole number from 1 to 100")
    if percent >= 80:
        return 40, 5
    for rows in (4, 3, 2, 1):
        bands = math.ceil(math.log(1e-7) / math.log(1 - (percent / 100) ** rows))
        if bands <= 64 or rows == 1:
            return bands, rows
    raise AssertionError


#: Rows of a block in which all pairs are compared by bitmaps; a bucket with more is split.
BLOCK = 1024


def bitmap(s: np.ndarray) -> bytes:
    """A set's elements modulo a power of two between 6 and 12 times their number, as bits."""
    bits = np.zeros(max(64, 1 << int(6 * len(s) - 1).bit_length()), bool)
    bits[(s & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _plain(column) -> list:
    """A column's values; of lists of keys, their bytes."""
    import pyarrow as pa

    if not pa.types.is_list(column.type):
        return column.to_pylist()
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return [k.tobytes() for k in flat]


def _far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many bits the rows of ``y`` (uint64 words) differ from the row ``x``."""
    return np.bitwise_count(y ^ x).sum(1, dtype=np.int64)


def _maybe(percent: int):
    """Rows sorted by (key, i, j) -> pairs of a group, in different components, that the bitmaps can't rule out."""

    reach = 1 << math.ceil(math.log2(100 / percent))  # sets that are similar enough have bitmaps at most so many times as wide

    def pairs(t, ids, n, component, own, crossing, bands, maps):
        wide = np.array([len(m) for m in maps])
        for w in np.unique(wide):
            here = np.flatnonzero(wide == w)
            near = np.flatnonzero((wide >= w) & (wide <= reach * w))
            words = np.array([np.bitwise_or.reduce(np.frombuffer(maps[k], np.uint64).reshape(wide[k] // w, -1)) for k in near])
            place = np.searchsorted(near, here)
            for k, at in zip(here, place, strict=True):
                rest = np.flatnonzero((near > k) | (wide[near] > w))
                other = near[rest]
                differ = (component[other] != component[k]) & (100 * np.minimum(n[other], n[k]) >= percent * np.maximum(n[other], n[k]))
                if crossing:
                    differ &= own[other] != own[k]
                if t:  # a pair that agrees in an earlier band meets there
                    differ &= ~(bands[other, :t] == bands[k, :t]).any(1)
                rest = rest[differ]
                if len(rest):
                    other = near[rest]
                    close = (100 + percent) * _far(words[at], words[rest]) <= (100 - percent) * (n[other] + n[k])
                    for o in other[close]:
                        yield min(ids[k], ids[o]), max(ids[k], ids[o])

    def run(batches: Iterator):
        import pyarrow as pa

        def out(rows):
            key = np.array([r[:3] for r in rows], np.int64)
            edge = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(1), [True])))
            found = set()
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                if b - a > 1:
                    _, i, j, own, t, ids, n, component, keys, maps = zip(*rows[a:b], strict=True)
                    bands = np.array([np.frombuffer(k, np.int64) for k in keys])
                    found.update(pairs(t[0], ids, np.array(n), np.array(component), np.array(own), i[0] != j[0], bands, maps))
            if found:
                x, y = zip(*sorted(found), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])

        held: list = []
        for batch in batches:
            held += zip(*(_plain(batch.column(k)) for k in range(10)), strict=True)
            if held:
                cut = len(held) - 1
                while cut and held[cut - 1][:3] == held[-1][:3]:
                    cut -= 1
                yield from out(held[:cut]) if cut else ()
                held = held[cut:]
        if held:
            yield from out(held)

    return run


def features(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n (size of the set), f1 and f2 (128 bits that identify the set), keys (one per band; none if empty), bits."""
    schema = "doc_id bigint, n bigint, f1 bigint, f2 bigint, keys array<bigint>, bits binary"

    def run(batches: Iterator):
        import pyarrow as pa

        hasher, blocks = WordHasher(), Blocks()
        for batch in batches:
            ids = batch.column(0)
            for first, last, data, at in blocks(batch.column(1)):
                size = last - first
                s, row = shingles(*word_hashes(hasher, data, at), size, words)
                n = np.bincount(row, minlength=size)
                edge = np.concatenate(([0], np.cumsum(n)))
                f = []
                for salt in (1, 2):
                    h = mix64(s * np.uint64(2 * salt + 1) + np.uint64(salt))
                    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h, dtype=np.uint64)))
                    f.append(mix64(total[edge[1:]] - total[edge[:-1]] + n.astype(np.uint64)).view(np.int64))
                keys = band_keys(super_minhash(s, row, size, bands * rows), bands).view(np.int64)
                offsets = np.concatenate(([0], np.cumsum(np.where(n > 0, bands, 0)))).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[n > 0].ravel()))
                own = ids.slice(first, size).cast(pa.int64())
                bits = pa.array([bitmap(s[a:b]) if b > a else None for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([own, pa.array(n), pa.array(f[0]), pa.array(f[1]), keys, bits], names=["doc_id", "n", "f1", "f2", "keys", "bits"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


@functools.lru_cache(1)
def _hasher() -> WordHasher:
    return WordHasher()


def _linked(words: int, percent: int):
    """Pairs with both texts -> the pairs whose full sets are similar enough."""

    def run(batches: Iterator):
        import pyarrow as pa

        last_text, last_set = None, None

        def as_set(text):
            data = np.frombuffer(text + b" ", np.uint8)
            return shingles(*word_hashes(_hasher(), data, np.array([0, len(data)])), 1, words)[0]

        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            left, right = (batch.column(i).cast(pa.large_binary()) for i in (2, 3))
            for i in range(batch.num_rows):
                text = left[i].as_py() or b""
                if text != last_text:
                    last_text, last_set = text, as_set(text)
                other = as_set(right[i].as_py() or b"")
                both = len(last_set) + len(other) - len(np.union1d(last_set, other))
                ok[i] = both and 100 * both >= percent * (len(last_set) + len(other) - both)
            yield batch.select([0, 1]).filter(pa.array(ok))

    return run


def verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) that are links, by their full sets; texts are fetched for these ids alone."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    ids = materialise(pairs.select(F.col("a").alias("_id")).unionByName(pairs.select(F.col("b").alias("_id"))).distinct())
    texts = materialise(semi_join(texts, "_id", ids))
    right = pairs.join(texts.withColumnsRenamed({"_id": "b", "_text": "tb"}), "b")
    full = right.join(texts.withColumnsRenamed({"_id": "a", "_text": "ta"}), "a").select("a", "b", "ta", "tb")
    return full.mapInArrow(_linked(words, percent), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    bands: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Two documents are linked if their sets of ``words``-word shingles overlap by at least ``percent`` % of
    their union.  Without ``bands`` and ``rows`` they follow ``percent`` (:func:`banding`): 40 bands of 5 miss
    a link at 0.85 once in 10**10, at 0.80 once in 10**7.  Words are runs of other characters than ASCII white
    space, with A-Z lower-cased.  Fewer words than a shingle make one shingle; without words a document is
    linked with nothing.  Ids are whole numbers.  Rows that share an id count as one document with the links
    of all their texts; a null id gets the component of its set's smallest id, and is kept if there is none.
    An empty table gives no rows; other columns aren't read.
    """
    whole_ids(docs, id_col)
    bands, rows = (bands, rows) if bands and rows else banding(percent)
    small_batches(docs.sparkSession)
    f = materialise(features(docs, id_col, text_col, words, bands, rows))
    sets = f.where("n > 0 and doc_id is not null")
    classes = materialise(sets.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")))
    reps = sets.select("doc_id", "n", "f1", "f2", F.col("keys")).join(classes.select("f1", "f2", F.col("rep").alias("doc_id")), ["f1", "f2", "doc_id"], "left_semi")
    member = reps.select(F.posexplode("keys").alias("t", "key"), F.col("doc_id").alias("id"), "n")
    shared = member.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("_top")).where("hub <> _top")
    member = materialise(member.join(shared.select("key", "hub"), "key"))

    def close(x: str, y: str):
        return 100 * F.least(x, y) >= percent * F.greatest(x, y)  # else the sets can't be similar enough

    hubs = member.where("id = hub").select("key", F.col("n").alias("hub_n"))
    tried = materialise(member.where("id <> hub").join(hubs, "key").where(close("n", "hub_n")).select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct())
    links = materialise(verified(tried, docs, id_col, text_col, words, percent))
    tree = materialise(components(links))

    # classes of one bucket that the hubs have not brought together
    named = member.join(tree.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = materialise(named.where("id <> hub").select("key", "t", "id", "n", "component"))
    apart = named.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"), F.count("*").alias("_n")).where("_lo <> _hi")
    named = named.join(apart.select("key", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_of")), "key")
    named = named.withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_of")).cast("int"))
    named = named.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_of") - 1)))
    named = named.select("key", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), "_own", "t", "id", "n", "component")
    named = materialise(named)
    ids = materialise(named.select(F.col("id").alias("doc_id")).distinct())
    maps = semi_join(sets.select("doc_id", "n", "keys", "bits"), "doc_id", ids).withColumnRenamed("doc_id", "id")
    blocks = named.join(maps, ["id", "n"]).select("key", "i", "j", "_own", "t", "id", "n", "component", "keys", "bits")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cross = blocks.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_maybe(percent), "a bigint, b bigint")
    cross = materialise(cross.where("a <> b").distinct().join(tried, ["a", "b"], "left_anti"))
    release(member, named, ids, tried, tree)

    # rows that share an id tie their sets together
    several = sets.groupBy("doc_id").agg(F.count("*").alias("_n")).where("_n > 1").select("doc_id")
    ties = sets.join(several, "doc_id").join(classes, ["f1", "f2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    more = materialise(verified(cross, docs, id_col, text_col, words, percent))  # a task with one Python worker at a time
    links = links.unionByName(more).unionByName(ties)
    tree = components(links)

    rep = classes.join(tree.withColumnRenamed("node", "rep"), "rep", "left")
    rep = rep.select("f1", "f2", F.coalesce("component", "rep").alias("_found"))
    whole = f.drop("keys", "short", "bits").join(rep, ["f1", "f2"], "left")
    component = F.when(F.col("n") > 0, F.col("_found")).otherwise(F.col("doc_id"))
    component = F.coalesce(component, F.col("doc_id"))
    return whole.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def drop_near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with their own columns, of the documents that :func:`near_duplicates` keeps: one of each group.

    Rows that share an id are one document and stay or go together.  Rows with a null id are one document per
    text, and come after all ids below 2**62 when it is settled which one stays.  Documents without words stay.
    """
    whole_ids(docs, id_col)
    own = F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.shiftrightunsigned(F.xxhash64(F.col(f"`{text_col}`")), 2) + F.lit(1 << 62))
    tagged = docs.withColumn("_sw_id", own)
    found = near_duplicates(tagged, id_col="_sw_id", text_col=text_col, **options)
    kept = materialise(found.where("kept").select(F.col("doc_id").alias("_sw_id")).distinct())
    return tagged.join(kept, "_sw_id", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
