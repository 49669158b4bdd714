"""What several operators of this package share: scratch tables and hashing of words."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space, the only separators of words: \x20 and \x09-\x0D.
WHITE = " \t\n\x0b\f\r"

_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    In local mode, where there is one machine, a session that names none gets a folder of this process; on a
    cluster that is an error, as executors could not see it.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="siltworks-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def _folder(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut by files that outlive an executor.

    The files are deleted by :func:`release`, or else when the JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/siltworks-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where, fs = _folder(spark, path)
    fs.deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete the files of materialised tables of which all that was made is written itself."""
    for table in tables:
        where, fs = _folder(table.sparkSession, table._scratch)
        fs.delete(where, True)


#: Row hashes for sampling are whole numbers below this.
HASHES = 1 << 62


def keep_below(sample: int, n: int) -> int:
    """The bound below which the hashes of about ``sample`` of ``n`` rows lie: never 0, however large ``n``."""
    return HASHES if n <= sample else max(1, sample * HASHES // n)


def bounded_sample(rows: DataFrame, sample: int, *key) -> DataFrame:
    """About ``sample`` of the distinct ``rows``, those whose ``key`` columns hash lowest; all if there are no more.

    The same rows are drawn in every run.  At least one row is drawn if there is any: the bound is never below
    the least hash.  Rows that repeat another in full are drawn as one.
    """
    own = F.shiftrightunsigned(F.xxhash64(*key), 2)
    n, least = rows.agg(F.count("*"), F.min(own)).first()
    if n <= sample:
        return rows
    return rows.where(own < F.lit(max(keep_below(sample, n), least + 1))).distinct()


def whole_ids(df: DataFrame, *columns: str) -> None:
    """Refuse id columns that aren't whole numbers: components are named by the smallest of their ids."""
    for c in columns:
        kind = df.schema[c].dataType
        if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            raise TypeError(f"{c} must hold whole numbers of at most 64 bits, not {kind.simpleString()}")


def _hashable(kind: T.DataType) -> bool:
    return not any(x in kind.simpleString() for x in ("map<", "variant", "interval"))


def row_hash(df: DataFrame):
    """A 64-bit hash of all columns of a row; maps and variants by their JSON."""
    return F.xxhash64(*[F.col(f"`{f.name}`") if _hashable(f.dataType) else F.to_json(F.struct(F.col(f"`{f.name}`"))) for f in df.schema.fields])


def _mapped(rows: DataFrame, key: str, ids: DataFrame):
    """``rows`` with their place in a bitmap of hashed ids, the bitmap, and whether the place is set.

    The bitmap has at most 2**27 bits (16 MB), whatever the input.
    """
    n = ids.count()
    bits = 1 << min(27, max(15, (16 * n).bit_length()))
    size = 1 << 15  # bits of one row of the bitmap

    def bit(c):
        return F.pmod(F.xxhash64(c), F.lit(bits))

    maps = ids.select(bit(F.col(key)).alias("_sw_bit"))
    maps = maps.groupBy((F.col("_sw_bit") / size).cast("int").alias("_sw_part")).agg(F.bitmap_construct_agg(F.col("_sw_bit") % size).alias("_sw_map"))
    tagged = rows.withColumn("_sw_bit", bit(F.col(key))).withColumn("_sw_part", (F.col("_sw_bit") / size).cast("int"))
    place = F.col("_sw_bit") % size
    byte = F.conv(F.hex(F.substring("_sw_map", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.expr("1").cast("int") == F.when(byte.isNull(), 0).otherwise(F.getbit(byte, (place % 8).cast("int")).cast("int"))
    return tagged, maps, hit


def semi_join(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The ``rows`` whose ``key`` is among the distinct, written ``ids`` (one column, that name).

    Most of the other rows never reach a shuffle: a bitmap of the ids is broadcast first.  A fuller bitmap
    lets more rows through, never fewer.
    """
    tagged, maps, hit = _mapped(rows, key, ids)
    maybe = tagged.join(F.broadcast(maps), "_sw_part").where(hit).select(*rows.columns)
    return maybe.join(ids, key, "left_semi")


def parted(rows: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` may be among the distinct, written ``ids``, rows whose key surely isn't), by the bitmap alone.

    Nothing is shuffled; all rows of one key are on the same side, null keys on the second.
    """
    tagged, maps, hit = _mapped(rows, key, ids)
    seen = tagged.join(F.broadcast(maps), "_sw_part", "left").withColumn("_sw_hit", F.col("_sw_map").isNotNull() & F.coalesce(hit, F.lit(False)) & F.col(key).isNotNull())
    return seen.where("_sw_hit").select(*rows.columns), seen.where("not _sw_hit").select(*rows.columns)


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Bound the Arrow batches that Python workers get by their bytes, as texts may be long.

    The setting is read when a plan runs, so it stays in the session; a bound of the session's own is kept.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, "64m") in ("64m", "67108864b", str(1 << 26)):  # unless the session has a bound of its own
        spark.conf.set(key, size)


def normalised(text):
    """``text`` with every run of ASCII white space as one space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def n_words(text):
    """How many runs of other characters than ASCII white space ``text`` holds, without building them."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(marks, WHITE, "")).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on arrays."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MULT = np.uint64(0x5851F42D4C957F2D)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    filled, b = 1, np.uint64(base)
    step = int(b)
    while filled < n:
        take = min(filled, n - filled)
        out[filled : filled + take] = out[:take] * np.uint64(step)
        filled += take
        step = step * step & int(_MASK)
    return out


class WordHasher:
    """64-bit hashes of all words of a block of texts, by prefix sums over its bytes.

    A word's hash is sum(table[byte] * m**i) over its own positions i, finalised;
    equal words hash alike wherever they stand.
    """

    def __init__(self) -> None:
        self._up = self._down = np.empty(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._up) < n:
            n = max(n, 1 << 16, 2 * len(self._up))
            self._up, self._down = _powers(int(_MULT), n), _powers(_inverse(int(_MULT)), n)

    def __call__(self, data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start, end) of each run of true ``is_word`` in the bytes ``data``."""
        edge = np.diff(np.concatenate(([0], is_word.view(np.int8), [0])))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(start):
            return np.empty(0, np.uint64), start, end
        self._grow(len(data) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * self._up[: len(data)], dtype=np.uint64)))
        h = (total[end] - total[start]) * self._down[start]
        return mix64(h + (end - start).astype(np.uint64)), start, end


_IS_WORD = np.ones(256, bool)
_IS_WORD[[ord(c) for c in WHITE]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Blocks:
    """Texts of an Arrow column in blocks of about ``size`` bytes, each as one byte array.

    Yields (first row, end row, bytes, offsets): row ``first + i`` has bytes[offsets[i]:offsets[i+1]],
    of which the last is a separating space.  One text longer than a block is a block of its own.
    """

    def __init__(self, size: int = 1 << 18) -> None:
        self.size = size

    def __call__(self, column):
        import pyarrow as pa

        column = column.cast(pa.large_binary()).fill_null(b"")
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        if not len(column):
            return
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        first = 0
        while first < len(column):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + self.size)))
            last = min(last, len(column))
            n = last - first
            own = offsets[first : last + 1] - offsets[first]
            at = own + np.arange(n + 1)
            data = np.full(int(at[-1]), 32, np.uint8)
            keep = np.ones(len(data), bool)
            keep[at[1:] - 1] = False
            data[keep] = raw[offsets[first] : offsets[last]]
            yield first, last, data, at
            first = last


def word_hashes(hasher: WordHasher, data: np.ndarray, at: np.ndarray, lower: bool = True):
    """(hash, row) of each word of a block; rows count from 0."""
    data = LOWER[data] if lower else data
    h, start, _ = hasher(data, _IS_WORD[data])
    return h, np.searchsorted(at, start, "right") - 1


def shingles(h: np.ndarray, row: np.ndarray, n_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the distinct ``width``-word shingles of each row, sorted by row, then hash.

    A row with fewer words has its whole sequence as its one shingle; one without words has none.
    """
    count = np.bincount(row, minlength=n_rows)
    begin = np.concatenate(([0], np.cumsum(count)))
    mult = [np.uint64(0x9E3779B97F4A7C15 * (2 * i + 3) & int(_MASK) | 1) for i in range(width)]
    out, rows = [], []
    if len(h) >= width:
        whole = row[width - 1 :] == row[: len(row) - width + 1]
        total = np.zeros(len(h) - width + 1, np.uint64)
        for i in range(width):
            total += h[i : len(h) - width + 1 + i] * mult[i]
        out.append(mix64(total[whole]))
        rows.append(row[: len(total)][whole])
    for n in range(1, width):
        short = np.flatnonzero(count == n)
        if len(short):
            total = np.full(len(short), n, np.uint64)
            for i in range(n):
                total += h[begin[short] + i] * mult[i]
            out.append(mix64(total * np.uint64(0xD6E8FEB86659FD93)))
            rows.append(short)
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    s, r = np.concatenate(out), np.concatenate(rows)
    order = np.lexsort((s, r))
    s, r = s[order], r[order]
    fresh = np.ones(len(s), bool)
    fresh[1:] = (s[1:] != s[:-1]) | (r[1:] != r[:-1])
    return s[fresh], r[fresh]
