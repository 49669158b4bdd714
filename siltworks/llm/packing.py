"""Packing documents into sequences of at most ``capacity`` tokens.

Documents are tokenised and cut into pieces; the plan is made on the histogram of piece lengths, which has
at most ``capacity`` entries whatever the input.  Exact-complement hashing: the lengths that occur, their sums
of two and their sums of three are indexed by the sum.  From the longest length down, a piece's gap is looked
up among single lengths, then pairs, then triples, and as many sequences as the counts allow are filled
exactly at once.  What can't be completed exactly is packed best-fit decreasing, again by counts.  A piece finds its place from its rank among the pieces of its length; ranks
are prefix sums in two levels, so a length that a third of all pieces share is still spread over many tasks.
"""

from __future__ import annotations

import functools
import json
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, small_batches


def _byte_of_char() -> dict[str, int]:
    """The inverse of the byte-level alphabet: printable bytes are themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _own_tokenizer(path: str):
    @functools.lru_cache(1)
    def load():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    return lambda text: load().encode(text, add_special_tokens=False).ids


def is_plain(spec: dict) -> bool:
    """Whether a tokenizer file does nothing but split as byte-level BPE does and merge in the order of its vocabulary."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or spec.get("normalizer") or any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return False
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space", True) or not split.get("use_regex", True):
        return False
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") for t in spec.get("added_tokens", [])):
        return False
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    ids = [model["vocab"].get(m, -1) for m in merged]
    special = {t["content"] for t in spec.get("added_tokens", [])}
    single = [i for t, i in model["vocab"].items() if len(t) == 1 and t not in special]
    return len(single) == 256 and max(single) < min(ids, default=1 << 60) and all(a < b for a, b in zip(ids, ids[1:], strict=False))


@functools.lru_cache(4)
def encoder(path: str):
    """text -> ids of the byte-level BPE tokenizer in the JSON file ``path``.

    Where the file is a plain byte-level BPE whose vocabulary stands in the order of its merges, the vocabulary
    serves as ranks for a faster encoder; a text that this one can't take, and any other file, goes through
    the file's own tokenizer.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if not is_plain(spec):
        return _own_tokenizer(path)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    own = _byte_of_char()
    ranks = {bytes(own[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    # Fixed value: the pattern by which byte-level tokenizers of this family split texts.
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    fast = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    names = tuple(special)

    slow = _own_tokenizer(path)

    def encode(text: str) -> list[int]:
        try:
            if any(x in text for x in names):
                return fast.encode(text, allowed_special="all")
            return fast.encode_ordinary(text)
        except BaseException as e:  # the fast encoder's regex can overflow its stack on one enormous word
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return slow(text)

    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of ``n`` tokens: all of ``capacity``, but for the first."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if wanted, the ids themselves.

    A null text is empty; every document ends with ``end_id``, so an empty one is a piece of length 1.
    """
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def run(batches: Iterator):
        import zlib

        import pyarrow as pa

        encode = encoder(tokenizer)
        for batch in batches:
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                for k, (s, n) in enumerate(cut(len(ids), capacity)):
                    own = ids[s : s + n]
                    row.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(own.tobytes()))
                    if with_ids:
                        kept.append(own.astype(np.int32))
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


class Sums:
    """Lengths, pairs and triples of lengths by their sum, as far as the counts last.

    A triple is held as its longest length, the other two being a pair of the rest's sum.  Counts only fall,
    so what has run out at the end of a list is dropped from it for good.
    """

    def __init__(self, counts: np.ndarray) -> None:
        self.counts = counts
        self.singles = {int(x): (int(x),) for x in np.flatnonzero(counts)}
        held = np.fromiter(self.singles, np.int64, len(self.singles))
        self.pairs: dict[int, list[tuple[int, int]]] = {}
        self.triples: dict[int, list[int]] = {}
        least: dict[int, int] = {}  # the longer length of the most even pair of each sum
        for total in range(2, len(counts)):
            big = held[(2 * held >= total) & (held < total)]
            big = big[counts[total - big] > 0]
            if len(big):
                self.pairs[total] = list(zip(big.tolist(), (total - big).tolist(), strict=True))
                least[total] = int(big[0])
        even = np.full(len(counts), len(counts))
        even[list(least)] = list(least.values())
        for total in range(3, len(counts)):
            top = held[(3 * held >= total) & (held < total - 1)]
            top = top[even[total - top] <= top]
            if len(top):
                self.triples[total] = top.tolist()

    def _has(self, *lengths: int) -> bool:
        return all(self.counts[x] >= lengths.count(x) for x in lengths)

    def single(self, gap: int, *taken: int) -> tuple[int, ...] | None:
        return self.singles.get(gap) if gap <= taken[-1] and self._has(*taken, gap) else None

    def pair(self, gap: int, *taken: int) -> tuple[int, ...] | None:
        """The most uneven pair with the sum ``gap``, of lengths up to the last of those ``taken``."""
        own = self.pairs.get(gap, [])
        while own and not (self.counts[own[-1][0]] and self.counts[own[-1][1]]):
            own.pop()
        return next((p for p in reversed(own) if p[0] <= taken[-1] and self._has(*taken, *p)), None)

    def triple(self, gap: int, *taken: int) -> tuple[int, ...] | None:
        own = self.triples.get(gap, [])
        while own and not self.counts[own[-1]]:
            own.pop()
        for top in reversed(own):
            if top <= taken[-1] and self._has(*taken, top) and (rest := self.pair(gap - top, *taken, top)):
                return (top, *rest)
        return None


def plan(counts: np.ndarray, capacity: int = 1024) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with how many sequences follow each; together they use up ``counts``.

    The index is consumed up to triples, up to pairs and with single lengths only: using up short lengths early
    can cost the best fit of the rest more than it gains, so the plan with the fewest sequences is returned.
    """
    return min((_plan(counts, capacity, depth) for depth in (3, 2, 1)), key=lambda p: sum(n for _, n in p))


def _plan(counts: np.ndarray, capacity: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    counts = counts.astype(np.int64).copy()
    patterns: list[tuple[tuple[int, ...], int]] = []
    if counts[capacity]:
        patterns.append(((capacity,), int(counts[capacity])))
        counts[capacity] = 0
    sums = Sums(counts)
    for find in (sums.single, sums.pair, sums.triple)[:depth]:
        for top in range(capacity - 1, 0, -1):
            while counts[top] and (found := find(capacity - top, top)):
                pattern = (top, *found)
                n = min(int(counts[x]) // pattern.count(x) for x in set(pattern))
                for x in pattern:
                    counts[x] -= n
                patterns.append((pattern, n))
    return patterns + _best_fit(counts, capacity)


def _best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: sequences with one content are handled together."""
    bins: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]  # by gap
    for length in range(capacity, 0, -1):
        n = int(counts[length])
        gap = length
        while n and gap <= capacity:
            if not bins[gap]:
                gap += 1
                continue
            pattern, m = bins[gap].pop()
            fit = min(gap // length, -(-n // m)) if n >= m else 1
            used = min(n // fit, m)
            if used < m:
                bins[gap].append((pattern, m - used))
            bins[gap - fit * length].append((pattern + (length,) * fit, used))
            n -= used * fit
            gap = length
        each = capacity // length
        if n // each:
            bins[capacity - each * length].append(((length,) * each, n // each))
        if n % each:
            bins[capacity - n % each * length].append(((length,) * (n % each), 1))
    return [x for group in bins for x in group]


def places(patterns: list[tuple[tuple[int, ...], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """Arrays (key, sequence, offset): pieces of one length from rank ``key``'s on stand in consecutive sequences."""
    used = [0] * (capacity + 1)
    key, sequence, at, base = [], [], [], 0
    for pattern, n in patterns:
        offset = 0
        for x in pattern:
            key.append(x << 44 | used[x])
            sequence.append(base)
            at.append(offset)
            used[x] += n
            offset += x
        base += n
    order = np.argsort(np.array(key, np.int64), kind="stable")
    return tuple(np.array(x, np.int64)[order] for x in (key, sequence, at))


def pack(table: DataFrame, capacity: int = 1024) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a written table of pieces (:func:`pieces`, materialised).

    The driver sees only the histogram of lengths.  Repeated rows are pieces of their own; an empty table
    gives no rows.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in table.groupBy("length").agg(F.count("*")).collect():  # at most `capacity` rows
        counts[length] = n
    key, sequence, at = places(plan(counts, capacity), capacity)
    buckets = 1 << max(4, min(16, math.ceil(math.log2(max(int(counts.sum()), 1) / 2048 + 1))))
    rows = table.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sums = rows.groupBy("length", "_bucket").agg(F.count("*").alias("n"))
    along = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("length", "_bucket", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("_base"))
    order = ["doc_id", "piece", "ids_crc32", "start"]
    within = Window.partitionBy("length", "_bucket").orderBy(*order)
    ranked = rows.withColumn("_rank", F.row_number().over(within) - 1).join(starts, ["length", "_bucket"])
    ranked = ranked.select(*table.columns, (F.col("_rank") + F.col("_base")).alias("_rank"))
    names = table.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema) + ", sequence_id bigint, offset bigint"

    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.asarray(batch.column("length")) << 44 | np.asarray(batch.column("_rank"))
            slot = np.searchsorted(key, own, "right") - 1
            columns = [batch.column(c) for c in names]
            columns += [pa.array(sequence[slot] + own - key[slot]), pa.array(at[slot])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, *, capacity: int = 1024, end_id: int = 2, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack: the rows of :func:`pieces` with ``sequence_id`` and ``offset``.

    Null and empty texts are the end id alone; ids may be null or repeat, repeated rows are pieces of their
    own; ties go by id, piece and checksum; an empty table gives no rows; other columns aren't read.
    """
    small_batches(docs.sparkSession)
    table = materialise(pieces(docs, tokenizer, id_col=id_col, text_col=text_col, capacity=capacity, end_id=end_id, with_ids=with_ids))
    return pack(table, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces with ids: sequence_id, ids, and each piece's (doc_id, piece, offset).

    A sequence holds at most ``capacity`` ids, so a group is bounded.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id",
        F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"),
        F.transform("p", lambda x: F.struct(x["doc_id"], x["piece"], x["offset"])).alias("parts"),
    )
