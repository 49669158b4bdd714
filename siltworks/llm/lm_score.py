"""Cross-entropy difference: how much more a target model expects a document than a background model.

Both models are bigram models over one vocabulary, the words of all documents.  Counts are exact and taken
over every document, the target's over every target document; no table of a fixed size holds them.

Documents are dealt to blocks of about ``BLOCK`` bytes of text by a hash of their ids (of the text for null ids);
the targets' ids meet them there.  A block asks once for each distinct
word and pair it holds: its keys (64-bit hashes) go, sorted and with the block's own counts, to the parts of
the key space.  A part adds up what the blocks say and answers each with the corpus's counts in the order of its
keys.  The block, which computes the same keys again, then scores its documents.  So blocks and parts bound what
a task holds, their numbers grow with the corpus, and the driver sees three sums only.

A document is scored by what all others say: its own words and pairs are taken out of both models' counts and
sums.  With c the counts left, N their sums over words, b the background, t the target, U the number of words
that a vocabulary is taken to have (``types``) and s = N_t / N_b (at most 1):

    p_b(w) = (c_b(w) + 1/2) / (N_b + U/2)             p_t(w) = (c_t(w) + prior * p_b(w)) / (N_t + prior)
    p_b(w|v) = (s c_b(v,w) + weight * p_b(w)) / (s c_b(v) + weight), and likewise p_t(w|v), without s

The background is scaled to the target's size, so that the same smoothing weighs the same in both.  A word that
the background holds less than ``least`` times is unknown: its p_t is its p_b.  A document's score is the mean
over its words of the target's loss less the background's; the lower, the more it is like the target.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Blocks, WordHasher, mix64, n_words, small_batches, word_hashes

#: Bytes of text of a block, and words of the corpus for each part of the key space.
BLOCK = 1 << 23
PART = 1 << 21
#: Bytes of text of a block, and keys of a part, that are worked on at once: tasks hold little beside what they get and give.
SLICE = 1 << 18
STEP = 1 << 18

_PAIR = np.uint64(0x9E3779B97F4A7C15)


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix64(left * _PAIR + right)


def _slices(texts):
    """Words and pairs of a column of texts, for each ``SLICE`` bytes of whole texts.

    Yields (first row, end row, places of the words that another one of their row follows, keys, their rows);
    the words' keys come first, then those of the pairs that begin at these places; rows count from the first.
    """
    hasher = WordHasher()
    for first, last, data, at in Blocks(SLICE)(texts):
        h, row = word_hashes(hasher, data, at)
        before = np.flatnonzero(row[1:] == row[:-1])
        yield first, last, before, np.concatenate((h, pair_keys(h[before], h[before + 1]))), np.concatenate((row, row[before]))


def _counted(items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``items``, which are sorted in place, and how often each occurs."""
    items.sort()
    new = np.ones(len(items), bool)
    new[1:] = items[1:] != items[:-1]
    begin = np.flatnonzero(new)
    return items[begin], np.diff(begin, append=len(items))


def _width(most: int) -> int:
    """How many bytes hold the whole numbers up to ``most``."""
    return max(1, (int(most).bit_length() + 7) // 8)


def _planes(x: np.ndarray, width: int = 8) -> np.ndarray:
    """Whole numbers byte by byte, the highest of all first: those of sorted keys and of counts repeat and so compress."""
    return x.astype(">u8").view(np.uint8).reshape(-1, 8).T[8 - width :]


def _matrix(planes, width: int = 8) -> np.ndarray:
    """A binary value's planes, not copied."""
    return np.frombuffer(planes.as_buffer(), np.uint8).reshape(width, -1)


def _whole(planes: np.ndarray) -> np.ndarray:
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, 8 - len(planes) :] = planes.T
    return out.view(">u8").ravel().astype(np.uint64)


def _ask(parts: int):
    """A block's distinct keys with its own counts, a row for each part of the key space."""

    def run(docs, targets):
        import pyarrow as pa
        import pyarrow.compute as pc

        is_target = pc.is_in(docs["doc_id"], targets["doc_id"]).to_numpy()
        items, of_target = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        for first, _, _, own, of in _slices(docs["text"]):
            items.append(own)
            of_target.append(own[is_target[of + first]])
        some, m = _counted(np.concatenate(of_target))
        del of_target
        items = np.concatenate(items)
        keys, n = _counted(items)
        del items
        t = np.zeros(len(keys), np.int64)
        t[np.searchsorted(keys, some)] = m
        part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        held, begin = np.unique(part, return_index=True)
        cut = [slice(a, b) for a, b in zip(begin, [*begin[1:], len(keys)])]
        block = pa.array(np.full(len(held), docs["block"][0].as_py() if len(held) else 0, np.int64))
        columns = [block, pa.array(held)]
        for x, width in ((keys, 8), (n, _width(n.max(initial=0))), (t, _width(t.max(initial=0)))):
            columns.append(pa.array([_planes(x[c], width).tobytes() for c in cut], pa.binary()))
        return pa.Table.from_arrays(columns, names=["block", "part", "keys", "n", "t"])

    return run


def _answer(width: int):
    """The corpus's counts for each block's keys in one part, in the order of the keys; about ``STEP`` keys are added up at once."""

    def run(asked):
        import pyarrow as pa

        keys = [_matrix(k) for k in asked["keys"]]
        size = np.array([k.shape[1] for k in keys])
        ends = width * np.cumsum([0, *size])
        least, most = (f(int(_whole(k[:, [at]])[0]) for k in keys) for f, at in ((min, 0), (max, -1)))
        steps = max(1, math.ceil(size.sum() / STEP))
        edges = np.array([least + (most - least) * k // steps for k in range(1, steps)], np.uint64)
        cuts = np.array([[0, *np.searchsorted(_whole(k), edges), k.shape[1]] for k in keys])
        told = [([_matrix(x, len(x.as_buffer()) // n) for x, n in zip(asked[name], size)], np.empty(ends[-1], np.uint8)) for name in ("n", "t")]
        for a, b in zip(cuts.T, cuts.T[1:]):
            rows = np.flatnonzero(a < b)
            if not len(rows):
                continue
            _, at = np.unique(np.concatenate([_whole(keys[i][:, a[i] : b[i]]) for i in rows]), return_inverse=True)
            borders = np.cumsum((b - a)[rows])[:-1]
            for said, out in told:
                total = np.bincount(at, np.concatenate([_whole(said[i][:, a[i] : b[i]]) for i in rows]))  # exact below 2**53
                for i, x in zip(rows, np.split(total.astype(np.int64)[at], borders)):
                    out[ends[i] : ends[i + 1]].reshape(width, -1)[:, a[i] : b[i]] = _planes(x, width)
        offsets = pa.py_buffer(ends.astype(np.int32))
        columns = [pa.Array.from_buffers(pa.binary(), len(keys), [None, offsets, pa.py_buffer(out)]) for _, out in told]
        return pa.Table.from_arrays([asked["block"], asked["part"], *columns], names=["block", "part", "n", "t"])

    return run


def _score(schema, n_background: int, n_target: int, least: int, weight: float, prior: float, types: float):
    """The scores of a block's documents, from the corpus's counts of its keys less each document's own."""

    def run(docs, told):
        import pyarrow as pa
        import pyarrow.compute as pc

        is_answer = pc.is_valid(told["part"])
        answers, targets = told.filter(is_answer), told["target"].filter(pc.invert(is_answer))
        is_target = pc.is_in(docs["doc_id"], targets).to_numpy(zero_copy_only=False).astype(bool)
        order = np.argsort(answers["part"].to_numpy())
        corpus_n, corpus_t = (np.concatenate([np.empty(0), *(_whole(_matrix(answers[c][int(i)], _width(n_background))) for i in order)]) for c in ("n", "t"))
        keys, _ = _counted(np.concatenate([np.empty(0, np.uint64), *(_counted(s[3])[0] for s in _slices(docs["text"]))]))
        size, means = np.zeros(len(docs), np.int64), np.zeros((2, len(docs)))
        for first, last, before, items, of in _slices(docs["text"]):
            rows, words = last - first, slice(0, len(items) - len(before))
            row, own_size = of[words], np.bincount(of[words], minlength=rows)
            size[first:last] = own_size
            some, at = np.unique(items, return_inverse=True)
            # how often each document has each of its items itself
            _, same, own = np.unique(at * rows + of, return_inverse=True, return_counts=True)
            own = own[same]
            place = np.searchsorted(keys, some)
            n, t = corpus_n[place][at] - own, corpus_t[place][at] - own * is_target[first:last][of]
            left, left_t = n_background - own_size[row], n_target - (own_size * is_target[first:last])[row]
            background = (n[words] + 0.5) / (left + types / 2)
            target = np.where(n[words] < least, background, (t[words] + prior * background) / (left_t + prior))
            scale = np.minimum(1.0, left_t / np.maximum(left, 1)) if n_target else np.ones(len(row))
            for k, (p, c, s) in enumerate(((target, t, np.ones(len(row))), (background, n, scale))):
                s = s[before + 1]
                p[before + 1] = (s * c[len(row) :] + weight * p[before + 1]) / (s * c[before] + weight)
                means[k, first:last] = np.bincount(row, -np.log(p), rows) / np.maximum(own_size, 1)
        figures = [pa.array(x, pa.float64(), mask=size == 0) for x in (*means, means[0] - means[1])]
        return pa.Table.from_arrays([docs["doc_id"], pa.array(size), *figures], names=schema)

    return run


def cross_entropy_difference(
    docs: DataFrame, targets: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 2, weight: float = 10.0, prior: float = 1000.0, types: float = 1 << 20
) -> DataFrame:
    """Score all ``docs`` by how they are like those whose ids are in ``targets``.

    One row per input row: doc_id, n_words, ce_target, ce_background, score.  Words are runs of other characters
    than ASCII white space, with A-Z lower-cased.  Texts without words, null ones too, have nulls for the three
    figures.  Null ids are no targets; repeated rows count and are scored each, as copies of one another; other
    columns aren't read.  Without targets both models are alike but for the contexts, and all documents are
    still scored.  An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    ids = targets.select(F.col(id_col).alias("doc_id")).where("doc_id is not null").distinct()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sizes = rows.select("doc_id", F.octet_length("text").alias("bytes"), n_words(F.col("text")).alias("n"))
    of_target = sizes.join(ids.withColumn("target", F.lit(True)), "doc_id", "left").withColumn("t", F.when(F.col("target"), F.col("n")))
    n_bytes, n_background, n_target = (x or 0 for x in of_target.agg(F.sum("bytes"), F.sum("n"), F.sum("t")).first())
    blocks, parts = (max(1, math.ceil(x / y)) for x, y in ((n_bytes, BLOCK), (n_background, PART)))

    def dealt(df, key):
        return df.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks))).groupBy("block")

    rows = dealt(rows, F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary"))))
    block = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(blocks)).alias("block")
    known = ids.select(block, F.col("doc_id").alias("target"))
    ids = dealt(ids, F.col("doc_id").cast("string"))
    asked = rows.cogroup(ids).applyInArrow(_ask(parts), "block bigint, part bigint, keys binary, n binary, t binary")
    answers = asked.groupBy("part").applyInArrow(_answer(_width(n_background)), "block bigint, part bigint, n binary, t binary")
    names = ["doc_id", "n_words", "ce_target", "ce_background", "score"]
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_words bigint, ce_target double, ce_background double, score double"
    score = _score(names, n_background, n_target, least, weight, prior, types)
    told = answers.unionByName(known, allowMissingColumns=True)  # what a block is told: counts, and which ids are targets
    return rows.cogroup(told.groupBy("block")).applyInArrow(score, schema)
