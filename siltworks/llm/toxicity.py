"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and their 4, 5 and 6 byte prefixes (inflections of one stem share them).  The vocabulary are
all terms whose document frequency differs between the labelled classes, to either side, by a likelihood-ratio
test, counted over one text of each group of near copies.  The test's level is ``LEVEL`` for the whole family
of terms tested (Bonferroni), so chance brings no terms in however many there are.  Labelled examples with
equal vectors are one index entry with its number of examples and of toxic ones.  Entries stand in blocks;
each term keeps the largest weight it has in each of its blocks, which bounds a query's cosines in a block;
blocks are scored in the order of their bounds until no bound reaches the neighbours found: the result is
exact.  The votes of the nearest examples are weighted by squared cosine and smoothed by the base rate.  A
score is the vote's calibrated chance: a monotone fit (pool adjacent violators) of the examples' labels to
the votes that each gets from all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, Blocks, WordHasher, bounded_sample, materialise, mix64, release, shingles, small_batches, whole_ids, word_hashes

PREFIXES = (4, 5, 6)
BLOCK = 64
#: Blocks that are scored before the others are held against what they gave; then twice as many, and so on.
AHEAD = 16
#: The chance that a term enters the vocabulary though no term differs between the classes.
LEVEL = 0.05
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


class Terms:
    """The hashed terms of a block of texts."""

    def __init__(self) -> None:
        self.hasher, self.prefix = WordHasher(), WordHasher()

    def __call__(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(term, row) of every occurrence."""
        data = LOWER[data]
        letter = _LETTER[data]
        h, start, end = self.hasher(data, letter)
        row = np.searchsorted(at, start, "right") - 1
        terms, rows = [h], [row]
        for n in PREFIXES:
            long = np.flatnonzero(end - start > n)
            code = np.zeros(len(long), np.uint64)
            for i in range(n):
                code = code << np.uint64(8) | data[start[long] + i].astype(np.uint64)
            terms.append(mix64(code + np.uint64(n << 56)))
            rows.append(row[long])
        return np.concatenate(terms), np.concatenate(rows)


def _ranges(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges first[i] to end[i], and the length of each range."""
    n = end - first
    return np.arange(int(n.sum())) + np.repeat(first - np.cumsum(n) + n, n), n


@dataclass(frozen=True)
class Index:
    """Entries' unit vectors by term, in blocks: a cell is a term's postings in a block, with their largest weight."""

    vocabulary: np.ndarray  # sorted term hashes
    idf: np.ndarray
    cells: np.ndarray  # term t has the cells cells[t]:cells[t + 1]
    block: np.ndarray  # per cell
    block_max: np.ndarray
    first: np.ndarray  # cell c has the postings first[c]:first[c + 1]
    docs: np.ndarray  # per posting
    weights: np.ndarray
    examples: np.ndarray  # per entry: labelled examples, toxic ones, the smallest id
    toxic: np.ndarray
    ids: np.ndarray
    empty: tuple[int, int]  # examples without a term of the vocabulary, and toxic ones
    base: float
    votes: np.ndarray  # the calibration: chances between these votes are interpolated
    chances: np.ndarray

    def vector(self, slots: np.ndarray, tf: np.ndarray) -> np.ndarray:
        w = (1 + np.log(tf)) * self.idf[slots]
        return w / np.sqrt((w * w).sum())

    def nearest(self, slots: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries and cosines, nearest first, until they hold ``k`` examples; exact, ties by entry."""
        cells, n = _ranges(self.cells[slots], self.cells[slots + 1])
        weights = np.repeat(weights, n)
        bound = np.bincount(self.block[cells], weights * self.block_max[cells], -(-len(self.examples) // BLOCK))

        def scored(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            own = blocks[self.block[cells]]
            posting, n = _ranges(self.first[cells[own]], self.first[cells[own] + 1])
            total = np.bincount(self.docs[posting], np.repeat(weights[own], n) * self.weights[posting], len(self.examples))
            hit = np.flatnonzero(total)
            return hit, total[hit]

        order = np.argsort(-bound, kind="stable")
        order = order[: int((bound > 0).sum())]
        entries, scores, least, at, step = np.empty(0, np.int64), np.empty(0), 0.0, 0, AHEAD
        while at < len(order) and bound[order[at]] >= least:
            some = np.zeros(len(bound), bool)
            some[order[at : at + step]] = True
            more, theirs = scored(some)
            entries, scores = np.concatenate((entries, more)), np.concatenate((scores, theirs))
            best = np.argsort(-scores, kind="stable")
            enough = int(np.searchsorted(np.cumsum(self.examples[entries[best]]), k))
            least = scores[best[enough]] - 1e-9 if enough < len(best) else 0.0
            at, step = at + step, 2 * step
        best = np.lexsort((entries, -np.round(scores, 12)))
        entries, scores = entries[best], scores[best]
        enough = int(np.searchsorted(np.cumsum(self.examples[entries]), k)) + 1
        return entries[:enough], scores[:enough]

    def vote(self, entries: np.ndarray, cosines: np.ndarray, k: int, prior: float, without: tuple[int, int] | None = None) -> float:
        """The share of toxic ones among the ``k`` nearest examples by squared cosine, smoothed by the base rate.

        ``without`` is an entry that counts one example less, and the label of that example.
        """
        number, toxic = self.examples[entries].astype(float), self.toxic[entries].astype(float)
        if without is not None:
            own = entries == without[0]
            number[own] -= 1
            toxic[own] -= without[1]
        share = np.divide(toxic, number, out=np.zeros(len(number)), where=number > 0)
        number = np.diff(np.minimum(np.cumsum(number), k), prepend=0)  # of the last entry only as many as are wanted
        w = cosines**2 * number
        return float((w @ share + prior * self.base) / (w.sum() + prior))

    def score(self, slots: np.ndarray, tf: np.ndarray, k: int, prior: float) -> tuple[float, list[tuple[int, float, float]]]:
        """The calibrated vote, and as evidence (id of an example, cosine, toxic share) of the nearest entries."""
        if not len(slots):
            n, toxic = self.empty
            return (toxic + prior * self.base) / (n + prior), []
        entries, cosines = self.nearest(slots, self.vector(slots, tf), k)
        share = self.toxic[entries] / self.examples[entries]
        evidence = [(int(self.ids[e]), float(c), float(s)) for e, c, s in zip(entries[:3], cosines, share, strict=False)]
        return float(np.interp(self.vote(entries, cosines, k, prior), self.votes, self.chances)), evidence


def monotone(votes: np.ndarray, n: np.ndarray, toxic: np.ndarray, base: float) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing step function of the votes that is nearest to the shares toxic / n: (votes, chances) at its steps.

    Neighbouring votes are pooled until the shares rise; each step is smoothed by one example of the base rate.
    """
    values, same = np.unique(np.round(votes, 9), return_inverse=True)
    steps: list[list[float]] = []  # sum of votes, examples, toxic ones
    for v, m, t in zip(values, np.bincount(same, n, len(values)), np.bincount(same, toxic, len(values)), strict=True):
        steps.append([v * m, m, t])
        while len(steps) > 1 and steps[-2][2] * steps[-1][1] >= steps[-1][2] * steps[-2][1]:
            last = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], last, strict=True)]
    if not steps:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    own = np.array(steps)
    return own[:, 0] / own[:, 1], np.maximum.accumulate((own[:, 2] + base) / (own[:, 1] + 1))


def _calibrated(index: Index, entries: list, k: int, prior: float) -> Index:
    """``index`` with its calibration: each example's vote is that of all others."""
    votes, n, toxic = [], [], []
    for e, (_, many, bad, slots, weights) in enumerate(entries):
        near = index.nearest(slots, weights, k + 1)
        for label, m in ((1, bad), (0, many - bad)):
            if m:
                votes.append(index.vote(*near, k, prior, (e, label)))
                n.append(m)
                toxic.append(m * label)
    steps = monotone(*(np.array(x, float) for x in (votes, n, toxic)), index.base)
    return replace(index, votes=steps[0], chances=steps[1])


def build_index(vocabulary: np.ndarray, idf: np.ndarray, rows: list[tuple[int, int, np.ndarray, np.ndarray]], k: int = 25, prior: float = 1.0) -> Index:
    """``rows``: (id, label, slots, tf) of each labelled example; calibrated for votes of ``k`` examples."""
    groups: dict[bytes, list] = {}
    empty = [0, 0]
    for i, y, slots, tf in sorted(rows, key=lambda r: r[0]):
        if not len(slots):
            empty[0] += 1
            empty[1] += y
            continue
        w = (1 + np.log(tf)) * idf[slots]
        w /= np.sqrt((w * w).sum())
        own = groups.setdefault(slots.tobytes() + np.round(w, 12).tobytes(), [i, 0, 0, slots, w])
        own[1] += 1
        own[2] += y
    # entries with the same heaviest term next to each other: blocks have tight bounds
    entries = sorted(groups.values(), key=lambda g: (int(g[3][g[4].argmax()]), len(g[3]), g[0]))
    n_blocks = -(-len(entries) // BLOCK)
    term = np.concatenate([g[3] for g in entries]) if entries else np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(entries)), [len(g[3]) for g in entries])
    weight = np.concatenate([g[4] for g in entries]) if entries else np.empty(0)
    order = np.lexsort((doc, term))
    term, doc, weight = term[order].astype(np.int64), doc[order], weight[order]
    first = np.flatnonzero(np.diff(term * n_blocks + doc // BLOCK, prepend=-1))
    block_max = np.maximum.reduceat(weight, first) if len(first) else weight
    cells = np.searchsorted(term[first], np.arange(len(vocabulary) + 1))
    block, first = doc[first] // BLOCK, np.append(first, len(doc))
    total = empty[0] + sum(g[1] for g in entries)
    toxic = empty[1] + sum(g[2] for g in entries)
    own = [np.array([g[i] for g in entries], np.int64) for i in (1, 2, 0)]
    plain = np.array([0.0, 1.0])
    index = Index(vocabulary, idf, cells, block, block_max, first, doc, weight, *own, (empty[0], empty[1]), (toxic + 0.5) / (total + 1), plain, plain)
    return _calibrated(index, entries, k, prior)


def _slots(vocabulary: np.ndarray, known: np.ndarray, term: np.ndarray, row: np.ndarray, n: int):
    """Per row: (slots, tf) of the terms in the vocabulary."""
    maybe = np.flatnonzero(known[(term >> np.uint64(44)).astype(np.int64)])
    term, row = term[maybe], row[maybe]
    slot = np.searchsorted(vocabulary, term)
    hit = vocabulary[np.minimum(slot, len(vocabulary) - 1)] == term if len(vocabulary) else np.zeros(len(term), bool)
    both, tf = np.unique(row[hit].astype(np.int64) * (len(vocabulary) + 1) + slot[hit], return_counts=True)
    edge = np.searchsorted(both, np.arange(n + 1) * (len(vocabulary) + 1))
    return [(both[a:b] - i * (len(vocabulary) + 1), tf[a:b]) for i, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True))]


def _known(vocabulary: np.ndarray) -> np.ndarray:
    known = np.zeros(1 << 20, bool)
    known[(vocabulary >> np.uint64(44)).astype(np.int64)] = True
    return known


def least_ratio(tests: int, level: float = LEVEL) -> float:
    """The likelihood ratio that one of ``tests`` terms exceeds by chance with the probability ``level``, all together."""
    return NormalDist().inv_cdf(level / max(tests, 1) / 2) ** 2


def train(examples: DataFrame, *, level: float = LEVEL, k: int = 25, prior: float = 1.0) -> Index:
    """The index of ``examples`` (doc_id bigint, text, toxic int): a bounded number of rows, see :func:`sampled`.

    Terms are typical of toxic or of other examples at the significance ``level`` of the whole family of terms.
    Without examples, or with one label only, no term is: all texts get the base rate.
    """

    def keyed(batches: Iterator):
        import pyarrow as pa

        hasher, blocks = WordHasher(), Blocks()
        for batch in batches:
            for first, last, data, at in blocks(batch.column(1)):
                s, row = shingles(*word_hashes(hasher, data, at), last - first, 3)
                n = np.bincount(row, minlength=last - first)
                key = np.zeros(last - first, np.uint64)
                key[n > 0] = np.minimum.reduceat(s, np.concatenate(([0], np.cumsum(n)))[:-1][n > 0]) if len(s) else 0
                own = [batch.column(i).slice(first, last - first) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(key.view(np.int64))], names=["doc_id", "text", "toxic", "key"])

    rows = materialise(examples.select("doc_id", "text", "toxic").mapInArrow(keyed, "doc_id bigint, text string, toxic int, key bigint"))
    # of near copies, which mostly share their least shingle hash, one text per label is counted
    one = rows.groupBy("key", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    single = rows.join(one, "doc_id", "left_semi")

    def counted(batches: Iterator):
        import pyarrow as pa

        find, blocks = Terms(), Blocks()
        for batch in batches:
            for first, last, data, at in blocks(batch.column(1)):
                y = np.asarray(batch.column(2).slice(first, last - first)).astype(np.int64)
                term, row = find(data, at)
                order = np.lexsort((term, row))
                term, row = term[order], row[order]
                fresh = np.ones(len(term), bool)
                fresh[1:] = (term[1:] != term[:-1]) | (row[1:] != row[:-1])
                term, flat = np.unique(term[fresh], return_inverse=True)
                toxic = np.bincount(flat, y[row[fresh]], len(term)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(np.bincount(flat, minlength=len(term))), pa.array(toxic)], names=["term", "n", "toxic"])

    size = single.groupBy("toxic").agg(F.count("*").alias("n")).collect()  # two rows
    all_n, toxic_n = sum(r["n"] for r in size), sum(r["n"] for r in size if r["toxic"])
    counts = single.select("doc_id", "text", "toxic").mapInArrow(counted, "term bigint, n bigint, toxic bigint")
    counts = materialise(counts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("a")))

    def part(observed, expected):
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    n, a = F.col("n"), F.col("a")
    share = max(toxic_n, 1) / max(all_n, 1)
    ratio = 2 * (
        part(a, n * share)
        + part(n - a, n * (1 - share))
        + part(F.lit(toxic_n) - a, (F.lit(all_n) - n) * share)
        + part(F.lit(all_n - toxic_n) - (n - a), (F.lit(all_n) - n) * (1 - share))
    )
    telling = counts.withColumn("ratio", ratio).where(F.col("ratio") >= least_ratio(counts.count(), level))
    chosen = sorted((np.int64(r["term"]).view(np.uint64), r["n"]) for r in telling.collect())  # a part of the sample's terms
    vocabulary = np.array([t for t, _ in chosen], np.uint64)
    idf = np.log((all_n + 1) / (np.array([n for _, n in chosen], float) + 1)) + 1

    def vectors(batches: Iterator):
        import pyarrow as pa

        find, blocks, known = Terms(), Blocks(), _known(vocabulary)
        for batch in batches:
            for first, last, data, at in blocks(batch.column(1)):
                found = _slots(vocabulary, known, *find(data, at), last - first)
                own = [batch.column(i).slice(first, last - first) for i in (0, 2)]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array([f[i].tolist() for f in found], pa.list_(pa.int64())) for i in (0, 1))], names=["doc_id", "toxic", "slots", "tf"])

    # at most `sample` rows, of their own terms
    table = rows.select("doc_id", "text", "toxic").mapInArrow(vectors, "doc_id bigint, toxic int, slots array<bigint>, tf array<bigint>").toArrow()
    ids, labels = table["doc_id"].to_pylist(), table["toxic"].to_pylist()
    slots, tf = table["slots"].to_pylist(), table["tf"].to_pylist()
    examples_ = [(i, y, np.array(s, np.int64), np.array(t, np.int64)) for i, y, s, t in zip(ids, labels, slots, tf, strict=True)]
    release(rows, counts)
    return build_index(vocabulary, idf, examples_, k, prior)


def score(docs: DataFrame, index: Index, *, id_col: str = "doc_id", text_col: str = "text", k: int = 25, prior: float = 1.0) -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), evidence (the nearest examples: id, cosine, toxic share).

    Texts that are null, empty or without a term of the vocabulary get the share of toxic ones among the
    labelled examples that are so too, and no evidence.  Repeated rows score alike; of equally near examples
    those count that stand first in the index, an order that depends on the examples alone.  An empty table
    gives no rows; ids may have any type or be null; other columns aren't read.
    """
    evidence = T.ArrayType(T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("cosine", T.DoubleType()), T.StructField("toxic", T.DoubleType())]))
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()), T.StructField("evidence", evidence)])
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by the sample's postings

    def run(batches: Iterator):
        import pyarrow as pa

        index = shared.value
        find, blocks, known = Terms(), Blocks(), _known(index.vocabulary)
        seen: dict[bytes, tuple] = {}
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.float64())]))
        for batch in batches:
            for first, last, data, at in blocks(batch.column(1)):
                scores, why = [], []
                for slots, tf in _slots(index.vocabulary, known, *find(data, at), last - first):
                    name = slots.tobytes() + tf.tobytes()
                    if name not in seen:
                        if len(seen) >= 20_000:  # a cache of equal queries
                            seen.clear()
                        seen[name] = index.score(slots, tf, k, prior)
                    scores.append(seen[name][0])
                    why.append([{"doc_id": i, "cosine": c, "toxic": t} for i, c, t in seen[name][1]])
                own = batch.column(0).slice(first, last - first)
                yield pa.RecordBatch.from_arrays([own, pa.array(scores, pa.float64()), pa.array(why, kind)], names=["doc_id", "score", "evidence"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sampled(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = 20_000) -> DataFrame:
    """Labelled documents (doc_id, text, toxic) to learn from: one row per id.

    ``sample`` is about how many there are: of more labels, those whose ids hash lowest.  So the labels can be
    broadcast, and of the texts only theirs are shuffled.  An id with several labels has the largest, one with
    several texts the first in their order; null ids and labels are ignored, null texts are empty.
    """
    whole_ids(labels, id_col)
    whole_ids(docs, id_col)
    own = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    own = own.groupBy(F.col(id_col).cast("bigint").alias("doc_id")).agg(F.max(F.col(label_col)).cast("int").alias("toxic"))
    own = bounded_sample(own, sample, "doc_id")
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(own), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = 20_000, k: int = 25) -> DataFrame:
    """Learn from the labelled rows that are not held out, score all: doc_id, held_out, score, predicted, evidence.

    One row per row of ``docs``; see :func:`sampled` and :func:`score` for nulls, repeats, ties and empty tables.
    """
    small_batches(docs.sparkSession)
    examples = sampled(docs, labels.where(~held_out(id_col)), id_col=id_col, text_col=text_col, label_col=label_col, sample=sample)
    found = score(docs, train(examples, k=k), id_col=id_col, text_col=text_col, k=k)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
