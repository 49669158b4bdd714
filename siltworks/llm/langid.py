"""Language identification with spans: scripts narrow the candidates, Viterbi labels the words.

The model holds, per language, log-probabilities of hashed character 3-grams, 4-grams and whole words in
tables of a fixed size, and which scripts its words are written in.  A word's scores are the sums over its
n-grams, relative to its best candidate and bounded below; languages that are not written in the word's
script are no candidates: they get a score so low that no path keeps them to save two changes.  A path
through the words pays ``penalty`` whenever it changes its language; the best path gives the spans, and the
language with most words is the document's.  A block's distinct words are scored once.

The recursion runs on contested stretches only.  A maximal stretch of a best path outside the text's best
single language gains over it at least the penalty of its changes, two within a text and one at its edge;
running extremes of the largest possible gains tell which words lie in such a stretch, and around them the
path is in the single language.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Blocks, LOWER, WordHasher, bounded_sample, mix64, small_batches

#: Slots of each of the three tables of n-grams.
SLOTS = 1 << 16
PENALTY = 8.0
FLOOR = -6.0
#: Of a language that is not written in the word's script; finite, as it is summed.
BARRED = -1000.0
#: Bytes of a text that are scored at a time; a run of letters that is longer counts as several words.
SEGMENT = 1 << 19

# First and last code point of the blocks of each script.
SCRIPTS = {
    "latin": ((0x0000, 0x02FF), (0x1E00, 0x1EFF)),
    "greek": ((0x0370, 0x03FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x0400, 0x052F),),
    "armenian": ((0x0530, 0x058F),),
    "hebrew": ((0x0590, 0x05FF),),
    "arabic": ((0x0600, 0x077F), (0x08A0, 0x08FF)),
    "devanagari": ((0x0900, 0x097F),),
    "bengali": ((0x0980, 0x09FF),),
    "tamil": ((0x0B80, 0x0BFF),),
    "thai": ((0x0E00, 0x0E7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x323AF)),
}
NAMES = ("other", *SCRIPTS)


def _script_table() -> np.ndarray:
    """The script number of each code point, 0 for those of no block above."""
    out = np.zeros(0x110000, np.int8)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for low, high in ranges:
            out[low : high + 1] = number
    return out


_SCRIPT = _script_table()
#: Bytes that words consist of: ASCII letters and all bytes of other characters.
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _word_scripts(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The highest script number among each word's characters; ``data`` is words and separators."""
    number = np.zeros(len(data), np.int8)
    number[data < 128] = 1
    wide = np.append(data, np.zeros(3, np.uint8)).astype(np.int32)
    for size, low, high, bits in ((2, 0xC2, 0xE0, 31), (3, 0xE0, 0xF0, 15), (4, 0xF0, 0xF5, 7)):
        at = np.flatnonzero((data >= low) & (data < high))
        point = wide[at] & bits
        for i in range(1, size):
            point = point << 6 | wide[at + i] & 63
        number[at] = _SCRIPT[np.minimum(point, 0x10FFFF)]
    return np.maximum.reduceat(number, start) if len(start) else number[:0]


class Features:
    """Hashed n-grams of the words of a block of bytes."""

    def __init__(self) -> None:
        self.hasher = WordHasher()

    def __call__(self, data: np.ndarray):
        """(start, end) of each word, the slots of each of its bytes (two columns), the slot of each whole word, its script."""
        data = LOWER[data]
        letter = _LETTER[data]
        h, start, end = self.hasher(data, letter)
        b = np.where(letter, data, 32).astype(np.uint64)
        edge = np.full(2, 32, np.uint64)
        one, two, after = np.concatenate((edge[:1], b[:-1])), np.concatenate((edge, b))[: len(b)], np.concatenate((b[1:], edge[:1]))
        two = np.where(one == 32, edge[0], two)
        three = (one << np.uint64(16) | b << np.uint64(8) | after) * np.uint64(0x9E3779B97F4A7C15)
        four = mix64(two << np.uint64(24) | one << np.uint64(16) | b << np.uint64(8) | after)
        grams = np.stack(((three >> np.uint64(48)), (four >> np.uint64(48)) + np.uint64(SLOTS)), 1).astype(np.int32)
        whole = (h >> np.uint64(48)).astype(np.int32) + 2 * SLOTS
        return start, end, letter, grams, whole, _word_scripts(np.where(letter, data, 32).astype(np.uint8), start)


@dataclass(frozen=True)
class Model:
    """``score[slot, language]`` log-probabilities, ``written[script, language]`` whether a language is written in a script."""

    languages: tuple[str, ...]
    score: np.ndarray
    written: np.ndarray


def train(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 20_000) -> Model:
    """Fit on the rows with a language.

    ``sample`` is about how many rows are read (:func:`bounded_sample`): of more, those whose ids, texts and
    languages hash lowest, so copies of a text under other ids are drawn one by one and rows repeated in full
    as one.  What reaches the driver are counts, at most 3 * 65536 per language.  Rows without text or
    language are ignored; without any row the model has no languages and labels all texts ``und``.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = bounded_sample(rows.where("lang is not null and text is not null"), sample, "doc_id", "text", "lang")

    def run(batches: Iterator):
        import pyarrow as pa

        features, blocks = Features(), Blocks()
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1)
            for first, last, data, at in blocks(batch.column(0)):
                start, _, letter, grams, whole, script = features(data)
                byte_row = np.repeat(np.arange(last - first), np.diff(at))[letter]
                word_row = np.searchsorted(at, start, "right") - 1
                own = np.array(langs.slice(first, last - first).to_pylist(), object)
                for lang in set(own):
                    mine = own == lang
                    count = total.setdefault(lang, np.zeros(3 * SLOTS + len(NAMES), np.int64))
                    g, w = grams[letter][mine[byte_row]], mine[word_row]
                    count[: 2 * SLOTS] += np.bincount(g.ravel(), minlength=2 * SLOTS)
                    count[2 * SLOTS :] += np.bincount(np.concatenate((whole[w], script[w].astype(np.int32) + 3 * SLOTS)) - 2 * SLOTS, minlength=SLOTS + len(NAMES))
        for lang, count in total.items():
            slot = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot.astype(np.int32)), pa.array(count[slot])], names=["lang", "slot", "n"])

    counts = rows.select("text", "lang").mapInArrow(run, "lang string, slot int, n bigint")
    found = counts.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    langs = found["lang"].to_pylist()
    languages = tuple(sorted(set(langs)))
    count = np.zeros((3 * SLOTS + len(NAMES), len(languages)))
    place = {lang: i for i, lang in enumerate(languages)}
    count[found["slot"].to_numpy(), np.array([place[x] for x in langs], np.int64)] = found["n"].to_numpy()
    score = np.empty((3 * SLOTS, len(languages)), np.float32)
    for k in range(3):
        part = count[k * SLOTS : (k + 1) * SLOTS]
        score[k * SLOTS : (k + 1) * SLOTS] = np.log((part + 0.5) / (part.sum(0) + 0.5 * SLOTS))
    words = count[3 * SLOTS :]
    written = words > 0.001 * words.sum(0)
    written[~written.any(1)] = True  # a script that no language is written in rules none out
    return Model(languages, score, written)


def word_scores(model: Model, found) -> np.ndarray:
    """Scores (words, languages): 0 for the best candidate, at least FLOOR for others, BARRED for no candidates."""
    start, end, letter, grams, whole, script = found
    per_byte = model.score[grams[letter, 0]] + model.score[grams[letter, 1]]
    before = np.cumsum(letter)
    per_word = 0.5 * np.add.reduceat(per_byte, before[start] - 1, axis=0) + model.score[whole]
    candidate = model.written[script]
    top = np.where(candidate, per_word, -np.inf).max(1, keepdims=True)
    return np.where(candidate, np.maximum(per_word - top, FLOOR), BARRED).astype(np.float64)


def _segments(data: np.ndarray, size: int):
    """(begin, end) of parts of about ``size`` bytes, cut between words, or else between characters."""
    begin = 0
    while begin < len(data):
        end = min(len(data), begin + size)
        if end < len(data):
            part = data[begin:end]
            cut = np.flatnonzero(~_LETTER[part])
            if not len(cut):
                cut = np.flatnonzero((part & 0xC0) != 0x80)[1:] - 1
            end = begin + int(cut[-1]) + 1 if len(cut) else end
        yield begin, end
        begin = end


def scored(model: Model, features: Features, data: np.ndarray, segment: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, scores) of each word of a block of bytes.

    Of words that occur several times in a segment the n-grams are looked up once.
    """
    starts, scores = [np.empty(0, np.int64)], [np.empty((0, len(model.languages)))]
    for begin, stop in _segments(data, segment or SEGMENT):
        part = LOWER[data[begin:stop]]
        h, start, end = features.hasher(part, _LETTER[part])
        if not len(start):
            continue
        _, one, again = np.unique(h, return_index=True, return_inverse=True)
        size = end[one] - start[one]
        at = np.cumsum(size + 1) - size - 1  # where each distinct word begins, a space after each
        alone = np.full(int(at[-1] + size[-1] + 1), 32, np.uint8)
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        alone[np.repeat(at, size) + place] = part[np.repeat(start[one], size) + place]
        starts.append(start + begin)
        scores.append(word_scores(model, features(alone))[again])
    return np.concatenate(starts), np.concatenate(scores)


def _contested(e: np.ndarray, begin: np.ndarray, single: np.ndarray, texts: np.ndarray, penalty: float) -> np.ndarray:
    """Whether each word can be outside the text's ``single`` language on its best path; true for some that aren't."""
    n_words = len(e)
    place = np.arange(n_words)
    ref = single[texts]
    own = e[place, ref]
    rest = e.copy()
    rest[place, ref] = -np.inf
    total = np.cumsum(rest.max(1) - own)  # what leaving the single language gains at most, summed up
    opening = np.concatenate(([0.0], total[:-1]))
    apart = 2 * (np.abs(total).max() + penalty) * texts  # keeps the running extremes of one text from the next
    low = np.minimum.accumulate(opening - apart) + apart
    high = np.maximum.accumulate((total - apart)[::-1])[::-1] + apart
    start, end = opening[begin[texts]], total[begin[texts + 1] - 1]
    return np.maximum(np.maximum(high - start, end - low), high - low - penalty) >= penalty - 1e-3


def viterbi(e: np.ndarray, begin: np.ndarray, penalty: float) -> np.ndarray:
    """The language of each word on each text's best path; text d has the words begin[d] to begin[d + 1]."""
    n_words, n_langs = e.shape
    out = np.zeros(n_words, np.int64)
    count = np.diff(begin)
    rows = np.flatnonzero(count)
    if not len(rows) or n_langs == 1:
        return out
    texts = np.repeat(np.arange(len(count)), count)
    single = np.zeros(len(count), np.int64)
    single[rows] = np.add.reduceat(e, begin[rows], axis=0).argmax(1)
    out[:] = single[texts]
    open_ = _contested(e, begin, single, texts, penalty)
    edge = np.diff(np.concatenate(([0], open_.view(np.int8), [0])))
    first = np.zeros(n_words + 1, bool)
    first[begin[rows]] = True
    first = np.flatnonzero((edge == 1) | first & np.append(open_, False))
    if not len(first):
        return out
    last = np.minimum(np.append(first[1:], n_words), np.flatnonzero(edge == -1)[np.searchsorted(np.flatnonzero(edge == -1), first, "right")])
    order = np.argsort(first - last, kind="stable")
    own, length = first[order], (last - first)[order]
    ref = single[texts[own]]
    away = np.full((len(own), n_langs), penalty)  # around a stretch the path is in the single language
    away[np.arange(len(own)), ref] = 0.0
    value = e[own] - away * (own != begin[texts[own]])[:, None]
    came = np.empty((int(length.sum()), n_langs), np.int16)
    offset = np.concatenate(([0], np.cumsum(length)))[:-1]
    steps = int(length[0])
    for t in range(1, steps):
        live = int(np.searchsorted(-length, -t, "left"))
        v = value[:live]
        top = v.argmax(1)
        change = v[np.arange(live), top] - penalty
        stay = v >= change[:, None]
        came[offset[:live] + t] = np.where(stay, np.arange(n_langs), top[:, None])
        value[:live] = np.where(stay, v, change[:, None]) + e[own[:live] + t]
    inner = own + length != begin[texts[own] + 1]
    lang = (value - away * inner[:, None]).argmax(1)
    for t in range(steps - 1, -1, -1):
        live = int(np.searchsorted(-length, -t, "left"))
        out[own[:live] + t] = lang[:live]
        if t:
            lang[:live] = came[offset[:live] + t, lang[:live]]
    return out


def label(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", penalty: float = PENALTY) -> DataFrame:
    """One row per input row: doc_id, lang_pred, score, spans.

    ``spans`` are (start, end, lang) in words; words are runs of letters.  ``score`` is the share of words in
    ``lang_pred`` times its probability under a softmax of the languages' total scores.  Null texts, and
    those without a letter, are ``und`` with score 0 and no spans; ties go to the language that sorts first.
    Ids may have any type, be null or repeat; an empty table gives no rows; other columns aren't read.
    """
    return _labelled(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model, penalty)


def _labelled(rows: DataFrame, model: Model, penalty: float, inside: str | None = None) -> DataFrame:
    """:func:`label` for the columns doc_id and text; with ``inside`` the text is that field of the struct ``doc_id``."""
    small_batches(rows.sparkSession)
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())])
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])
    shared = rows.sparkSession.sparkContext.broadcast(model)  # tables of a fixed size per language

    def run(batches: Iterator):
        import pyarrow as pa

        model = shared.value
        names = np.array([*model.languages, "und"], object)
        features, blocks = Features(), Blocks(SEGMENT)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
        for batch in batches:
            has_letter = np.asarray(batch.column(1).fill_null(False).to_pylist(), bool)
            for first, last, data, at in blocks(batch.column(0).field(inside) if inside else batch.column(2)):
                n = last - first
                pred, score = np.full(n, len(names) - 1), np.zeros(n)
                spans: list = [[] for _ in range(n)]
                start, e = scored(model, features, data) if len(model.languages) else ([], None)
                if len(start):
                    begin = np.searchsorted(start, at)
                    path = viterbi(e, begin, penalty)
                    rows = np.flatnonzero(np.diff(begin))
                    texts = np.repeat(np.arange(n), np.diff(begin))
                    share = np.bincount(texts * len(model.languages) + path, minlength=n * len(model.languages)).reshape(n, -1)
                    share = share[rows] / np.diff(begin)[rows][:, None]
                    total = np.add.reduceat(e, begin[rows], axis=0)
                    chance = np.exp(total - total.max(1, keepdims=True))
                    chance /= chance.sum(1, keepdims=True)
                    top = share.argmax(1)
                    pred[rows] = top
                    score[rows] = share[np.arange(len(rows)), top] * np.maximum(chance[np.arange(len(rows)), top], 1 / len(model.languages))
                    edge = np.flatnonzero(np.concatenate(([True], (path[1:] != path[:-1]) | (texts[1:] != texts[:-1]), [True])))
                    for a, b in zip(edge[:-1], edge[1:], strict=True):
                        d = texts[a]
                        spans[d].append({"start": int(a - begin[d]), "end": int(b - begin[d]), "lang": names[path[a]]})
                none = ~has_letter[first:last]
                pred[none], score[none] = len(names) - 1, 0.0
                for d in np.flatnonzero(none):
                    spans[d] = []
                own = batch.column(0).slice(first, n)
                yield pa.RecordBatch.from_arrays([own, pa.array(names[pred], pa.string()), pa.array(score), pa.array(spans, kind)], names=["doc_id", "lang_pred", "score", "spans"])

    text = F.col("doc_id").getField(inside) if inside else F.col("text")
    return rows.select("doc_id", text.rlike(r"\p{L}").alias("has_letter"), *([] if inside else ["text"])).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 20_000, penalty: float = PENALTY) -> DataFrame:
    """Train on the rows of ``docs`` that are not held out, label all of them: :func:`label` with ``held_out``."""
    model = train(docs.where(~held_out(id_col)), id_col=id_col, text_col=text_col, lang_col=lang_col, sample=sample)
    return label(docs, model, id_col=id_col, text_col=text_col, penalty=penalty).withColumn("held_out", held_out("doc_id"))


def in_a_language(
    docs: DataFrame,
    *,
    wanted: Sequence[str] | None = None,
    least: float = 0.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = 20_000,
) -> DataFrame:
    """The rows of ``docs`` that have a language, which ``lang_col`` then names; other columns as they are.

    A row goes if its text is null or has no letter, if its predicted language isn't ``wanted`` (None: any
    learned one), or if its score is below ``least``.  Repeated rows are judged alike; an empty table, or one
    without a labelled row to learn from, gives no rows.
    """
    model = train(docs.where(~held_out(id_col)), id_col=id_col, text_col=text_col, lang_col=lang_col, sample=sample)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"))
    found = _labelled(whole, model, PENALTY, text_col).where((F.col("lang_pred") != "und") & (F.col("score") >= least))
    if wanted is not None:
        found = found.where(F.col("lang_pred").isin(*wanted))
    kept = [F.col("lang_pred").cast(docs.schema[c].dataType).alias(c) if c == lang_col else F.col("doc_id").getField(c).alias(c) for c in docs.columns]
    return found.select(*kept)
