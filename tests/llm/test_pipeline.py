"""The pipeline's rows against plain Python over what its stages promise."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from siltworks.llm import langid, queries

from .test_operators import SF, WORD, similar

ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, key int, _part int"


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def exact(rows):
    """The rows that stay of (id, text): of equal texts the smallest id's, null ids last, one of repeated rows."""
    first: dict = {}
    for i, t in rows:
        at = (i is None, i or 0)
        first[normal(t)] = min(first.get(normal(t), at), at)
    kept, seen = [], set()
    for i, t in rows:
        if (i is None, i or 0) == first[normal(t)] and (i, normal(t)) not in seen:
            seen.add((i, normal(t)))
            kept.append((i, t))
    return kept


def near(rows):
    ids = [1 << 62 if i is None else i for i, _ in rows]
    order = sorted(range(len(rows)), key=lambda k: ids[k])
    _, root = similar([rows[k][1] for k in order], [ids[k] for k in order], 5, 80)
    sizes = [len(WORD.findall(rows[k][1] or "")) for k in order]
    return [rows[k] for k, r, n in zip(order, root, sizes, strict=True) if r == ids[k] or not n]


def mixed(rows):
    """How often each (id, text, source) is taken."""
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    own = {s: sum(n for n, r in zip(size, rows, strict=True) if r[2] == s) for s in names}
    want, left = {}, set(names)
    while True:
        rest = sum(own.values()) - sum(want.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        full = {s for s in left if share[s] > 3 * own[s]}
        if not full:
            break
        want |= {s: 3.0 * own[s] for s in full}
        left -= full
    target = want | share
    times = Counter()
    for s in names:
        quota, at = int(target[s] + 0.5), 0
        group = [(hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest(), r[0], n, r) for r, n in zip(rows, size, strict=True) if r[2] == s]
        for _, _, n, r in sorted(group, key=lambda g: g[:1]):
            times[r[:2]] += sum(min(n, quota - at - e * own[s]) > 0 for e in range(3))
            at += n
    return times


def packed(times):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(queries.tokenizer_path())
    out = Counter()
    for (i, t), n in times.items():
        ids = [*own.encode(t or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 1024 + 1
        for k, s in enumerate([0, *range(first, len(ids), 1024)] if n else []):
            part = ids[s : first if k == 0 else s + 1024]
            out[(i, k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += n
    return out


def places(rows):
    full: dict = {}
    for r in rows:
        full.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in full.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 1024


def letters(text):
    return any(c.isalpha() for c in text or "")


def test_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    source = {r["doc_id"]: r["source"] for r in docs}
    rows = near(exact([(r["doc_id"], r["text"]) for r in docs if letters(r["text"])]))
    out = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == packed(mixed([(i, t, source[i]) for i, t in rows]))
    places(out)


@pytest.fixture(scope="module")
def odd(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "x", 1, 2) for r in base]
    i, t, lang, s, n, *rest = rows[0]
    rows += [
        rows[1], rows[1], (rows[2][0], *rows[2][1:5], "other columns", None, 0), (None, t, None, None, n, *rest), (None, t + "\n", lang, s, n, *rest), (None, "only of a null id", None, None, 1, *rest),
        (None, "only of a null id", None, None, 1, *rest), (900, None, "en", s, None, *rest), (901, "", None, None, 0, *rest), (902, " \t\n", "de", None, 3, *rest), (903, "123 456 !", "de", s, 9, *rest),
        (904, "many words " * 20_000, "en", s, 220_000, *rest), (905, t.replace(" ", "  "), lang, None, n, *rest), (906, "é" * 50_000, None, s, 50_000, *rest),
    ]
    return spark.createDataFrame(rows, ODD).repartition(3)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_language_stage(spark, odd):
    out = corpus_pipeline.identify_language(spark, odd, SF)
    model = langid.train(odd.where(~langid.held_out()))
    want, found = [], {r["doc_id"]: r["lang_pred"] for r in langid.label(odd, model, id_col="text").collect()}
    for r in odd.collect():
        assert (found[r["text"]] == "und") == (not letters(r["text"]))
        if letters(r["text"]):
            want.append((*r[:2], found[r["text"]], *r[3:]))
    assert out.schema.names == odd.schema.names and as_rows(out) == sorted(want, key=str)


def test_exact_stage(spark, odd):
    out = corpus_pipeline.drop_exact_copies(spark, odd, SF)
    want = exact([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert out.schema == odd.schema and Counter((r["doc_id"], normal(r["text"])) for r in out.collect()) == Counter((i, normal(t)) for i, t in want)
    assert as_rows(out) == as_rows(corpus_pipeline.drop_exact_copies(spark, odd.repartition(5), SF))  # whatever the order


def test_near_stage(spark, odd):
    docs = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    out = corpus_pipeline.drop_near_copies(spark, docs, SF)
    want = near([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert out.schema == docs.schema and sorted(r["doc_id"] for r in out.collect()) == sorted(i for i, _ in want)
    everything = Counter(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, odd, SF).collect())
    assert everything[None] == 2 and all(everything[i] >= 1 for i, _ in want)  # both rows of the text that only null ids have


def test_mix_stage(spark, odd):
    docs = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    out = corpus_pipeline.mix_sources(spark, docs, SF)
    want = mixed([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])
    assert out.schema == docs.schema and Counter(r["doc_id"] for r in out.collect()) == Counter({i: n for (i, _), n in want.items() if n})
    assert {None, 901, 902} & {r["doc_id"] for r in corpus_pipeline.mix_sources(spark, odd, SF).collect()} == {None}


def test_pack_stage(spark, odd):
    out = corpus_pipeline.pack(spark, odd, SF).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == packed(Counter((r["doc_id"], r["text"]) for r in odd.collect()))
    places(out)


def test_stages_of_empty_tables(spark, odd):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), SF).count() == 0
