"""Each operator against a brute-force version, with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import json
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from siltworks.llm import automaton, common, exact_dedup, langid, licenses, lm_score, minhash, mixing, packing, queries, secrets, toxicity, vectors

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, size int, n int, spans string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdeé漢") for _ in range(rnd.randint(1, 6))) for _ in range(300)]
    base = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 80))) for _ in range(40)]
    out = [*base, None, "", " \t\n", "?!", "one", "One\n", "x" * 100_000, " ".join(rnd.choice(vocabulary) for _ in range(30_000))]
    for i in range(40):
        w = base[i % 20].split()
        w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        out += [" ".join(w), base[i % 7].replace(" ", "  \n")]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ("en", "fr", None)[i % 3], ("s1", "s2", "é", None)[i % 4], 1, "c", 7, 8, "d") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "null id", None, None, 1, None, None, None, None), rows[3], rows[3]], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def similar(texts, ids, width, percent):
    """(set sizes, smallest id reachable) by all pairs."""
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    x, y = [], []
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x.append(a)
                y.append(b)
    root = list(range(len(sets)))
    for _ in range(len(sets)):
        for a, b in zip(x, y, strict=True):
            root[a] = root[b] = min(root[a], root[b])
    return [len(s) for s in sets], [ids[r] for r in root]


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, texts, width, percent):
    sizes, root = similar(texts, range(len(texts)), width, percent)
    out = minhash.near_duplicates(docs, words=width, percent=percent).collect()
    assert len(out) == docs.count()
    for r in out:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (sizes[r["doc_id"]], root[r["doc_id"]], root[r["doc_id"]] == r["doc_id"])
        else:
            assert r["component_id"] is None and r["kept"]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    b = np.concatenate((a[:250], rng.integers(0, 1 << 63, 50).astype(np.uint64)))
    both = minhash.super_minhash(np.concatenate((a, b)), np.repeat([0, 1], 300), 3, 256)
    assert abs((both[0] == both[1]).mean() - 250 / 350) < 0.1 and np.isinf(both[2]).all()
    parts = minhash.super_minhash(a, np.zeros(300, np.int64), 1, 256, chunk=7)
    assert (parts[0] == both[0]).all()


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    rnd = random.Random(2)
    base = [str(i) for i in range(60)]
    texts = []
    for _ in range(60):
        w = list(base)
        for _ in range(rnd.randint(0, 5)):
            w[rnd.randrange(60)] = str(rnd.randrange(10_000))
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    _, root = similar(texts, range(60), 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, words=3, percent=85).collect()} == dict(enumerate(root))


def test_exact_dedup(docs, texts):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    out = exact_dedup.exact_dedup(exact_dedup.digests(docs)).collect()
    assert sum(r["kept"] for r in out) == len({*norm, "null id"})
    for r in out:
        if r["doc_id"] is not None:
            same = [i for i, t in enumerate(norm) if t == norm[r["doc_id"]]]
            assert r["keep_id"] == same[0] and r["group_size"] == len(same) + 2 * (3 in same)
            assert r["text_sha256"] == hashlib.sha256(norm[r["doc_id"]].encode()).hexdigest()
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len({*norm, "null id"})


def test_exact_dedup_splits_frequent_digests(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 1000)).alias("text"))
    out = exact_dedup.exact_dedup(exact_dedup.digests(df), candidates=16, counters=64)
    assert {(r["keep_id"], r["group_size"]) for r in out.where("group_size > 100").collect()} == {(0, 1667)}
    assert out.where("kept").count() == df.select("text").distinct().count()


def test_mixing(docs, texts):
    out = mixing.mix(docs).collect()
    assert len(out) == docs.count()
    sizes = [len(WORD.findall(t or "")) for t in texts]
    total, targets = {}, {}
    for r in out:
        if r["doc_id"] is not None:
            assert r["size"] == sizes[r["doc_id"]]
        assert 0 <= r["taken"] <= 3 * r["size"] and len(r["positions"]) == -(-r["taken"] // r["size"] if r["size"] else 0)
        total[r["source"]] = total.get(r["source"], 0) + r["size"]
        targets[r["source"]] = r["target"]
    weights = dict(zip(["s1", "s2", "é", None], [1, 2, 3, 1], strict=True))
    want, left = {}, set(weights)
    while True:  # water-filling, round by round
        rest = sum(total.values()) - sum(want.values())
        share = {s: rest * weights[s] / sum(weights[x] for x in left) for s in left}
        full = {s for s in left if share[s] > 3 * total[s]}
        if not full:
            break
        want |= {s: 3 * total[s] for s in full}
        left -= full
    assert targets == pytest.approx(want | share)
    for s, t in targets.items():
        assert abs(sum(r["taken"] for r in out if r["source"] == s) - t) <= 0.5


def test_schedules_are_inverted(docs):
    out = mixing.mix(docs, schedules={"s1": [(0, 0), (1, 2)], "s2": [(0, 1), (0.5, 0), (1, 0)]})
    late, early = ([p for r in out.where(F.col("source") == s).collect() for p in r["positions"]] for s in ("s1", "s2"))
    assert np.mean(late) > 0.5 and max(early) <= 0.5
    order = [r["position"] for r in mixing.training_order(out).collect()]
    assert order == sorted(order)


def test_positions_are_training_progress(docs):
    """At position x the share x of all words has been read, and the words read between two positions follow the schedules."""
    cycle = (((0, 3), (0.25, 0), (1, 0)), ((0.5, 0), (1, 4)), 2)
    rows = mixing.mix(docs, cycle=cycle).collect()
    quota = {r["source"]: int(r["target"] + 0.5) for r in rows}
    total = sum(quota.values())
    order = sorted((p, str(r["doc_id"]), min(r["size"], r["taken"] - e * r["size"])) for r in rows for e, p in enumerate(r["positions"]))
    read, longest = 0, max(n for *_, n in order)
    for p, _, n in order:
        assert abs(p * total - read) <= (len(quota) + 1) * longest
        read += n
    assert read == total
    kinds = dict(zip(["s1", "s2", "é", None], [0, 1, 2, 0], strict=True))
    assert [mixing.integrate(c if c != 2 else ((0, 2),))[0] for c in cycle] == pytest.approx([0.375, 1, 2])
    steps = {s: [quota[x] * mixing.demand(cycle[kinds[x]] if kinds[x] != 2 else mixing.STEADY, [0, 0.25, 0.5])[k][0] for x in quota] for k, s in enumerate(("a", "b", "c"))}
    starts = {k: sum(v) / total for k, v in steps.items()}
    for r in rows:
        for p in r["positions"]:
            assert p <= starts["b"] + 1e-9 if kinds[r["source"]] == 0 else p >= starts["c"] - 1e-9 if kinds[r["source"]] == 1 else True


def test_mixed_documents_repeat(docs):
    out = mixing.mixed_documents(docs)
    want = sorted((str(r["doc_id"]), len(r["positions"])) for r in mixing.mix(docs).where("taken > 0").collect())
    assert out.columns == docs.columns and out.count() == sum(n for _, n in want)
    assert Counter(str(r["doc_id"]) for r in out.collect()) == Counter(i for i, n in want for _ in range(n))


def test_secrets_match_regexes():
    rnd = random.Random(3)
    atoms = ["password", "PassWd", "secret", "token", "api_key", "apikey", "=", ":", " ", "'", '"', "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "dead", "é", "-", "_", "token=", "AKI", "abcdefghijkl", "\n", "漢"]
    rules = (
        ("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 12),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    )
    for _ in range(3000):
        text = "".join(rnd.choice(atoms) for _ in range(rnd.randint(0, 14)))
        found = sorted((m.start(), k, f"{kind}:{m.start()}:{m.end()}") for k, (kind, p, ok) in enumerate(rules) for m in p.finditer(text) if ok(m))
        assert secrets.base_sha256(text) == hashlib.sha256(",".join(x[2] for x in found).encode()).hexdigest(), text


def test_secrets_of_rows(docs, empty, spark):
    out = secrets.digest(secrets.scan(docs)).collect()
    assert len(out) == docs.count()
    assert secrets.scan(empty).count() == 0
    long = "é" * 1000 + " token = 'abcdefghijklmnop' " + "a" * 300_000
    row = secrets.digest(secrets.scan(spark.createDataFrame([(1, long)], "doc_id int, text string"))).first()
    assert row["spans"].startswith("assign:1001:1026,hex:") and row["n_assign"] == 1


@pytest.mark.parametrize("pattern", ["a(b|cd)*e", "[^a-c]x{2,3}", "a?b+|c{2}", r"\x41\.[0-9]{2,}", "(ab|a)(c|bcd)"])
def test_automata(pattern):
    rnd = random.Random(4)
    one = automaton.compile_automaton([automaton.parse(pattern)], search=False)
    for _ in range(400):
        text = "".join(rnd.choice("abcdexA.09") for _ in range(rnd.randint(0, 7)))
        longest = max((n for n in range(len(text) + 1) if re.fullmatch(pattern, text[:n])), default=-2)
        assert automaton.longest(one, text.encode(), 0, len(text)) == longest


def test_language(spark, docs, empty):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    out = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").toPandas()
    held = out[out.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.9 and out.score.between(0, 1).all()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held.itertuples())
    odd = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs).collect()}
    assert [odd[i] for i in (40, 41, 42, 43)] == ["und"] * 4 and odd[44] != "und"
    assert langid.identify(empty).count() == 0
    kept = langid.in_a_language(docs)
    assert kept.schema.names == docs.schema.names and langid.in_a_language(empty).count() == 0
    want = sorted((str(r["doc_id"]), r["text"], r["spans"], odd[r["doc_id"]]) for r in docs.collect() if odd[r["doc_id"]] != "und")
    assert sorted((str(r["doc_id"]), r["text"], r["spans"], r["lang"]) for r in kept.collect()) == want
    only = langid.in_a_language(docs, wanted=["fr"], least=0.3).collect()
    assert {r["lang"] for r in only} == {"fr"} and len(only) < len(want)


def test_samples_are_never_empty(spark):
    for n in (1, 10**3, 1 << 36, 1 << 60):
        assert 0 < common.keep_below(20_000, n) <= common.HASHES
    assert common.keep_below(20_000, 1 << 36) / common.HASHES == pytest.approx(20_000 / (1 << 36), rel=1e-3)
    german = "der schatz und die zeit wege"
    for rows in ([(i, german, "de") for i in range(300)], [(None, german, "de")] * 300, [(1, german, "de")] * 300):
        df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
        model = langid.train(df, sample=20)
        assert {r["lang_pred"] for r in langid.label(df, model).collect()} == {"de"}


def test_scripts_go_by_code_point():
    text = "Ա ա א \u0591 Ͱ α я \U00020000 x 漢".encode()
    data = np.frombuffer(text + b" ", np.uint8)
    words_ = langid.Features()(data)
    assert [langid.NAMES[k] for k in words_[-1]] == ["armenian", "armenian", "hebrew", "hebrew", "greek", "greek", "cyrillic", "han", "latin", "han"]


def test_long_texts_are_scored_in_segments():
    rng = np.random.default_rng(2)
    model = langid.Model(("a", "b", "c"), rng.random((3 * langid.SLOTS, 3)).astype(np.float32), np.ones((len(langid.NAMES), 3), bool))
    text = " ".join("".join(rng.choice(list("abcdé漢"), rng.integers(1, 9))) for _ in range(3000)) + " "
    data, features = np.frombuffer(text.encode(), np.uint8), langid.Features()
    whole, parts = langid.scored(model, features, data), langid.scored(model, features, data, segment=100)
    assert (whole[0] == parts[0]).all() and np.allclose(whole[1], parts[1])
    assert np.allclose(whole[1], langid.word_scores(model, features(data)))
    unbroken = np.frombuffer(("漢" * 500 + " ").encode(), np.uint8)
    assert len(langid.scored(model, features, unbroken, segment=100)[0]) > 10


def test_mixed_texts_get_spans(spark):
    rnd = random.Random(6)
    say = lambda w, n: " ".join(rnd.choice(w) for _ in range(n))
    a, b = ["the", "house", "with", "water", "thing"], ["der", "schatz", "und", "zeit", "wege"]
    rows = [(i, say(a if i % 2 else b, 50), "a" if i % 2 else "b") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.train(df)
    mixed = spark.createDataFrame([(1, say(a, 40) + " " + say(b, 25) + " " + say(a, 10))], "doc_id bigint, text string")
    row = langid.label(mixed, model).first()
    assert [tuple(s) for s in row["spans"]] == [(0, 40, "a"), (40, 65, "b"), (65, 75, "a")] and row["lang_pred"] == "a"


@pytest.mark.parametrize("n", [3, 5, 8])
def test_short_stretches_get_spans(spark, n):
    rnd = random.Random(n)
    say = lambda w, n: " ".join(rnd.choice(w) for _ in range(n))
    words_of = {"en": ["the", "house", "with", "water", "thing"], "de": ["der", "schatz", "und", "zeit", "wege"], "ru": ["дом", "вода", "это", "время", "слово"]}
    rows = [(i, say(words_of[x], 50), x) for i, x in enumerate(list(words_of) * 30)]
    model = langid.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    texts = [(i, f"{say(words_of['en'], 30)} {say(words_of[x], k)} {say(words_of['en'], 30)}") for i, (x, k) in enumerate([("ru", n), ("de", n), ("ru", 1)])]
    out = langid.label(spark.createDataFrame(texts, "doc_id bigint, text string"), model).orderBy("doc_id").collect()
    for row, (x, k) in zip(out, [("ru", n), ("de", n), ("ru", 1)], strict=True):
        assert [tuple(s) for s in row["spans"]] == [(0, 30, "en"), (30, 30 + k, x), (30 + k, 60 + k, "en")] and row["lang_pred"] == "en"


def test_copies_are_sampled_one_by_one(spark):
    df = spark.createDataFrame([(i, f"text of language {i % 5}", f"l{i % 5}") for i in range(1000)], "doc_id bigint, text string, lang string")
    assert langid.train(df, sample=100).languages == ("l0", "l1", "l2", "l3", "l4")


def test_viterbi_is_exact():
    rng = np.random.default_rng(0)
    for case in range(600):
        n = rng.integers(0, 14, 3)
        begin = np.concatenate(([0], np.cumsum(n)))
        e = rng.normal(0, 3, (int(begin[-1]), 3)) if case % 2 else -rng.integers(0, 7, (int(begin[-1]), 3)).astype(float)
        path = langid.viterbi(e, begin, 5.0)
        for i in range(3):
            own, p = e[begin[i] : begin[i + 1]], path[begin[i] : begin[i + 1]]
            if n[i]:
                v = own[0]
                for t in range(1, n[i]):
                    v = np.maximum(v, v.max() - 5.0) + own[t]
                assert own[np.arange(n[i]), p].sum() - 5.0 * (p[1:] != p[:-1]).sum() == pytest.approx(v.max())


@pytest.mark.parametrize("block, part", [(1 << 24, 1 << 21), (3000, 700)])
def test_model_scores(spark, docs, empty, texts, monkeypatch, block, part):
    monkeypatch.setattr(lm_score, "BLOCK", block)
    monkeypatch.setattr(lm_score, "PART", part)
    good = docs.where("doc_id % 5 = 0").select("doc_id")
    out = {r["doc_id"]: r for r in lm_score.cross_entropy_difference(docs, good).where("doc_id is not null").collect()}
    uni, bi = (Counter(), Counter()), (Counter(), Counter())
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])] * 2 + [(None, "null id")]
    for i, t in rows:
        w = words(t)
        for k in (0, 1) if i is not None and i % 5 == 0 else (0,):
            uni[k].update(w)
            bi[k].update(zip(w, w[1:]))
    total = [sum(u.values()) for u in uni]
    for i, t in enumerate(texts):
        w, loss = words(t), []
        if not w:
            continue
        one, two = Counter(w), Counter(zip(w, w[1:]))  # a document's own words say nothing about it
        mine = (1, int(i % 5 == 0))
        c1 = [{x: uni[k][x] - mine[k] * one[x] for x in one} for k in (0, 1)]
        c2 = [{x: bi[k][x] - mine[k] * two[x] for x in two} for k in (0, 1)]
        n_b, n_t = (total[k] - mine[k] * len(w) for k in (0, 1))
        p_b = [(c1[0][x] + 0.5) / (n_b + 2**19) for x in w]
        p_t = [p if c1[0][x] < 2 else (c1[1][x] + 1000 * p) / (n_t + 1000) for x, p in zip(w, p_b)]
        for k, p, s in ((1, p_t, 1), (0, p_b, min(1, n_t / n_b))):
            after = [(s * c2[k][v, x] + 10 * q) / (s * c1[k][v] + 10) for v, x, q in zip(w, w[1:], p[1:])]
            loss.append(-np.log([p[0], *after]).mean())
        assert (out[i]["ce_target"], out[i]["ce_background"]) == pytest.approx(loss, rel=1e-9)
        assert out[i]["score"] == pytest.approx(loss[0] - loss[1], abs=1e-9)
    assert out[40]["n_words"] == 0 and out[40]["score"] is None
    assert lm_score.cross_entropy_difference(empty, empty).count() == 0
    alone = lm_score.cross_entropy_difference(docs, empty)
    assert alone.count() == docs.count() and alone.where("score is null and n_words > 0").count() == 0


def test_lm_memory(monkeypatch):
    """A block and a part take little memory beside what they get and give, and slices and steps of any size give the same."""
    rnd = np.random.default_rng(8)
    texts = [" ".join(f"w{x:06x}" for x in rnd.integers(0, 1 << 17, n)) for n in rnd.integers(0, 1200, 800)]
    docs = pa.table({"block": pa.array([3] * 800, pa.int64()), "doc_id": range(800), "text": texts})
    good = docs.select(["doc_id"]).slice(0, 300)

    def traced(f, *args):
        tracemalloc.start()
        try:
            return f(*args), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    def run():
        asked = lm_score._ask(5)(docs, good)
        told, of_part = zip(*(traced(lm_score._answer(3), pa.concat_tables([x.take([i]) for x in (asked, other, more)])) for i in range(5)))
        told = pa.concat_tables(told)
        told = pa.concat_tables([told.filter(pc.equal(told["block"], 3)), pa.table({"target": good["doc_id"]})], promote_options="default")
        out, of_block = traced(lm_score._score(["doc_id", "n_words", "a", "b", "c"], 10**6, 10**5, 2, 10.0, 1000.0, 1e5), docs, told)
        return asked, told, out, max(of_part), of_block

    # other blocks that ask for the same keys, as often as they like
    other = lm_score._ask(5)(docs.set_column(0, "block", pa.array([4] * 800, pa.int64())), good)
    more = lm_score._ask(5)(docs.set_column(0, "block", pa.array([5] * 800, pa.int64())).slice(100, 500), good)
    keys = max(len(k.as_py()) for k in other["keys"]) / 8 * 3
    first = run()
    assert first[4] < 16 * docs["text"].nbytes, f"{first[4] / docs['text'].nbytes} bytes a byte of text"
    monkeypatch.setattr(lm_score, "STEP", 1 << 14)
    assert (most := run()[3]) < 40 * keys, f"{most / keys} bytes a key of a part"
    for slice_, step in ((1 << 12, 1 << 10), (1 << 26, 1 << 26)):
        monkeypatch.setattr(lm_score, "SLICE", slice_)
        monkeypatch.setattr(lm_score, "STEP", step)
        assert all(x.equals(y) for x, y in zip(first[:3], run()[:3], strict=True))
    counts = Counter(w for t in texts for w in words(t))
    told, n = first[1].filter(pc.is_valid(first[1]["part"])).sort_by("part"), Counter()
    for k, x in zip(first[0].sort_by("part")["keys"], told["n"], strict=True):
        whole = [[int.from_bytes(v[i::size], "big") for i in range(size)] for v, size in ((k.as_py(), len(k.as_py()) // 8), (x.as_py(), len(x.as_py()) // 3))]
        n.update(dict(zip(*whole, strict=True)))
    hasher = common.WordHasher()
    again = Counter(w for t in texts[100:600] for w in words(t))
    for w in sorted(counts)[:500]:
        h = common.word_hashes(hasher, np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0]
        assert n[int(h[0])] == 2 * counts[w] + again[w]


def test_licenses(spark, docs, empty):
    mit = licenses.TEMPLATES["MIT-text"].split()
    cut = mit[:40] + ["oddly"] + mit[41:]
    rows = [(1, "Released under the MIT License."), (2, "ab " * 50 + " ".join(cut) + " cd" * 50), (3, "x LICENSED under, the Apache License; version 2.0"), (4, " ".join(mit[:30])), (5, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {(r["doc_id"], r["license"]): r["containment"] for r in licenses.scan(df).collect()}
    assert out[1, "MIT"] == out[3, "Apache-2.0"] == 1.0 and 0.9 < out[2, "MIT-text"] < 1
    assert {i for i, _ in out} == {1, 2, 3}
    assert licenses.scan(docs).count() == 0 and licenses.scan(empty).count() == 0
    odd = spark.createDataFrame([(None, rows[0][1], "x"), (None, "nothing here", "x"), (7, rows[0][1], "x"), (7, rows[2][1], "y"), (7, rows[2][1], "y")], "doc_id bigint, text string, license string")
    found = {(r["doc_id"], r["license"], r["passage"]) for r in licenses.scan(odd).collect()}
    assert {f[:2] for f in found} == {(None, "MIT"), (7, "MIT"), (7, "Apache-2.0")} and (7, "MIT", "released under the mit license") in found


def _contained(text, template):
    words_ = lambda t: re.findall("[a-z0-9]+", t.lower())
    cut = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    own = cut(words_(template))
    return len(own & cut(words_(text))) / len(own)


def test_license_recall(spark):
    """Of altered notices that still hold 0.8 to 1 of a template's shingles nearly all are found, with the exact containment."""
    rnd = random.Random(21)
    rows, want = [], {}
    filler = [f"word{i}" for i in range(500)]
    for name, text in licenses.TEMPLATES.items():
        for _ in range(12):
            w = text.split()
            for _ in range(rnd.randint(0, max(1, len(w) // 40))):
                w[rnd.randrange(len(w))] = rnd.choice(filler)
            doc = " ".join(rnd.choices(filler, k=rnd.randint(0, 60))) + " " + " ".join(w) + " " + " ".join(rnd.choices(filler, k=rnd.randint(0, 60)))
            rows.append((len(rows), doc))
            want |= {(rows[-1][0], n): c for n, t in licenses.TEMPLATES.items() if (c := _contained(doc, t)) >= 0.8}
    out = {(r["doc_id"], r["license"]): r["containment"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(c == pytest.approx(want[k]) for k, c in out.items())
    assert len(out) >= 0.99 * len(want)


def test_toxicity(spark, docs, empty):
    d, labels = queries.table(spark, SF.replace("0.001", "0.01"), "documents"), queries.table(spark, SF.replace("0.001", "0.01"), "labels")
    out = toxicity.toxicity(d, labels).join(labels, "doc_id", "left").toPandas()
    held = out[out.held_out & out.toxic.notna()]
    assert (held.predicted == held.toxic).mean() > 0.95 and out.score.between(0, 1).all()
    marks = spark.createDataFrame([(i, 1, i % 2) for i in range(30)] + [(1, 1, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert toxicity.toxicity(docs, marks).count() == docs.count()
    assert toxicity.toxicity(empty, marks).count() == 0 and toxicity.toxicity(docs, marks.limit(0)).count() == docs.count()


def test_mostly_toxic_labels(spark):
    rnd = random.Random(9)
    say = lambda w, n: " ".join(rnd.choice(w) for _ in range(n))
    filler = [f"word{i}" for i in range(50)]
    rude, calm = ["vile", "scum", "filth", "idiot"], ["kindly", "garden", "thanks", "recipe"]
    rows = [(i, say(rude if i % 10 < 7 else calm, 4) + " " + say(filler, 20), int(i % 10 < 7)) for i in range(400)]
    # a quoted toxic word among clean wording: the wording decides
    rows += [(400 + i, say(calm, 6) + " " + say(rude, 1) + " " + say(filler, 20), 0) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    out = toxicity.toxicity(df.select("doc_id", "text"), df.select("doc_id", "toxic")).join(df, "doc_id").toPandas()
    held = out[out.held_out]
    assert set(held.toxic) == {0, 1} and (held.predicted == held.toxic).all()
    assert (out.evidence.str.len() > 0).all()


def test_scores_by_brute_force(spark):
    """Votes, calibration and scores from dense vectors of all terms that the index holds."""
    rnd = random.Random(12)
    rude, calm, filler = ["vile", "scum", "filth", "idiot", "vileness"], ["kindly", "garden", "thanks", "recipe"], [f"word{i}" for i in range(60)]
    rows = []
    for i in range(500):
        bad = i % 3 == 0
        own = [rnd.choice(rude if bad else calm) for _ in range(rnd.randint(0, 3))] + ([rnd.choice(calm + rude)] if rnd.random() < 0.3 else [])
        rows.append((i, " ".join(own + [rnd.choice(filler) for _ in range(15)]), int(bad)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    index = toxicity.train(toxicity.sampled(df, df), k=7)
    find, known = toxicity.Terms(), toxicity._known(index.vocabulary)

    def vector(text):
        data = np.frombuffer(text.encode() + b" ", np.uint8)
        ((slots, tf),) = toxicity._slots(index.vocabulary, known, *find(data, np.array([0, len(data)])), 1)
        out = np.zeros(len(index.vocabulary))
        if len(slots):
            out[slots] = index.vector(slots, tf)
        return out

    dense, label = np.array([vector(t) for _, t, _ in rows]), np.array([y for *_, y in rows])
    base = (label.sum() + 0.5) / (len(label) + 1)
    order = {}  # entries stand in the index's order, their examples are one another's ties
    for e, i in enumerate(index.ids):
        order[np.round(dense[i], 12).tobytes()] = e

    def vote(i, among):
        cos = np.round(dense[among] @ dense[i], 12)
        near = sorted((-c, order[np.round(dense[j], 12).tobytes()], j) for c, j in zip(cos, among, strict=True) if c > 0)
        left, weight, total = 7, 1.0, base
        for entry in dict.fromkeys(x[1] for x in near):
            same = [x for x in near if x[1] == entry]
            take = min(left, len(same))
            left -= take
            w = take * same[0][0] ** 2
            weight, total = weight + w, total + w * np.mean([label[x[2]] for x in same])
        return total / weight

    full = [i for i in range(len(rows)) if dense[i].any()]
    votes = np.array([vote(i, [j for j in full if j != i]) for i in full])
    steps = []  # pooled by brute force: the largest of the least means
    values = np.unique(np.round(votes, 9))
    n = np.array([(np.abs(votes - v) < 1e-8).sum() for v in values])
    t = np.array([label[np.array(full)[np.abs(votes - v) < 1e-8]].sum() for v in values])
    for i in range(len(values)):
        steps.append(max(min(t[a : b + 1].sum() / n[a : b + 1].sum() for b in range(i, len(values))) for a in range(i + 1)))
    means = [(np.average(values[np.isclose(steps, s)], weights=n[np.isclose(steps, s)]), s, n[np.isclose(steps, s)].sum()) for s in sorted(set(np.round(steps, 12)))]
    x, y = [m[0] for m in means], np.maximum.accumulate([(m[1] * m[2] + base) / (m[2] + 1) for m in means])
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, index, k=7).collect()}
    empty_n, empty_bad = sum(not d.any() for d in dense), sum(int(y_) for d, y_ in zip(dense, label, strict=True) if not d.any())
    for i in range(len(rows)):
        want = np.interp(vote(i, full), x, y) if dense[i].any() else (empty_bad + base) / (empty_n + 1)
        assert got[i] == pytest.approx(want, abs=1e-6), i


def test_family_wise_level():
    for n in (1, 240_000, 10**8):  # the tail of chi square with one degree of freedom
        assert n * math.erfc(math.sqrt(toxicity.least_ratio(n) / 2)) == pytest.approx(toxicity.LEVEL, rel=1e-6)


def test_nearest_is_exact():
    rng = np.random.default_rng(7)
    vocabulary, idf = np.arange(40, dtype=np.uint64), rng.random(40) + 1
    rows = []
    for i in range(400):
        slots = np.sort(rng.choice(40, rng.integers(0, 6), replace=False)).astype(np.int64)
        rows.append((i, int(rng.random() < 0.3), slots, rng.integers(1, 4, len(slots))))
    index = toxicity.build_index(vocabulary, idf, rows)
    dense = np.zeros((400, 40))
    for i, _, slots, tf in rows:
        if len(slots):
            dense[i, slots] = index.vector(slots, tf)
    for _, _, slots, tf in rows[:100]:
        if len(slots):
            query = np.zeros(40)
            query[slots] = index.vector(slots, tf)
            best = np.sort((dense @ query)[dense.any(1)])[::-1]
            entries, cosines = index.nearest(slots, index.vector(slots, tf), 20)
            got = np.repeat(cosines, index.examples[entries])[:20]
            want = best[:20][best[:20] > 1e-12]
            assert got[: len(want)] == pytest.approx(want)


@pytest.mark.parametrize("block", [1024, 8])
def test_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((6, 16))
    v = centres[rng.integers(0, 6, 150)] + rng.normal(0, 0.18, (150, 16))
    v = np.concatenate((v, v[:5], v[5:8] * 1e-160)).tolist()
    bad = [None, [0.0] * 16, [float("nan")] * 16, [None] * 16, [float("inf")] + [0.0] * 15, []]
    label = [None if i == 7 else i % 2 for i in range(len(v))]
    rows = [(i, x, y, "clash") for i, (x, y) in enumerate(zip(v + bad, label + [0] * len(bad), strict=True))]
    out = vectors.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, rep string")).orderBy("vec_id").collect()
    unit = np.array(v)
    unit /= np.abs(unit).max(1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    same = np.array([[a is not None and a == b for b in label] for a in label])
    link = (unit @ unit.T >= 0.93) & same & ~np.eye(len(v), dtype=bool)
    root = np.arange(len(v))
    for _ in range(len(v)):
        root = np.array([min(root[i], *root[link[i]]) if link[i].any() else root[i] for i in range(len(v))])
    found = sum(r["n_links"] for r in out)
    assert found >= 0.99 * link.sum() and all(r["n_links"] <= n for r, n in zip(out, link.sum(1), strict=False))
    if found == link.sum():
        assert [r["component_id"] for r in out[: len(v)]] == root.tolist()
    assert all(r["n_links"] == 0 and r["kept"] for r in out[len(v) :])


def test_packing(docs, empty, texts):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    own = Tokenizer.from_file(path)
    out = packing.pack_documents(docs, path, with_ids=True)
    rows = out.collect()
    ids = {i: own.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values())) + 2 * len(ids[3]) + len(own.encode("null id").ids) + 1
    for r in rows:
        if r["doc_id"] is not None:
            part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
            assert list(r["ids"]) == part and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes()) and r["length"] <= 1024
            assert r["piece"] == 0 or r["length"] == 1024
    full = {}
    for r in rows:
        full.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in full.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 1024
    assert len(full) <= -(-sum(r["length"] for r in rows) // 1024) + 2
    assert packing.sequences(out).count() == len(full)
    assert packing.pack_documents(empty, path).count() == 0


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|endoftext|> b", "don't  \n\n x y ", "漢字 ١٢٣ 😀", "'s 'S 12ab", " " * 3000, "ab" * 3000])
def test_encoder_is_the_tokenizer(text):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    assert list(packing.encoder(path)(text)) == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_sums_are_indexed():
    counts = np.bincount([1, 2, 3, 3, 5, 7], minlength=13)
    sums = packing.Sums(counts)
    held = [x for x in range(13) if counts[x]]
    for total in range(2, 13):
        assert sorted(sums.pairs.get(total, [])) == sorted((a, b) for a in held for b in held if a >= b and a + b == total)
        assert sums.triples.get(total, []) == sorted({a for a in held for b in held for c in held if a >= b >= c and a + b + c == total})
    assert sums.single(5, 7) == (5,) and sums.single(7, 5) is None and sums.pair(10, 7) is None and sums.pair(9, 3) is None and sums.pair(5, 7) == (3, 2)
    assert sums.triple(11, 7) == (5, 3, 3) and sums.triple(9, 3) is None


def test_other_tokenizers_are_left_alone():
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        spec = json.load(f)
    assert packing.is_plain(spec)
    assert not packing.is_plain(spec | {"normalizer": {"type": "NFC"}})
    assert not packing.is_plain(spec | {"pre_tokenizer": {"type": "Whitespace"}})
    model = spec["model"]
    assert not packing.is_plain(spec | {"model": model | {"merges": model["merges"][1:2] + model["merges"][:1] + model["merges"][2:]}})


@pytest.mark.parametrize("case", range(5))
def test_plans_use_every_piece_once(case):
    rng = np.random.default_rng(case)
    lengths = [rng.integers(1, 1025, 3000), rng.integers(400, 1025, 500), np.full(1000, 1), np.concatenate((np.full(700, 341), rng.integers(500, 700, 100))), np.empty(0, int)][case]
    counts = np.bincount(lengths, minlength=1025)
    patterns = packing.plan(counts)
    used = np.zeros(1025, int)
    bound = max(-(-int(lengths.sum()) // 1024), int((lengths > 512).sum()))
    if case == 3:  # a long piece leaves room for one of 341 at most, other sequences hold three
        bound = 100 + -(-(700 - int((lengths[700:] <= 683).sum())) // 3)
    assert sum(n for _, n in patterns) <= bound * 1.005 + 3
    for pattern, n in patterns:
        assert n > 0 and sum(pattern) <= 1024
        np.add.at(used, list(pattern), n)
    assert (used == counts).all()


def test_empty_tables(spark, empty):
    assert exact_dedup.exact_dedup(exact_dedup.digests(empty)).count() == 0 and exact_dedup.drop_exact_copies(empty).count() == 0
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    assert minhash.near_duplicates(empty).count() == 0 and minhash.drop_near_copies(empty).count() == 0
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


WIDE = "doc_id bigint, text string, extra string, source string, _part int, doc map<string,int>"


@pytest.fixture(scope="module")
def repeats(spark):
    """Null ids, repeated ids, texts that repeat with other columns, a map column."""
    rows = [
        (5, "one two three four five six", "x", "s", 1, {"a": 1}),
        (None, "one two three four five six", "x", "s", 1, None),
        (None, "seven eight nine", "y", None, 2, {}),
        (None, "seven eight  nine", "y", None, 2, {}),
        (7, "seven eight nine", "p", "s", None, None),
        (7, "seven eight nine", "q", "s", None, None),
        (7, "another text of seven", "q", "s", None, None),
        (8, "", "e", "s", None, None),
        (9, None, "e", "s", None, None),
        (None, "null", "n", "s", None, None),
        (10, "null", "n", "s", None, None),
    ]
    return spark.createDataFrame(rows, WIDE).repartition(3)


def test_exact_copies_of_odd_rows(spark, repeats):
    out = sorted((str(r["doc_id"]), r["text"], r["extra"]) for r in exact_dedup.drop_exact_copies(repeats).collect())
    assert out == sorted([("5", "one two three four five six", "x"), ("7", "seven eight nine", "p"), ("7", "another text of seven", "q"), ("8", "", "e"), ("10", "null", "n")])
    texts_ = spark.createDataFrame([("null", "t"), (None, "t"), ("b", "t"), (None, "u"), (None, "u")], "doc_id string, text string")
    assert sorted((str(r["doc_id"]), r["text"]) for r in exact_dedup.drop_exact_copies(texts_).collect()) == [("None", "u"), ("b", "t")]


def test_near_copies_of_odd_rows(spark, repeats):
    out = sorted((str(r["doc_id"]), r["text"], r["extra"]) for r in minhash.drop_near_copies(repeats, words=2).collect())
    assert [x for x in out if x[0] == "None"] == [] and [x[0] for x in out if x[1] == "one two three four five six"] == ["5"]
    assert sum(x[0] == "7" for x in out) == 3  # rows of one id are one document
    null = spark.createDataFrame([(5, "a b c"), (None, "a b c"), (None, "d e f"), (None, "d e f")], "doc_id bigint, text string")
    assert sorted((str(r[0]), r[1]) for r in minhash.drop_near_copies(null, words=2).collect()) == [("5", "a b c"), ("None", "d e f"), ("None", "d e f")]
    for f in (minhash.near_duplicates, toxicity.toxicity):
        with pytest.raises(TypeError):
            f(*[null.withColumn("doc_id", F.lit("x"))] * (1 if f is minhash.near_duplicates else 2))


def test_mixed_documents_of_odd_rows(spark):
    rows = [(1, "a b", "s", "x", {"k": 1}), (1, "a b", "s", "y", {"k": 1}), (2, "c", "s", "z", None), (2, "c", "s", "z", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, extra string, m map<string,int>")
    out = mixing.mixed_documents(df)
    assert out.schema == df.schema and sorted(r["extra"] for r in out.collect()) == ["x", "y", "z", "z"]


@pytest.mark.parametrize("percent", [30, 60, 95])
def test_thresholds(spark, percent):
    rnd = random.Random(percent)
    texts = []
    for _ in range(12):
        base = [str(rnd.randrange(10**6)) for _ in range(rnd.randint(20, 60))]
        for _ in range(5):
            w = base[: rnd.randint(len(base) // 4, len(base))]
            texts.append(" ".join(w + [str(rnd.randrange(10**6)) for _ in range(rnd.randint(0, 4))]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    _, root = similar(texts, range(len(texts)), 3, percent)
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, words=3, percent=percent).collect()} == dict(enumerate(root))
    bands, rows = minhash.banding(percent)
    assert (1 - (percent / 100) ** rows) ** bands < 1.3e-7
