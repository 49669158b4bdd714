"""The queries opN_<name> over the tables of a folder, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, langid, licenses, lm_score, minhash, mixing, packing, secrets, toxicity, vectors


def tokenizer_path() -> str:
    """The tokenizer file of the environment; operators take it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The curriculum: sources of the first kind fade out, of the second fade in, of the third peak half-way; the integrals are 1, 2, 3.
CURRICULUM = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 3.0)), ((0.0, 1.5), (0.5, 4.5), (1.0, 1.5)))


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), cycle=CURRICULUM)
    positions = [F.round(F.get("positions", F.lit(e)), 9).alias(f"position_{e + 1}") for e in range(3)]
    return mixed.select("doc_id", "size", "source_size", "target", "taken", *positions).orderBy("position_1", "doc_id")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return lm_score.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("passage")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), least=0.93)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.digests(table(spark, sf_dir, "documents"))
    return exact_dedup.exact_dedup(rows).drop("_row")


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix,
    "op2_secrets": op2_secrets,
    "op3_langid": op3_langid,
    "op4_lm_score": op4_lm_score,
    "op5_licenses": op5_licenses,
    "op6_minhash": op6_minhash,
    "op7_toxicity": op7_toxicity,
    "op8_vectors": op8_vectors,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_pack": op10_pack,
}


_RULE_SQL = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?)([A-Za-z0-9+/_.=-]+)""", 12),
    "access": (r"(AKIA)([A-Z0-9]+)", 14),
    "hex": (r"()([0-9a-f]+)", 16),
    "forge": (r"((?:gh[pousr]|github_pat)_)([A-Za-z0-9_]+)", 22),
    "chat": (r"(xox[abprs]-)([A-Za-z0-9-]+)", 10),
    "cloud": (r"(AIza)([A-Za-z0-9_-]+)", 35),
    "payment": (r"([sr]k_(?:live|test)_)([A-Za-z0-9]+)", 16),
    "jwt": (r"(eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.)([A-Za-z0-9_-]+)", 8),
    "pem": (r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)([A-Za-z0-9+/=\x20\x09-\x0D]+)", 32),
}


def _secrets_sql() -> str:
    """Matches and the texts between them give the places of the matches."""
    found = "\nUNION ALL\n".join(
        f"""SELECT doc_id, {k} AS k, '{kind}' AS kind, m, sum(length(b) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS e,
       length(regexp_extract(m, '^{pattern}$', 2)) AS body, {least} AS least FROM (
  SELECT doc_id, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(list_slice(bs, 1, len(ms))) AS b FROM (
    SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS bs FROM d))"""
        for k, (kind, (pattern, least)) in enumerate(_RULE_SQL.items())
    )
    joined = "coalesce(string_agg(s, ',' ORDER BY e - length(m), k){}, '')"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS (SELECT *, kind || ':' || CAST(e - length(m) AS BIGINT) || ':' || CAST(e AS BIGINT) AS s FROM ({found}) WHERE body >= least),
g AS (SELECT doc_id, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS b, count(*) FILTER (k = 2) AS c,
  {joined.format(' FILTER (k < 3)')} AS base, {joined.format('')} AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g ON d.doc_id = g.doc_id"""


def _licenses_sql() -> str:
    """Every text against every template: a brute-force search by all shingles."""
    rows = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licenses.TEMPLATES.items())
    words = "regexp_extract_all(lower(coalesce({}, '')), '[a-z0-9]+')"
    cut = "unnest(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) AS g"
    return f"""WITH t AS (SELECT license, {cut} FROM (SELECT license, {words.format('text')} AS w FROM (VALUES {rows}) v(license, text))),
n AS (SELECT license, count(*) AS n FROM t GROUP BY license),
d AS (SELECT doc_id, {cut} FROM (SELECT doc_id, {words.format('text')} AS w FROM documents) WHERE len(w) >= 5)
SELECT doc_id, t.license, count(*) / max(n.n) AS containment FROM d JOIN t ON d.g = t.g JOIN n ON n.license = t.license
GROUP BY doc_id, t.license HAVING count(*) / max(n.n) >= 0.8"""


def _position_sql(epoch: int) -> str:
    """The position of the documents' words in one epoch under ``CURRICULUM``, its integrals and their inverses written out."""
    y = f"(CAST(pos + {epoch} * source_size AS DOUBLE) / quota)"
    # shares of the demand met -> time, by kind of source: s - s^2 / 2, (s + s^2) / 2, and s / 2 + s^2 up to the middle
    at = f"""CASE kind WHEN 0 THEN 2 * {y} / (1.5 + sqrt(greatest(2.25 - 2 * {y}, 0)))
      WHEN 1 THEN 2 * {y} / (0.5 + sqrt(0.25 + 2 * {y}))
      ELSE CASE WHEN {y} < 0.5 THEN 2 * {y} / (0.5 + sqrt(0.25 + 4 * {y}))
        ELSE 0.5 + 2 * ({y} - 0.5) / (1.5 + sqrt(greatest(2.25 - 4 * ({y} - 0.5), 0))) END END"""
    met = """(coalesce(q0, 0) * (1.5 * s - s * s / 2) + coalesce(q1, 0) * (s + s * s) / 2
      + coalesce(q2, 0) * CASE WHEN s < 0.5 THEN s / 2 + s * s ELSE 0.5 + 1.5 * (s - 0.5) - (s - 0.5) * (s - 0.5) END)
      / (coalesce(q0, 0) + coalesce(q1, 0) + coalesce(q2, 0))"""
    return f"""CASE WHEN taken > {epoch} * size AND quota > pos + {epoch} * source_size THEN list_transform([{at}], lambda s: round({met}, 9))[1] END AS position_{epoch + 1}"""


ORACLE_SQL: dict[str, str] = {
    "op5_licenses": _licenses_sql(),
    "op1_mix": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS o FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, CAST(rank % 3 + 1 AS DOUBLE) AS weight, 3 * source_size / CAST(rank % 3 + 1 AS DOUBLE) AS ratio FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(3 * source_size) OVER b, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level FROM w
    WINDOW b AS (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, rank % 3 AS kind, least(CAST(3 * source_size AS DOUBLE),
    (SELECT arg_min(level, (ratio, rank)) FROM l WHERE level <= ratio) * weight) AS target FROM l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.kind, CAST(floor(t.target + 0.5) AS BIGINT) AS quota,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS pos
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, greatest(0, least(size, quota - pos)) + greatest(0, least(size, quota - pos - source_size))
    + greatest(0, least(size, quota - pos - 2 * source_size)) AS taken FROM p),
q AS (SELECT sum(quota) FILTER (kind = 0) AS q0, sum(quota) FILTER (kind = 1) AS q1, sum(quota) FILTER (kind = 2) AS q2 FROM (
    SELECT source, kind, floor(target + 0.5) AS quota FROM t) z)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(taken AS BIGINT) AS taken,
    """
    + ", ".join(_position_sql(e) for e in range(3))
    + """
FROM k, q""",
    "op2_secrets": _secrets_sql(),
    "op6_minhash": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
u AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN m ON m.a = d.doc_id""",
    "op8_vectors": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
    WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, m.component_id, v.vec_id = m.component_id AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id JOIN m ON m.a = v.vec_id""",
    "op9_exact_dedup": r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)""",
}
