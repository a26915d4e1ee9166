"""The registered queries of this package and, where SQL can express one, its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from rivulet.llm import (ann, bpe, langid, licenses, packing, periodic, phrases, quality, simhash, suffix_dedup,
                         token_counts, topk, vector_dedup)
from rivulet.llm.common import crc_remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op6_exact_top_k", TOP_K_SQL)
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.exact_top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256.0)


@query("op9_simhash_near_duplicates")
def op9_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs, words=3, radius=2).select(
        "doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def vocabulary(name: str = "word_bpe_49k.json") -> bytes:
    """The vocabulary file, read by the driver and handed to the tasks."""
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


@query("op5_bpe_round_trip")
def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, data = table(spark, sf_dir, "documents"), vocabulary()
    lexicon = bpe.build_lexicon(docs, data, size=131_072)
    return bpe.round_trip(docs, data, lexicon).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary()).withColumn(
        "over_limit", F.col("n_tokens") > 2048)


REPEATS_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (
  SELECT doc_id, p, substring(h, CAST(2 * p + 1 AS BIGINT), 100) AS s
  FROM (SELECT doc_id, h, UNNEST(range(0, length(h) // 2 - 49)) AS p FROM d WHERE length(h) >= 100) u),
m AS (SELECT s, MIN(doc_id) AS first_doc FROM g GROUP BY s),
c AS (
  SELECT DISTINCT g.doc_id, g.p FROM g JOIN m ON g.s = m.s WHERE m.first_doc < g.doc_id),
r AS (
  SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 1 ELSE 0 END AS fresh
  FROM c),
runs AS (SELECT doc_id, p, SUM(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM r),
spans AS (SELECT doc_id, run, MIN(p) AS a, MAX(p) + 50 AS b FROM runs GROUP BY doc_id, run),
edges AS (
  SELECT doc_id, b AS k0, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS k1 FROM spans
  UNION ALL SELECT doc_id, 0, MIN(a) FROM spans GROUP BY doc_id),
kept AS (
  SELECT e.doc_id, string_agg(substring(h, CAST(2 * k0 + 1 AS BIGINT),
           CAST(2 * (coalesce(k1, length(h) // 2) - k0) AS BIGINT)), '' ORDER BY k0) AS h
  FROM edges e JOIN d ON e.doc_id = d.doc_id GROUP BY e.doc_id),
total AS (SELECT doc_id, SUM(b - a) AS gone, COUNT(*) AS n FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(t.gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(t.n, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM d LEFT JOIN total t ON d.doc_id = t.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


@query("op3_suffix_dedup", REPEATS_SQL)
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), match=50)
    lost = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", lost.alias("n_removed"),
                        F.size("spans").cast("bigint").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_projected_neighbours")
def op2_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest_neighbours(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@query("op10_crf_language")
def op10_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_remainder("doc_id", 4) == 2
    field = langid.fit_field(docs.where(~held_out).select("doc_id", "text", "lang"))
    return langid.label_languages(docs.select("doc_id", F.coalesce(held_out, F.lit(False))
                                              .alias("held_out"), "text"), field).drop("text")


@query("op4_rule_quality")
def op4_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_remainder("doc_id", 5) == 0
    stats, rules = quality.fitted_rules(docs, labels, ~held_out)
    return stats.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"),
                        rules.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int"))


@query("op1_length_buckets")
def op1_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_tokens(table(spark, sf_dir, "documents"), vocabulary(), max_len=2048, buckets=16,
                               budget=65_536)


@query("op7_license_scan")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), containment=0.8)


VECTOR_GROUPS_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
  SELECT a, a AS r FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.r = links.a),
least AS (SELECT a, MIN(r) AS component FROM reach GROUP BY a),
degree AS (SELECT a, COUNT(*) AS n FROM links GROUP BY a)
SELECT m.vec_id, coalesce(d.n, 0) AS n_links, coalesce(l.component, m.vec_id) AS component_id,
       coalesce(l.component, m.vec_id) = m.vec_id AS kept
FROM embeddings m LEFT JOIN degree d ON m.vec_id = d.a LEFT JOIN least l ON m.vec_id = l.a
"""


@query("op11_vector_near_duplicates", VECTOR_GROUPS_SQL)
def op11_vector_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the words of one document in ten, by crc32 of its id, repeat from some word on."""
    words = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"),
                        F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("w"))
    shape = words.where("h % 10 = 0 AND size(w) > 0").withColumn("g", F.expr("h div 10")).withColumn(
        "a", F.expr("g % size(w)")).withColumn("p", F.expr("1 + (size(w) - a) div (3 + g % 8)"))
    planted = shape.select("doc_id", F.expr(
        "array_join(transform(w, (x, i) -> CASE WHEN i < a THEN x ELSE w[int(a + (i - a) % p)] END), ' ')"
    ).alias("text"))
    return planted.union(words.where("NOT coalesce(h % 10 = 0 AND size(w) > 0, false)").select("doc_id", "text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(table(spark, sf_dir, "documents"))
    found = periodic.periodic_runs(docs, least_length=6, least_exponent=4)
    # the longest run; of equal ones the first, then the shortest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"),
        "best.length", (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


PHRASES_SQL = """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, UNNEST(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d) p),
g AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, UNNEST(range(1, len(w) - m + 2)) AS i
        FROM w, (SELECT UNNEST(range(1, 5)) AS m) o WHERE len(w) >= m) u),
c AS (SELECT lang, m, phrase, COUNT(*) AS f FROM g GROUP BY lang, m, phrase),
total AS (SELECT lang, SUM(f) AS n FROM c WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f AS a FROM c WHERE m > 1 AND f >= 30),
inner_parts AS (
  SELECT lang, a AS longer, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, a, w, k, UNNEST(range(1, m - k + 2)) AS i
        FROM cand, (SELECT UNNEST(range(2, 4)) AS k) o WHERE k < m) u),
most AS (SELECT lang, phrase, MAX(longer) AS longer FROM inner_parts GROUP BY lang, phrase),
kept AS (
  SELECT x.* FROM cand x LEFT JOIN most ON x.lang = most.lang AND x.phrase = most.phrase
  WHERE coalesce(100 * CAST(most.longer AS HUGEINT) < 80 * CAST(x.a AS HUGEINT), true)),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
  FROM kept, (SELECT UNNEST(range(1, 4)) AS k) o WHERE k < m),
scored AS (
  SELECT u.lang, u.phrase, u.a, u.k, l.f AS l, r.f AS r,
         CAST(2000000 * CAST(u.a AS HUGEINT) // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
  FROM cuts u JOIN c l ON u.lang = l.lang AND u.head = l.phrase JOIN c r ON u.lang = r.lang AND u.rest = r.phrase),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, CAST(t.n AS BIGINT) AS n, k.score
FROM ranked k JOIN total t ON k.lang = t.lang WHERE k.rank <= 2000
"""


@query("op13_collocations", PHRASES_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=30, longest=4, contain=(80, 100), top=2000)
