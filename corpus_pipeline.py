"""The corpus pipeline: language, quality, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read
again as the next stage's documents. All but the last keep the columns of documents.
The near-duplicate stage judges rows by their texts: rows without doc_id, or that share
one, are documents of their own there. What a stage stores on its way is dropped when the next
stage starts on stored documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm import langid, packing, quality, queries, simhash, suffix_dedup
from rivulet.llm.common import free_name, settle, table
from rivulet.sources.tables import remove, settled_in

LEAST_EVIDENCE = 0.37  # that the words of a document are in some language or other, from 0 to 1
LEAST_QUALITY = 0.3
SIMHASH_LANES = 8  # 512 bits
SIMHASH_RADIUS = 112  # bits that candidates differ in at most; misses 1 in 10,000 pairs at similarity 0.8
SIMILARITY = 0.8  # of the sets of five-word shingles, by which near duplicates are judged
MATCH_BYTES = 50
MAX_TOKENS, BUCKETS, BATCH_TOKENS = 2048, 16, 65_536


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
FOLDERS: dict[str, list[str]] = {}  # of stages that have run, by application


def stage(work: Stage) -> Stage:
    """The stage with a folder for its tables; folders of earlier stages go, but those that docs is read from."""
    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        left = FOLDERS.setdefault(spark.sparkContext.applicationId, [])
        read = docs.inputFiles() if left else []
        for folder in [f for f in left if not any(f.rsplit("/", 1)[1] in file for file in read)]:
            remove(spark, folder)
            left.remove(folder)
        with settled_in(spark, work.__name__) as folder:
            left.append(folder)
            return work(spark, docs, sf_dir)

    return run


@stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and those whose words look like no language more than another.

    Where no row has text and lang, no language can be learned and every text with a letter stays.
    """
    field = langid.fit_field(docs.select("text", "lang"))
    if not field.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    verdict = free_name(docs, "verdict")
    judged = docs.withColumn(verdict, langid.language_verdicts(spark, field)("text"))
    return judged.where((F.col(f"{verdict}.lang_pred") != "und")
                        & (F.col(f"{verdict}.evidence") >= LEAST_EVIDENCE)).drop(verdict)


@stage
def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that the rules score below LEAST_QUALITY; NULL and empty texts are scored, too."""
    labels = quality.labels_by_id(table(spark, sf_dir, "labels"))
    labelled = docs.select("doc_id", "text").join(labels, "doc_id")
    rules = quality.fit_rules(quality.with_statistics(labelled).drop("text"))
    field = free_name(docs, "statistics")
    return quality.with_statistics(docs, field=field).where(rules.score(field) >= LEAST_QUALITY).drop(field)


@stage
def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: smallest id, then hash of the text.

    Rows without id come last. Links chain: the ends of a group may be less alike than its links.
    """
    # a key for each row, stored so that a repeated task gives the same
    key = free_name(docs, "row")
    rows = settle(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    groups = simhash.similar_groups(rows.select(F.col(key).alias("row"), "text"), words=5,
                                    radius=SIMHASH_RADIUS, lanes=SIMHASH_LANES, similarity=SIMILARITY,
                                    id_col="row")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), F.xxhash64(*docs.columns), key)
    keep = rows.select(F.col(key).alias("row"), order.alias("first")).join(groups, "row").groupBy(
        "component_id").agg(F.min("first").alias("first")).select(F.col(f"first.{key}").alias(key))
    return rows.join(keep, key, "left_semi").select(*docs.columns)


@stage
def fresh_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that a document of smaller id has too; a character cut in two goes whole.

    A NULL text becomes empty. n_chars is counted anew.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    held = [f"held_{k}" for k in range(len(others))]
    lean = docs.select("doc_id", "text", *[F.col(c).alias(h) for c, h in zip(others, held)])
    found = suffix_dedup.remove_repeats(lean, match=MATCH_BYTES, carry=tuple(held), whole=True)
    cut = found.select("doc_id", F.col("kept").cast("string").alias("text"),
                       *[F.col(h).alias(c) for c, h in zip(others, held)]).withColumn(
        "n_chars", F.char_length("text").cast("bigint"))
    return cut.select(*docs.columns)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches for training, by the tokens of the public vocabulary."""
    return packing.pack_tokens(docs, queries.vocabulary(), max_len=MAX_TOKENS, buckets=BUCKETS,
                               budget=BATCH_TOKENS)


STAGES = [("language", language), ("quality", clean), ("near_duplicates", distinct),
          ("passages", fresh_passages), ("packing", packed)]

# Training a field and rules and linking fingerprints have no SQL form; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each stored before the next one."""
    docs, stored = table(spark, sf_dir, "documents"), None
    for name, work in STAGES[:-1]:
        with settled_in(spark, name) as folder:
            docs = settle(work(spark, docs, sf_dir), name)
        if stored:
            remove(spark, stored)
        stored = folder
    return STAGES[-1][1](spark, docs, sf_dir)
