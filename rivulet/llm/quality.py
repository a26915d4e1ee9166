"""Quality by a sparse ensemble of rules over text statistics.

Shallow trees are grown on the labelled rows; every path from a root to a node is a
rule, a conjunction of comparisons of statistics. A logistic model with an L1 penalty
weighs the rules and drops most. What is left compiles to plain Spark column
expressions over the statistics, so scoring needs no model object.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm.common import byte_views, settle, slices

STATISTICS = ["words", "word_bytes", "upper", "digits", "bangs", "bars", "signs", "stops", "commas",
              "distinct", "doubled", "lines", "distinct_lines", "longest", "not_ascii"]
FIELD = "text_statistics"


def statistics_of(raw: bytes) -> tuple[float, ...]:
    """The statistics of one whole text; all zero for a text without a word."""
    words = raw.split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATISTICS)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    size = sum(map(len, words))
    signs = int(count[[35, 36, 37, 38, 42, 64, 94, 126]].sum())  # # $ % & * @ ^ ~
    return (float(np.log1p(n)), size / n, upper / max(1, upper + lower), int(count[48:58].sum()) / size,
            int(count[33]) / n, int(count[124]) / n, signs / n, int(count[46]) / n, int(count[44]) / n,
            len(set(words)) / n, sum(map(eq, words, words[1:])) / n, n / len(lines),
            len(set(lines)) / len(lines), float(max(map(len, words))), int(count[128:].sum()) / size)


def text_statistics(text_col: str = "text") -> Column:
    """A struct of the statistics of a text column; only the texts go to Python.

    A NULL, empty or blank text has zeros. Long texts are read whole.
    """
    kind = pa.struct([(s, pa.float64()) for s in STATISTICS])

    def run(column: pa.Array) -> pa.Array:
        found = np.array([statistics_of(raw) for part in slices(
            pa.RecordBatch.from_arrays([column], ["text"]), "text") for raw in byte_views(part.column("text"))])
        return pa.StructArray.from_arrays(
            [pa.array(np.ascontiguousarray(c)) for c in found.reshape(-1, len(STATISTICS)).T], fields=list(kind))

    inner = ", ".join(f"{s} double" for s in STATISTICS)
    return F.arrow_udf(run, inner)(F.col(text_col))


def with_statistics(docs: DataFrame, text_col: str = "text", field: str = FIELD) -> DataFrame:
    """The rows with a struct of statistics in the column ``field``.

    A column that has this name is replaced; name another where the rows must keep it. For
    NULL, empty and long texts see ``text_statistics``.
    """
    return docs.withColumn(field, text_statistics(text_col))


@dataclass(frozen=True)
class Rule:
    """All comparisons (statistic, is above, threshold) hold."""

    parts: tuple[tuple[str, bool, float], ...]

    def column(self, field: str = FIELD) -> Column:
        out = F.lit(True)
        for name, above, cut in self.parts:
            value = F.col(f"{field}.{name}")
            out = out & ((value > F.lit(cut)) if above else (value <= F.lit(cut)))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>' if a else '<='} {c:.4g}" for n, a, c in self.parts)


@dataclass(frozen=True)
class Rules:
    """An intercept and weighted rules; ``score`` is their logistic sum as a column."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self, field: str = FIELD) -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in self.weights:
            total = total + F.when(rule.column(field), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _tightened(parts: list[tuple[str, bool, float]]) -> Rule:
    """One comparison per statistic and direction: the tightest."""
    best: dict[tuple[str, bool], float] = {}
    for name, above, cut in parts:
        key = (name, above)
        best[key] = cut if key not in best else (max if above else min)(best[key], cut)
    return Rule(tuple(sorted((n, a, c) for (n, a), c in best.items())))


def tree_rules(forest) -> list[Rule]:
    """The path to each node but the roots, without repeats."""
    rules: dict[Rule, None] = {}
    for tree in forest.trees:
        todo = [(tree._call_java("rootNode"), [])]
        while todo:
            node, parts = todo.pop()
            if parts:
                rules[_tightened(parts)] = None
            if node.subtreeDepth() > 0:
                name, cut = STATISTICS[node.split().featureIndex()], float(node.split().threshold())
                todo.append((node.leftChild(), [*parts, (name, False, cut)]))
                todo.append((node.rightChild(), [*parts, (name, True, cut)]))
    return sorted(rules, key=str)


def fit_rules(rows: DataFrame, trees: int = 12, depth: int = 3, penalty: float = 5e-4, seed: int = 5
              ) -> Rules:
    """Fit on (text_statistics, label) rows; rows without a label are left out.

    Texts without words and very long ones teach by their statistics like any other.
    Without labelled rows every text scores 0.5; with one class only, that class.
    """
    spark = rows.sparkSession
    labelled = rows.where("label IS NOT NULL").select(FIELD, F.col("label").cast("double"))
    seen = labelled.agg(F.count("*").alias("n"), F.avg("label").alias("mean")).first()
    if not seen["n"] or seen["mean"] in (0.0, 1.0):
        mean = seen["mean"] if seen["n"] else 0.5
        return Rules(float(np.log((mean + 1e-3) / (1 - mean + 1e-3))), ())
    spread = settle(labelled.repartition(spark.sparkContext.defaultParallelism), "labelled")
    vector = VectorAssembler(inputCols=STATISTICS, outputCol="features")
    flat = vector.transform(spread.select("label", f"{FIELD}.*")).select("label", "features")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, maxBins=64,
                                    featureSubsetStrategy="onethird").fit(flat)
    rules = tree_rules(forest)
    if not rules:
        return Rules(float(np.log(seen["mean"] / (1 - seen["mean"]))), ())
    names = [f"rule{k}" for k in range(len(rules))]
    marks = spread.select("label", *[r.column().cast("double").alias(n) for n, r in zip(names, rules)])
    table = VectorAssembler(inputCols=names, outputCol="features").transform(marks).select(
        "label", "features")
    model = LogisticRegression(elasticNetParam=1.0, regParam=penalty, standardization=False,
                               maxIter=60).fit(table)
    kept = [(r, w) for r, w in zip(rules, model.coefficients.toArray().tolist()) if abs(w) > 1e-6]
    return Rules(float(model.intercept), tuple(kept))


def labels_by_id(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(doc_id, label): one row per id; several labels of an id go by their majority, ties to 1."""
    return (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
            .groupBy(F.col(id_col).alias("doc_id"))
            .agg((F.avg(label_col) >= 0.5).cast("int").alias("label")))


def fitted_rules(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id",
                 text_col: str = "text") -> tuple[DataFrame, Rules]:
    """(ids with statistics, rules): statistics of all texts, rules from the rows ``learn`` allows.

    Defined cases: a NULL, empty or blank text has statistics of zero and is scored
    like any other. Rows without id teach nothing. Repeated rows each teach.
    """
    stats = settle(with_statistics(docs.select(F.col(id_col).alias("doc_id"),
                                               F.col(text_col).alias("text"))).drop("text"), "statistics")
    known = stats.where(learn).join(labels_by_id(labels), "doc_id")
    return stats, fit_rules(known)
