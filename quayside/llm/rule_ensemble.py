"""Quality by a sparse ensemble of rules: tree paths, lasso weights, column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import WORD

#: A condition: number of the statistic, whether it is at most the threshold, threshold.
Condition = tuple[int, bool, float]


@dataclass(frozen=True)
class Ensemble:
    """A fitted score: ``intercept`` plus the weights of the rules that hold, through a sigmoid."""

    intercept: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]


@dataclass(frozen=True)
class RuleParameters:
    """``most_rows`` bounds the labelled rows that the rules are fitted on; all rows are scored."""

    most_rows: int = 20_000
    trees: int = 24
    depth: int = 3
    penalty: float = 0.0005
    iterations: int = 60
    seed: int = 7


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text that is not NULL."""
    words = F.regexp_count(text, F.lit(WORD)).cast("double")
    each = F.greatest(words, F.lit(1.0))

    def rate(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / each

    lines, cells = F.split(text, "\n"), F.split(text, " ")
    return {
        "log_words": F.log1p(words),
        "word_length": F.length(text) / each,
        "capitals": rate("[\\p{Lu}]{2,}"),
        "symbols": rate("[#*$%&|<>~^=_{}\\\\]+"),
        "exclamations": rate("[!]+"),
        "digits": rate("[0-9]+"),
        "stops": rate("[.?]"),
        "commas": rate(","),
        "lines": F.size(lines) / each,
        "repeated_lines": 1 - F.size(F.array_distinct(lines)) / F.size(lines),
        "repeated_words": 1 - F.size(F.array_distinct(cells)) / F.size(cells),
        "variety": F.size(F.array_distinct(cells)) / F.sqrt(each),
    }


NAMES = (
    "log_words", "word_length", "capitals", "symbols", "exclamations", "digits", "stops", "commas", "lines",
    "repeated_lines", "repeated_words", "variety",
)


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of each text; a NULL text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("_text")).select(
        "doc_id", *[c.alias(name) for name, c in statistics(F.col("_text")).items()]
    )


def tree_paths(tree) -> list[tuple[Condition, ...]]:
    """The conjunctions of all nodes below the root of a fitted tree."""
    found: list[tuple[Condition, ...]] = []

    def walk(node, path: tuple[Condition, ...]) -> None:
        if path:
            found.append(path)
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        for child, below in ((node.leftChild(), True), (node.rightChild(), False)):
            walk(child, (*path, (split.featureIndex(), below, split.threshold())))

    walk(tree._call_java("rootNode"), ())
    return found


def simplified(path: tuple[Condition, ...]) -> tuple[Condition, ...]:
    """The tightest threshold of each statistic and side, in order."""
    tight: dict[tuple[int, bool], float] = {}
    for i, below, threshold in path:
        have = tight.get((i, below))
        better = threshold if have is None else (min if below else max)(have, threshold)
        tight[i, below] = better
    return tuple((i, below, t) for (i, below), t in sorted(tight.items()))


def rule_column(rule: tuple[Condition, ...], columns: list[Column]) -> Column:
    out = None
    for i, below, threshold in rule:
        one = columns[i] <= threshold if below else columns[i] > threshold
        out = one if out is None else out & one
    return out


def fit(rows: DataFrame, p: RuleParameters = RuleParameters()) -> Ensemble:
    """Rules and weights from ``rows``: the statistics and ``label`` 0 or 1.

    ``rows`` has at most about ``most_rows`` rows and is brought in one order in one
    partition, so that the fit does not depend on how it was partitioned; what made them is
    not in that task. Without rows, or
    with one label only, there are no rules and the score is the smoothed share of label 1.
    """
    rows = rows.select("label", *NAMES).repartition(1).sortWithinPartitions("label", *NAMES).cache()
    try:
        ones, n = rows.agg(F.sum("label"), F.count("*")).first()
        ones = ones or 0
        if ones == 0 or ones == n:
            share = (ones + 1) / (n + 2)
            return Ensemble(math.log(share / (1 - share)), ())
        vectors = VectorAssembler(inputCols=list(NAMES), outputCol="features").transform(rows)
        forest = RandomForestClassifier(
            labelCol="label", numTrees=p.trees, maxDepth=p.depth, maxBins=64, seed=p.seed, featureSubsetStrategy="onethird"
        ).fit(vectors)
        paths = {simplified(path): None for tree in forest.trees for path in tree_paths(tree)}
        rules = sorted(paths)
        columns = [F.col(c) for c in NAMES]
        holds = F.array(*[rule_column(r, columns).cast("double") for r in rules])
        lasso = LogisticRegression(
            labelCol="label", elasticNetParam=1.0, regParam=p.penalty, maxIter=p.iterations
        ).fit(rows.select("label", array_to_vector(holds).alias("features")))
        weights = lasso.coefficients.toArray().tolist()
        kept = tuple((r, w) for r, w in zip(rules, weights, strict=True) if w != 0)
        return Ensemble(float(lasso.intercept), kept)
    finally:
        rows.unpersist()


def score_column(ensemble: Ensemble) -> Column:
    """The score as an expression of the columns of statistics."""
    columns = [F.col(c) for c in NAMES]
    total = F.lit(ensemble.intercept)
    for rule, weight in ensemble.rules:
        total = total + F.when(rule_column(rule, columns), F.lit(weight)).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def labelled(scored: DataFrame, labels: DataFrame, learn: Column, p: RuleParameters) -> DataFrame:
    """Rows of the statistics to learn from, with ``label``; about ``most_rows`` by a hash of the id.

    Labels that are NULL, or of a NULL id, are left out; several labels of a document count as
    the larger half of them, ties as 1. Where rows repeat labelled ids so that there are more
    than ``most_rows``, equal rows count once and the others are taken by a hash of the row.
    """
    own = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    own = own.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        (F.avg("quality") >= 0.5).cast("double").alias("label")
    )
    own = own.where(learn)
    n = own.count()
    if n > p.most_rows:
        share = int(p.most_rows / n * 1_000_000)
        own = own.where(F.pmod(F.xxhash64(F.lit(p.seed), "doc_id"), F.lit(1_000_000)) < share)
    rows = scored.join(own, "doc_id")
    if rows.count() > p.most_rows:
        row = ["doc_id", *NAMES]
        rows = rows.dropDuplicates(row)
        n = rows.count()
        if n > p.most_rows:
            share = int(p.most_rows / n * 1_000_000)
            rows = rows.where(F.pmod(F.xxhash64(F.lit(p.seed + 1), *row), F.lit(1_000_000)) < share)
    return rows
