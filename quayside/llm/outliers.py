"""Robust multivariate outliers: minimum covariance determinant per language and source."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.buffers import Words, document_runs, mixed, text_buffer
from quayside.llm.common import SPACES
from quayside.scratch import Workspace

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
GROUP = ["_lang", "_source"]

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80


@dataclass(frozen=True)
class Outliers:
    """Parameters.

    ``half`` is the share of a group's rows that the estimate fits (the h of the method);
    sources of fewer than ``least`` rows are one group by language, and where that is smaller
    it has no estimate and rejects nothing. ``floors`` are
    the smallest standard deviations of the transformed statistics, and widen no larger one:
    most documents have no symbols or repeats at all, whose variance would be 0, and one symbol
    or line in a document of 350 words, a middling length, is 0.25. ``least_variance`` is
    added to all variances, so that a covariance of statistics that go together can be
    inverted. ``weight_cut`` and ``cut`` are squared distances: the 0.975 and 0.999 quantiles of
    chi-square with 5 degrees of freedom, for the reweighting step and for the verdict.
    ``nearest`` and ``reweighted`` are how much the covariance of a normal sample exceeds that
    of its nearest ``half``, and of its part within ``weight_cut``: 0.75 and 0.975 over the
    shares of chi-square with 7 degrees of freedom below the 0.75 and 0.975 quantiles of that
    with 5.
    """

    half: float = 0.75
    least: int = 50
    steps: int = 10
    floors: tuple[float, ...] = (0.01, 0.01, 0.25, 0.25, 0.25)
    least_variance: float = 1e-4
    nearest: float = 1.412
    weight_cut: float = 12.833
    reweighted: float = 1.056
    cut: float = 20.515
    min_words: int = 50
    max_repeat_percent: int = 50


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and the five statistics of each whole text.

    Words are ``[^\\x20\\x09-\\x0D]+``. A NULL text counts as empty. Other columns are dropped.
    """
    fields = "".join(f", {name} long" for name in STATISTICS)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang"), F.col("source"), F.col("text"))
    return rows.mapInArrow(_statistics, f"doc_id long, lang string, source string{fields}")


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffer(batch.column(3))
        found = [
            _of_run(data, offsets, first, last, batch.column(3)) for first, last in document_runs(offsets)
        ]
        if found:
            columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *columns], ["doc_id", "lang", "source", *STATISTICS]
            )


def _of_run(data: np.ndarray, offsets: np.ndarray, first: int, last: int, texts: pa.Array) -> list[np.ndarray]:
    words = Words(data, offsets, first, last)
    counts = np.diff(words.begins)
    lo, own = int(offsets[first]), offsets[first : last + 1] - int(offsets[first])
    part = data[lo : int(offsets[last])]

    def per_document(mask: np.ndarray, borders: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))[borders])

    points = np.concatenate(([0], np.cumsum(_FIRST_BYTE[part], dtype=np.int64)))
    lengths = points[words.ends - lo] - points[words.starts - lo]
    chars = np.diff(np.concatenate(([0], np.cumsum(lengths)))[words.begins])
    return [
        counts,
        chars,
        per_document(_SYMBOLS[part], own),
        np.array([_repeated_lines(texts[i].as_py()) for i in range(first, last)], dtype=np.int64),
        per_document(_in_repeated_triples(words.values, counts), words.begins),
    ]


def _repeated_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def _in_repeated_triples(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which words are in a window of three that their document has twice or more."""
    out = np.zeros(len(values), dtype=bool)
    if len(values) < 3:
        return out
    doc = np.repeat(np.arange(len(counts)), counts)
    key = mixed(values[:-2] + doc[:-2].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    key = mixed(key + values[1:-1])
    key = mixed(key + values[2:])
    at = np.flatnonzero(doc[:-2] == doc[2:])
    order = np.argsort(key[at], kind="stable")
    ordered = key[at][order]
    same = ordered[1:] == ordered[:-1]
    twice = at[order[np.concatenate((same, [False])) | np.concatenate(([False], same))]]
    for shift in range(3):
        out[twice + shift] = True
    return out


def transformed() -> list[Column]:
    """The vector of a document with words: logarithms of its length and of rates."""
    n = F.col("n_words").cast("double")
    return [
        F.log(n),
        F.col("word_chars") / n,
        *[F.log1p(100 * F.col(c) / n) for c in ("n_symbols", "n_dup_lines", "n_repeat_words")],
    ]


X = [f"x{i}" for i in range(5)]
MEAN = [f"mean{i}" for i in range(5)]
PAIRS = [(i, j) for i in range(5) for j in range(i, 5)]
INVERSE = [f"inverse{i}{j}" for i, j in PAIRS]


def _distance() -> Column:
    """Squared Mahalanobis distance to the estimate that was joined."""
    away = [F.col(x) - F.col(m) for x, m in zip(X, MEAN, strict=True)]
    out = F.lit(0.0)
    for (i, j), name in zip(PAIRS, INVERSE, strict=True):
        out = out + (1.0 if i == j else 2.0) * away[i] * away[j] * F.col(name)
    return F.greatest(out, F.lit(0.0))


def _quantile(rows: DataFrame, by: list[str], value: Column, q: float) -> DataFrame:
    """``by, bin``: the bin of ``value`` up to which a share ``q`` of each group's rows are.

    All rows are counted, by bin and before the shuffle, so a group of any size is a few
    thousand rows, and the answer does not depend on the partitioning.
    """
    counts = rows.groupBy(*by, value.cast("long").alias("bin")).agg(F.count("*").alias("n"))
    up_to = Window.partitionBy(*by).orderBy("bin")
    counts = counts.withColumn("up_to", F.sum("n").over(up_to)).withColumn(
        "all", F.sum("n").over(Window.partitionBy(*by))
    )
    return counts.where(F.col("up_to") >= q * F.col("all")).groupBy(*by).agg(F.min("bin").alias("bin"))


def _log_bin(value: Column) -> Column:
    """Bins that are 1 % wide."""
    return F.floor(F.log(value + 1e-6) * 100)


def _start(rows: DataFrame, p: Outliers) -> DataFrame:
    """First estimates: medians and quartile ranges, to 1/200."""
    long = rows.select(
        *GROUP, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(x).alias("x")) for i, x in enumerate(X)])).alias("c")
    ).select(*GROUP, "c.*")
    by = [*GROUP, "i"]
    bins = {
        name: _quantile(long, by, F.floor(F.col("x") * 200), q).withColumnRenamed("bin", name)
        for name, q in (("low", 0.25), ("middle", 0.5), ("high", 0.75))
    }
    each = bins["low"].join(bins["middle"], by).join(bins["high"], by)
    spread = (F.col("high") - F.col("low")) / 200 / 1.349
    floor = F.element_at(F.array(*[F.lit(f) for f in p.floors]), F.col("i") + 1)
    each = each.select(*by, ((F.col("middle") + 0.5) / 200).alias("m"), F.greatest(spread, floor).alias("s"))
    pick = lambda i, c: F.max(F.when(F.col("i") == i, c))
    means = [pick(i, F.col("m")).alias(MEAN[i]) for i in range(5)]
    inverse = [
        (pick(i, 1 / (F.col("s") * F.col("s"))) if i == j else F.lit(0.0)).alias(name)
        for (i, j), name in zip(PAIRS, INVERSE, strict=True)
    ]
    return each.groupBy(*GROUP).agg(*means, *inverse, F.lit(0.0).alias("log_det"))


def _fit(rows: DataFrame, p: Outliers, factor: float = 1.0) -> DataFrame:
    """Mean and inverse covariance, ``factor`` times that of the rows, of each group."""
    sums = [F.sum(x).alias(f"s_{x}") for x in X]
    squares = [F.sum(F.col(X[i]) * F.col(X[j])).alias(f"s{i}{j}") for i, j in PAIRS]
    moments = rows.groupBy(*GROUP).agg(F.count("*").alias("n"), *sums, *squares)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy().astype(float)
            mean = np.stack([batch.column(3 + i).to_numpy() for i in range(5)], axis=1) / n[:, None]
            cov = np.zeros((len(n), 5, 5))
            for k, (i, j) in enumerate(PAIRS):
                value = batch.column(8 + k).to_numpy() / n - mean[:, i] * mean[:, j]
                cov[:, i, j] = cov[:, j, i] = value
            cov *= factor
            i = np.arange(5)
            cov[:, i, i] += np.maximum(np.square(p.floors) - cov[:, i, i], p.least_variance)
            inverse = np.linalg.inv(cov) if len(n) else cov
            log_det = np.linalg.slogdet(cov)[1] if len(n) else n
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    *[pa.array(mean[:, i]) for i in range(5)],
                    *[pa.array(inverse[:, i, j]) for i, j in PAIRS],
                    pa.array(log_det),
                ],
                [*GROUP, *MEAN, *INVERSE, "log_det"],
            )

    doubles = ", ".join(f"{c} double" for c in [*MEAN, *INVERSE, "log_det"])
    return moments.mapInArrow(solve, f"_lang string, _source string, {doubles}")


def estimates(rows: DataFrame, work: Workspace, p: Outliers) -> DataFrame:
    """The estimate of each group that is large enough: all of its rows take part.

    Concentration steps: fit the share ``half`` of the rows that are nearest to the estimate
    so far, until no determinant changes. Then the covariance is scaled by
    ``nearest``, and rows within ``weight_cut`` are fitted once more, scaled by ``reweighted``.
    The factors are those of a normal sample: a median distance would be too small where most
    rows have the same zeros.
    A step is two passes over the numbers, with sums by group combined before the shuffle.
    """
    large = rows.groupBy(*GROUP).agg(F.count("*").alias("n")).where(F.col("n") >= p.least).drop("n")
    rows = rows.join(work.table(large, "groups"), GROUP)
    now = work.table(_start(rows, p), "estimate0")
    for step in range(1, p.steps + 1):
        near = _nearest(rows, now, p.half)
        new = work.table(_fit(near, p), f"estimate{step}")
        change = new.join(now.select(*GROUP, F.col("log_det").alias("before")), GROUP)
        moved = change.agg(F.max(F.abs(F.col("log_det") - F.col("before")))).first()[0]
        now = new
        if moved is None or (step > 1 and moved < 1e-6):
            break
    near = rows.join(now, GROUP).where(_distance() / p.nearest <= p.weight_cut).select(*GROUP, *X)
    return work.table(_fit(near, p, p.reweighted), "final")


def _nearest(rows: DataFrame, estimate: DataFrame, share: float) -> DataFrame:
    far = rows.join(estimate, GROUP).withColumn("own", _log_bin(_distance()))
    cuts = _quantile(far, GROUP, F.col("own"), share)
    return far.join(cuts, GROUP).where("own <= bin").select(*GROUP, *X)


def _pooled(rows: DataFrame, work: Workspace, p: Outliers) -> DataFrame:
    """The rows with the sources of a language that are too small for an estimate as one group."""
    sizes = rows.where("not base_failed").groupBy(*GROUP).agg(F.count("*").alias("n"))
    large = work.table(sizes.where(F.col("n") >= p.least).select(*GROUP, F.lit(True).alias("large")), "large")
    return rows.join(large, GROUP, "left").withColumn(
        "_source", F.when(F.col("large"), F.col("_source")).otherwise(F.lit("small"))
    )


def judge_documents(docs: DataFrame, p: Outliers = Outliers()) -> DataFrame:
    """One row per document: ``doc_id``, the five statistics, ``base_failed``, ``distance``, ``kept``.

    A document fails the base rules with fewer than ``min_words`` words, or if more than
    ``max_repeat_percent`` % of its words are in repeated windows of three. The others are
    vectors; each language and source, NULL among them, has a robust estimate of where its
    vectors lie (small sources of a language have one together), and a document farther from it than ``cut`` is rejected. ``distance`` is the
    squared Mahalanobis distance, NULL for failed documents and in groups that are too small,
    whose documents are kept.

    NULL texts and empty texts have no words and fail. Rows that repeat are judged alike. An
    empty table gives no rows; columns besides ``doc_id, text, lang, source`` are ignored.
    """
    work = Workspace(docs.sparkSession, "outliers")
    failed = (F.col("n_words") < p.min_words) | (
        100 * F.col("n_repeat_words") > p.max_repeat_percent * F.col("n_words")
    )
    named = [
        F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")).alias(k)
        for c, k in zip(("lang", "source"), GROUP, strict=True)
    ]
    judged = work.table(statistics(docs).select("doc_id", *named, *STATISTICS, failed.alias("base_failed")), "statistics")
    vectors = [F.when(~F.col("base_failed"), x).alias(name) for x, name in zip(transformed(), X, strict=True)]
    judged = _pooled(judged, work, p).select("*", *vectors)
    final = estimates(judged.where("not base_failed").select(*GROUP, *X), work, p)
    out = judged.join(final, GROUP, "left").withColumn("distance", F.when(~F.col("base_failed") & F.col("mean0").isNotNull(), _distance()))
    return out.select(
        "doc_id",
        *STATISTICS,
        "base_failed",
        "distance",
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= p.cut, F.lit(True))).alias("kept"),
    )
