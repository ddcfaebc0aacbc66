"""Language of a text by rank-order profiles of letter n-grams."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The prediction for texts without letters.
UNDETERMINED = "und"

#: Characters that are worked on at once.
PART = 1 << 19

#: Bits of a code point in a packed n-gram; n-grams have up to three symbols.
BITS = 21


@dataclass(frozen=True)
class Profiles:
    """The most frequent n-grams of each language, in order; ``grams[i]`` belongs to ``languages[i]``."""

    languages: tuple[str, ...]
    grams: tuple[tuple[int, ...], ...]
    size: int


@cache
def _letters() -> np.ndarray:
    out = np.zeros(sys.maxunicode + 1, dtype=bool)
    for start in range(0, sys.maxunicode + 1, 0x10000):
        out[start : start + 0x10000] = [chr(c).isalpha() for c in range(start, min(start + 0x10000, len(out)))]
    return out


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of lower-cased letters with 0 between words and at the ends, and whose they are."""
    codes = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    lengths = np.array([len(c) + 1 for c in codes])
    flat = np.zeros(lengths.sum() + 1, dtype=np.uint32)
    doc = np.repeat(np.arange(len(texts)), lengths)
    doc = np.concatenate((doc, doc[-1:]))
    begins = np.cumsum(lengths) - lengths
    for b, c in zip(begins.tolist(), codes, strict=True):
        flat[b + 1 : b + 1 + len(c)] = c
    flat[~_letters()[flat]] = 0
    keep = np.concatenate(([True], (flat[1:] != 0) | (flat[:-1] != 0)))
    return flat[keep].astype(np.int64), doc[keep]


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, packed n-gram and count of the distinct n-grams of 1 to 3 symbols, in that order.

    Words are runs of letters. N-grams of 2 and 3 take in one border of a word, or both.
    """
    flat, doc = symbols(texts)
    known, dense = np.unique(flat, return_inverse=True)
    base = max(len(known), 2)  # the border is 0 in both numberings
    total = base + base**2 + base**3
    last = len(flat) - 1
    one = dense != 0
    parts = [doc[one] * total + dense[one]]
    if last >= 1:
        two = (dense[:-1] != 0) | (dense[1:] != 0)
        whose = np.where(dense[:-1] != 0, doc[:-1], doc[1:])
        pair = dense[:-1] * base + dense[1:]
        parts.append((whose * total + base + pair)[two])
    if last >= 2:
        three = dense[1:-1] != 0
        triple = (dense[:-2] * base + dense[1:-1]) * base + dense[2:]
        parts.append((doc[1:-1] * total + base + base**2 + triple)[three])
    keys = np.sort(np.concatenate(parts))
    new = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), dtype=bool), keys[1:] != keys[:-1])))
    counts = np.diff(np.concatenate((new, [len(keys)])))
    keys = keys[new]
    owner, gram = keys // total, keys % total
    return owner, _packed(gram, known, base), counts


def _packed(gram: np.ndarray, known: np.ndarray, base: int) -> np.ndarray:
    """N-grams in a numbering of their own as numbers that hold their code points.

    The border is held as 1, so that n-grams of different lengths differ.
    """
    points = np.concatenate(([1], known[1:])) if len(known) and known[0] == 0 else np.maximum(known, 1)
    if len(points) < base:
        points = np.concatenate((points, np.ones(base - len(points), dtype=points.dtype)))
    single, double = gram < base, gram < base + base**2
    g = np.where(single, gram, np.where(double, gram - base, gram - base - base**2))
    c = points[g % base]
    b = np.where(single, 0, points[g // base % base])
    a = np.where(double, 0, points[g // base**2 % base])
    return ((a << (2 * BITS)) | (b << BITS) | c).astype(np.int64)


def _parts(texts: list[str]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > PART:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(text, lang)`` to the n-gram counts of each language in a batch."""
    for batch in batches:
        texts = ["" if t is None else t for t in batch.column(0).to_pylist()]
        languages, own = np.unique(np.array(batch.column(1).to_pylist(), dtype=object), return_inverse=True)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for first, last in _parts(texts):
            owner, gram, count = gram_counts(texts[first:last])
            found.append((own[first + owner], gram, count))
        if not found:
            continue
        lang, gram, count = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((gram, lang))
        lang, gram, count = lang[order], gram[order], count[order]
        new = np.flatnonzero(
            np.concatenate((np.ones(min(len(gram), 1), dtype=bool), (gram[1:] != gram[:-1]) | (lang[1:] != lang[:-1])))
        )
        if len(new):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(languages[lang[new]], pa.string()),
                    pa.array(gram[new]),
                    pa.array(np.add.reduceat(count, new).astype(np.int64)),
                ],
                ["lang", "gram", "n"],
            )


def learn_profiles(docs: DataFrame, size: int = 300) -> Profiles:
    """Profiles of the languages of ``docs (text, lang)``: all texts with a language are counted.

    What comes to the driver is ``size`` numbers a language. Equal counts go by the n-gram.
    Languages none of whose texts has a letter are not learned.
    """
    counted = docs.where(F.col("lang").isNotNull()).select("text", "lang").mapInArrow(
        _counted, "lang string, gram long, n long"
    )
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    ranked: dict[str, list[tuple[int, int]]] = {}
    for row in top.select("lang", "rank", "gram").collect():
        ranked.setdefault(row["lang"], []).append((row["rank"], row["gram"]))
    languages = tuple(sorted(ranked))
    return Profiles(languages, tuple(tuple(g for _, g in sorted(ranked[x])) for x in languages), size)


def distances(profiles: Profiles, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Out-of-place distances ``[language, text]`` and the number of n-grams compared.

    A text's most frequent n-grams (as many as a profile has, equal counts by the n-gram) are
    ranked; the distance sums how far each rank is from the rank in the profile, which is
    ``size`` for one that the profile lacks.
    """
    owner, gram, count = gram_counts(texts)
    most = int(count.max()) + 1 if len(count) else 1
    order = np.lexsort((gram, owner * most + (most - 1 - count)))
    owner, gram = owner[order], gram[order]
    starts = np.searchsorted(owner, np.arange(len(texts)))
    rank = np.arange(len(owner)) - starts[owner]
    top = rank < profiles.size
    owner, gram, rank = owner[top], gram[top], rank[top]
    out = np.zeros((len(profiles.languages), len(texts)))
    for i, own in enumerate(profiles.grams):
        table = np.array(own, dtype=np.int64)
        by_gram = np.argsort(table)
        place = np.minimum(np.searchsorted(table[by_gram], gram), len(table) - 1)
        there = table[by_gram][place] == gram
        away = np.where(there, np.minimum(np.abs(by_gram[place] - rank), profiles.size), profiles.size)
        out[i] = np.bincount(owner, weights=away, minlength=len(texts))
    return out, np.bincount(owner, minlength=len(texts))


def predict(docs: DataFrame, profiles: Profiles, name: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``lang_pred`` and ``score`` in place of columns of those names.

    ``lang_pred`` is the language of the nearest profile, the first by code point of equally
    near ones. ``score`` is 1 for ranks exactly as in the profile and 0 where no n-gram is in
    it. A text that is NULL, empty or without letters is ``und`` with score 0, and so is every
    text where no language was learned. An empty table gives no rows.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")
    place = kept.index(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(place).to_pylist()]
            best, score = [], []
            for first, last in _parts(texts):
                away, compared = distances(profiles, texts[first:last])
                for j in range(last - first):
                    if not compared[j] or not profiles.languages:
                        best.append(UNDETERMINED)
                        score.append(0.0)
                        continue
                    nearest = int(np.argmin(away[:, j]))
                    best.append(profiles.languages[nearest])
                    score.append(float(1 - away[nearest, j] / (compared[j] * profiles.size)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best, pa.string()), pa.array(score, pa.float64())],
                [*kept, "lang_pred", "score"],
            )

    return docs.select(*kept).mapInArrow(run, schema)
