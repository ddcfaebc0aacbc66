"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard and components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.buffers import Words, array_column, document_runs, mixed, text_buffer
from quayside.llm.common import ID, NO_ID, TEXT_HASH, keyed, whole_rows
from quayside.llm.components import connected
from quayside.scratch import Workspace

U = np.uint64

#: Members of a bucket that are compared with all others in the first of the later rounds.
TURNS = 1024


@dataclass(frozen=True)
class NearDup:
    """Parameters: shingles of ``words`` words; links at ``percent`` % Jaccard similarity or more.

    A signature has ``bands * rows`` coordinates. With 32 bands of 4, two documents of
    similarity 0.75 share no band with probability 5e-6, of 0.8 with 5e-8. That is all that
    is lost: later rounds rule pairs out by bounds that hold for every pair.
    """

    words: int = 5
    percent: int = 75
    bands: int = 32
    rows: int = 4


#: Places of an outline, and numbers of 64 bits that hold them.
PLACES = 2048
OUTLINE = PLACES // 64


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, document by document, and the number of each document's.

    A document of fewer words than ``size``, but not none, has one: all of its words.
    """
    counts = np.diff(words.begins)
    per_doc = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.repeat(words.begins[:-1], per_doc)
    start = np.arange(per_doc.sum()) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc) + first
    length = np.repeat(np.minimum(counts, size), per_doc)
    out = length.astype(np.uint64)
    padded = np.concatenate([words.values, np.zeros(size, dtype=np.uint64)])
    for j in range(size):
        out = mixed(out * U(0x9E3779B97F4A7C15) + np.where(j < length, padded[start + j], U(0)))
    return out, per_doc


def circulant_minima(hashes: np.ndarray, begins: np.ndarray, coordinates: int) -> np.ndarray:
    """MinHash signatures, ``[coordinate, document]``, from two permutations of 32-bit numbers.

    The first permutation places the elements; coordinate k is the smallest value of the
    second one, shifted circularly by k places. ``begins`` are the first elements of the
    documents, none of which is empty.
    """
    placed = (hashes >> U(32)).astype(np.uint32)
    placed = _permuted(placed, np.uint32(0x7FEB352D), np.uint32(0x846CA68B))
    out = np.empty((coordinates, len(begins)), dtype=np.uint32)
    x, y = np.empty_like(placed), np.empty_like(placed)
    for k in range(coordinates):
        np.subtract(placed, np.uint32(k), out=x)
        for shift, factor in ((16, 0x21F0AAAD), (15, 0xD35A2D97)):
            np.right_shift(x, np.uint32(shift), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, np.uint32(factor), out=x)
        np.right_shift(x, np.uint32(15), out=y)
        np.bitwise_xor(x, y, out=x)
        out[k] = np.minimum.reduceat(x, begins)
    return out


def outlines(sets: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each set's outline ``[document, number]``: a bit for every place that elements fall on by their hash;
    and how many of its elements fall on a place that another one has taken."""
    out = np.zeros((len(sizes), OUTLINE), dtype=np.uint64)
    place = mixed(sets ^ U(0x2545F4914F6CDD1D)) & U(PLACES - 1)
    document = np.repeat(np.arange(len(sizes)), sizes)
    np.bitwise_or.at(out, (document, (place >> U(6)).astype(np.int64)), U(1) << (place & U(63)))
    return out, sizes - np.bitwise_count(out).sum(axis=1, dtype=np.int64)


def most_in_common(a: Column, b: Column, spare_a: Column, spare_b: Column) -> Column:
    """A bound on the elements that two sets have in common, from their outlines.

    Elements in common that took their place in both sets share it; of the others each set has
    so many to spare. A loop over the numbers, as one expression of all of them makes a method
    that the JVM does not compile.
    """
    both = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(y)))
    return F.aggregate(both, F.least(spare_a, spare_b), lambda total, n: total + n)


def _permuted(x: np.ndarray, a: np.uint32, b: np.uint32) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * a
    x = (x ^ (x >> np.uint32(15))) * b
    return x ^ (x >> np.uint32(16))


def _sorted_sets(hashes: np.ndarray, per_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each document, sorted, and their number."""
    parts, sizes, at = [], np.zeros(len(per_doc), dtype=np.int64), 0
    for d, n in enumerate(per_doc.tolist()):
        own = np.sort(hashes[at : at + n])
        if n > 1:
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        parts.append(own)
        sizes[d] = len(own)
        at += n
    return (np.concatenate(parts) if parts else hashes[:0]), sizes


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _signatures(p: NearDup):
    """Arrow batches of keyed documents to set sizes, fingerprints of the sets and band hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            for first, last in document_runs(offsets, 1 << 18):
                words = Words(data, offsets, first, last, lower=True)
                hashes, per_doc = shingles(words, p.words)
                sets, sizes = _sorted_sets(hashes, per_doc)
                full = sizes > 0
                begins = (np.cumsum(sizes) - sizes)[full]
                bands = np.empty((0, p.bands), dtype=np.uint64)
                a = b = np.zeros(len(sizes), dtype=np.uint64)
                if full.any():
                    low = circulant_minima(sets, begins, p.bands * p.rows).astype(np.uint64)
                    low = low.reshape(p.bands, p.rows, -1)
                    key = np.broadcast_to(np.arange(1, p.bands + 1, dtype=np.uint64)[:, None], low[:, 0].shape)
                    for j in range(p.rows):
                        key = mixed(key * U(0x9E3779B97F4A7C15) + low[:, j])
                    bands = np.ascontiguousarray(key.T)
                    a, b = a.copy(), b.copy()
                    a[full] = np.add.reduceat(mixed(sets), begins)
                    b[full] = np.add.reduceat(mixed(sets ^ U(0x5851F42D4C957F2D)), begins)
                outline, spare = outlines(sets, sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(1).slice(first, last - first),
                        pa.array(sizes),
                        _signed(a),
                        _signed(b),
                        array_column(bands.ravel().view(np.int64), full * p.bands, pa.int64()),
                        array_column(outline[full].ravel().view(np.int64), full * OUTLINE, pa.int64()),
                        pa.array(spare.astype(np.int64)),
                    ],
                    [ID, TEXT_HASH, "n_shingles", "set_a", "set_b", "bands", "outline", "spare"],
                )

    return run


def _shingle_sets(p: NearDup):
    """Arrow batches of ``(id, text hash, text)`` to the sorted sets of shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            for first, last in document_runs(offsets):
                hashes, per_doc = shingles(Words(data, offsets, first, last, lower=True), p.words)
                sets, sizes = _sorted_sets(hashes, per_doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(1).slice(first, last - first),
                        array_column(sets.view(np.int64), sizes, pa.int64()),
                    ],
                    ["node", TEXT_HASH, "shingles"],
                )

    return run


def near_duplicates(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept`` and ``_text_hash``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a document's set has its distinct
    shingles. Documents whose sets have a Jaccard similarity of ``percent`` % or more are
    linked; ``component_id`` is the smallest ``doc_id`` reachable over links.

    NULL texts and texts without words have an empty set, linked with nothing. Rows that share
    a ``doc_id`` are one node with the links of all of them. Rows without a ``doc_id`` are
    neither compared nor linked: they have no component and are kept. An empty table gives no
    rows; other columns are ignored.

    Documents with equal sets become one representative first, so copies are never paired.
    Representatives that share a band meet in its bucket. A bucket is worked on in rounds, see
    ``_links``: all members with one leader, then members outside the largest component with
    those of other components that bounds on sizes and common elements do not rule out, until no two such members are left
    that are in different components. So a large group of near copies costs a few comparisons a member, and a bucket
    of documents that are not alike is still looked at in full. Links are confirmed on the
    full sets.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "near-duplicates")
    base = keyed(docs)
    signed = base.select(ID, TEXT_HASH, "text").mapInArrow(
        _signatures(p),
        f"{ID} long, {TEXT_HASH} long, n_shingles long, set_a long, set_b long, bands array<long>,"
        " outline array<long>, spare long",
    )
    signed = work.table(signed, "signatures")
    alike = signed.where((F.col("n_shingles") > 0) & (F.col(ID) != NO_ID))
    # Tables of their own, so that Spark shuffles both sides of a join and splits hot keys.
    classes = alike.groupBy("set_a", "set_b").agg(F.min(ID).alias("node"))
    classes = work.table(classes, "classes")
    firsts = classes.withColumnRenamed("node", ID)
    buckets = (
        alike.join(firsts, [ID, "set_a", "set_b"])
        .select(F.col(ID).alias("node"), F.explode("bands").alias("bucket"))
        .distinct()
    )
    buckets = work.table(buckets, "buckets")
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    shared = work.table(shared, "full")
    buckets = work.table(buckets.join(shared, "bucket"), "shared")
    work.drop("buckets", "full")

    nodes = buckets.select("node").distinct()
    texts = base.select(F.col(ID).alias("node"), TEXT_HASH, "text").join(nodes, "node")
    sets = (
        texts.mapInArrow(_shingle_sets(p), f"node long, {TEXT_HASH} long, shingles array<long>")
        .withColumn("n", F.size("shingles"))
        .where("n > 0")
        .dropDuplicates(["node", TEXT_HASH])
    )
    sets = work.table(sets, "sets")

    drawn = alike.join(firsts, [ID, "set_a", "set_b"]).select(
        F.col(ID).alias("node"), "n_shingles", "outline", "spare"
    )
    drawn = work.table(drawn.join(nodes, "node", "left_semi").distinct(), "outlines")
    links = _links(work, buckets, sets, drawn, p)
    members = alike.select(ID, "set_a", "set_b").join(classes, ["set_a", "set_b"])
    same = members.where(F.col(ID) != F.col("node")).select(F.col(ID).alias("a"), F.col("node").alias("b"))
    found = connected(links.unionByName(same), work, "documents")
    component = F.when(F.col(ID) != NO_ID, F.coalesce("component", F.col(ID)))
    return (
        signed.join(found, signed[ID] == found["node"], "left")
        .select(F.when(F.col(ID) != NO_ID, F.col(ID)).alias("doc_id"), "n_shingles", component.alias("component_id"), TEXT_HASH)
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def distinct_documents(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near copies, the row with the smallest ``doc_id``.

    Rows are compared by their texts whatever their ids: rows that share an id and are not alike
    all stay, rows without an id are compared like others and come after all ids. Of rows that
    repeat an id and a text one stays. Texts without words, and NULL, are like no other.
    """
    work = Workspace(docs.sparkSession, "distinct")
    own = whole_rows(docs)
    node = F.xxhash64(ID, TEXT_HASH)
    rows = work.table(own.groupBy(ID, TEXT_HASH).agg(F.count("*").alias("n")).withColumn("node", node), "rows")
    texts = docs.select(
        F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.xxhash64(F.coalesce("text", F.lit("")))).alias("doc_id"),
        "text",
    )
    found = near_duplicates(texts, p).select(F.col("doc_id").alias("node"), F.col("component_id").alias("component"))
    joined = rows.join(found.distinct(), "node")
    order = F.struct((F.col(ID) == NO_ID).alias("unnamed"), ID, TEXT_HASH, "n")
    first = joined.groupBy("component").agg(F.min(order).alias("first")).select(f"first.{ID}", f"first.{TEXT_HASH}", "first.n")
    first = work.table(first, "first")
    stay = own.join(first, [ID, TEXT_HASH])
    if not first.where("n > 1").isEmpty():
        # only rows that repeat an id and a text are grouped with their texts
        stay = stay.where("n = 1").unionByName(stay.where("n > 1").dropDuplicates([ID, TEXT_HASH]))
    return stay.select("_row.*")


def _links(
    work: Workspace, buckets: DataFrame, sets: DataFrame, drawn: DataFrame, p: NearDup
) -> DataFrame:
    """Links between representatives, enough of them to give all components.

    Round 0 compares each node with the smallest leader of its buckets and labels it with
    that, round 1 each bucket's members with its leader; then labels are components. Later
    rounds look at buckets that still hold several components: each member outside the
    bucket's largest one is compared with the members of the other components, unless their
    sizes or outlines rule a link out. Where these are many they take turns: about ``TURNS``
    of a bucket first, then the square of that, and so on.
    """
    spark = buckets.sparkSession
    links = spark.createDataFrame([], "a long, b long")
    tested = spark.createDataFrame([], "a long, b long")
    turn = F.pmod(F.xxhash64("bucket", "node"), F.lit(1 << 30)) / float(1 << 30)
    rows = buckets.select("bucket", "node", F.col("node").alias("component"))
    round_, most = 0, TURNS
    while True:
        sizes = rows.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.min("node").alias("leader"))
        several = sizes.groupBy("bucket").agg(
            F.max(F.struct("n", "component")).getField("component").alias("main"),
            F.sum("n").alias("n"),
            F.max("n").alias("n_main"),
            F.min("leader").alias("leader"),
            F.count("*").alias("components"),
        )
        several = several.where("components > 1").select(
            "bucket", "main", "leader", (F.col("n") - F.col("n_main")).alias("outside")
        )
        rows = work.table(rows.join(several, "bucket"), f"open-{round_}")
        outside = rows.agg(F.max("outside")).first()[0]
        if outside is None:
            break
        if round_ == 0:
            pairs = rows.where("node <> leader").groupBy(F.col("node").alias("a")).agg(F.min("leader").alias("b"))
        elif round_ == 1:
            pairs = rows.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))
        else:
            lead = rows.where((F.col("component") != F.col("main")) & (turn * F.col("outside") < most))
            lead = lead.select("bucket", "node", "component").join(drawn, "node")
            lead = lead.select("bucket", *[F.col(c).alias(f"{c}_b") for c in ("component", *drawn.columns)])
            pairs = rows.select("bucket", "node", "component").join(drawn, "node").join(lead, "bucket")
            pairs = pairs.where(_promising(p)).select(F.col("node").alias("a"), F.col("node_b").alias("b"))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if round_:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        judged = work.table(_judged(pairs, sets, p), f"judged-{round_}")
        tested = tested.unionByName(judged.select("a", "b"))
        links = links.unionByName(judged.where("linked").select("a", "b"))
        if round_ > 1 and most >= outside:
            break
        if round_:
            found = connected(links, work, f"round-{round_}")
        else:
            # labels need not be whole components yet: nodes of one label have to be connected
            found = judged.where("linked").select(F.col("b").alias("node"), F.col("a").alias("component"))
            found = found.groupBy("node").agg(F.min("component").alias("component"))
        rows = (
            rows.select("bucket", "node")
            .join(found, "node", "left")
            .select("bucket", "node", F.coalesce("component", F.col("node")).alias("component"))
        )
        most = most if round_ < 2 else most * most
        round_ += 1
    return links


def _promising(p: NearDup) -> Column:
    """Whether two members of a bucket are to be compared: if they are in different components
    and neither their sizes nor their outlines rule it out."""
    smaller, larger = F.least("n_shingles", "n_shingles_b"), F.greatest("n_shingles", "n_shingles_b")
    common = most_in_common(F.col("outline"), F.col("outline_b"), F.col("spare"), F.col("spare_b"))
    return (
        (F.col("component") != F.col("component_b"))
        & (100 * smaller >= p.percent * larger)
        & ((100 + p.percent) * common >= p.percent * (smaller + larger))
    )


def _judged(pairs: DataFrame, sets: DataFrame, p: NearDup) -> DataFrame:
    """``a, b, linked`` by the Jaccard similarity of the full sets."""

    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("shingles").alias(f"set_{name}"), F.col("n").alias(f"n_{name}"))

    common: Column = F.size(F.array_intersect("set_a", "set_b"))
    smaller, larger = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    possible = 100 * smaller >= p.percent * larger
    linked = F.when(possible, 100 * common >= p.percent * (F.col("n_a") + F.col("n_b") - common)).otherwise(False)
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", linked.alias("linked"))
