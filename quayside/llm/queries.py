"""The corpus queries, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import TEXT_HASH, documents, keyed, remainder
from quayside.llm.decontaminate import contaminated_words
from quayside.llm.language_id import learn_profiles, predict
from quayside.llm.line_dedup import dedup_lines
from quayside.llm.minhash import near_duplicates
from quayside.llm.mixing import mix_sources, taken
from quayside.llm.near_vectors import near_vectors
from quayside.llm.negatives import hard_negatives
from quayside.llm.outliers import judge_documents
from quayside.llm.rule_ensemble import RuleParameters, fit, labelled, score_column, with_statistics
from quayside.llm.sharding import shard_manifest
from quayside.llm.suffix_array import cut_repeated_strings
from quayside.llm.suffix_trees import cut_repeated_sequences, words_digest
from quayside.llm.vectors import embeddings
from quayside.llm.whitening import whiten
from quayside.llm.windows import KEY
from quayside.scratch import Workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_rule_ensemble")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = Workspace(spark, "rules").table(with_statistics(documents(spark, sf_dir)), "statistics")
    held_out = remainder(F.col("doc_id"), 3) == 1
    p = RuleParameters()
    score = score_column(fit(labelled(scored, labels, ~held_out, p), p))
    return scored.select("doc_id", held_out.alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


@query("op2_suffix_array")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    cut = cut_repeated_strings(docs).select(
        *KEY, "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("cut_sha256")
    )
    whole = keyed(docs).select(
        *KEY, "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256")
    )
    return whole.join(cut, KEY, "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("cut_sha256", "sha256").alias("kept_sha256"),
    )


@query("op3_suffix_trees")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    cut = cut_repeated_sequences(docs).select(*KEY, "n_removed", F.sha2("kept_text", 256).alias("cut_sha256"))
    return words_digest(docs).join(cut, KEY, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("cut_sha256", "joined_sha256").alias("kept_sha256"),
    )


@query("op6_minhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).drop(TEXT_HASH)


@query("op4_rendezvous_sharding")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_manifest(documents(spark, sf_dir), [1.0] * 8).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


@query("op5_source_mixing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(mix_sources(documents(spark, sf_dir)))


@query("op7_rank_order_language")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 4) == 2
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", held_out.alias("held_out"))
    profiles = learn_profiles(docs.where(~F.col("held_out")))
    return predict(docs.drop("lang"), profiles).drop("text")


@query(
    "op8_decontamination",
    r"""
    WITH lowered AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents
    ), docs AS (
        SELECT row_number() OVER () AS row_no, doc_id,
               regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered
    ), items AS (
        SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
    ), passages AS (
        SELECT item_id, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i, w
        FROM items WHERE len(w) > 0
    ), item_windows AS (
        SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS passage FROM passages
    ), lengths AS (SELECT DISTINCT n FROM item_windows),
    starts AS (
        SELECT row_no, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n
    ), hits AS (
        SELECT row_no, i, s.n, item_id FROM starts s
        JOIN item_windows p ON p.n = s.n AND p.passage = array_to_string(s.w[s.i:s.i + s.n - 1], ' ')
    ), hit_words AS (
        SELECT row_no, count(DISTINCT k) AS n_hit
        FROM (SELECT row_no, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT row_no, i, n FROM hits))
        GROUP BY row_no
    ), hit_items AS (
        SELECT row_no, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT row_no, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY row_no
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           n_hit IS NOT NULL AS contaminated
    FROM docs LEFT JOIN hit_words USING (row_no) LEFT JOIN hit_items USING (row_no)
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated_words(documents(spark, sf_dir), benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query("op9_covariance_outliers")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(documents(spark, sf_dir)).drop("distance")


@query(
    "op10_line_dedup",
    r"""
    WITH docs AS (
        SELECT row_number() OVER () AS row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts
        FROM documents
    ), lines AS (
        SELECT row_no, doc_id, unnest(range(1, len(parts) + 1)) AS i, unnest(parts) AS line FROM docs
    ), keys AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
    ), shared AS (
        SELECT k, min(coalesce(doc_id, 9223372036854775807)) AS first_id FROM keys WHERE length(k) >= 10
        GROUP BY k HAVING count(DISTINCT coalesce(doc_id, 9223372036854775807)) >= 2
    ), judged AS (
        SELECT keys.*, first_id IS NOT NULL AND first_id <> coalesce(doc_id, 9223372036854775807) AS dropped
        FROM keys LEFT JOIN shared USING (k)
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
    FROM judged GROUP BY row_no, doc_id
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query(
    "op11_hard_negatives",
    r"""
    WITH sound AS (
        SELECT row_number() OVER () AS row_no, vec_id,
               CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [floor(256 * CAST(c AS DOUBLE)) for c in embedding] AS x
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len([c for c in embedding if c IS NOT NULL AND isfinite(c)]) = len(embedding)
    ), scored AS (
        SELECT a.row_no AS anchor, a.vec_id AS anchor_id, b.row_no AS other, b.vec_id AS other_id,
               a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
        FROM sound a JOIN sound b ON a.row_no <> b.row_no WHERE a.vec_id % 50 = 0
    ), positives AS (
        SELECT * FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id NULLS LAST, other) <= 5
    )
    SELECT p.anchor_id, p.other_id AS positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other_id NULLS LAST, n.other)
                AS INTEGER) AS rank,
           n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
     AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
    QUALIFY rank <= 3
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings(spark, sf_dir).select("vec_id", label.alias("label"), "embedding")
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(embeddings(spark, sf_dir))


@query("op13_small_worlds")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(embeddings(spark, sf_dir))
