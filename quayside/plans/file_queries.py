"""Queries that read files: delimited, JSON, XML and archives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.names import Destination, clean_name_column
from quayside.plans.fixtures import archives, csv_line, one_file_per_row, table, text_files
from quayside.plans.registry import query
from quayside.scratch import scratch
from quayside.sinks.commits import Folder
from quayside.sources.delimited import read_delimited
from quayside.sources.dialects import PRESETS, dialect
from quayside.sources.files import file_patterns
from quayside.sources.json_lines import read_documents, read_json_lines
from quayside.sources.tables import read_staged
from quayside.sources.xml_files import read_xml

DAY = "yyyy-MM-dd"


def sides(batch, *good: Column, bad: Column | None = None) -> DataFrame:
    """Good and rejected rows in one frame, told apart by ``side``."""
    kept = batch.good.select(F.lit("good").alias("side"), *good)
    raw = (F.col("rawData") if bad is None else bad).alias(kept.columns[-1])
    names = kept.columns[1:-1]
    lost = batch.bad.select(
        F.lit("bad").alias("side"), *[F.lit(None).cast("string").alias(n) for n in names], raw
    )
    return kept.unionByName(lost)


# --- names ----------------------------------------------------------------------------


@query(
    "t1_names",
    r"""
    SELECT doc_id,
           lower(regexp_replace(regexp_replace(text, '[^A-Za-z0-9]', '_', 'g'),
                                '^_+|_+$', '', 'g')) AS name,
           lower(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')) AS bare_name
    FROM documents
    """,
)
def t1_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        clean_name_column(F.col("text"), "_").alias("name"),
        clean_name_column(F.col("text"), "").alias("bare_name"),
    )


@query(
    "t8_dest",
    r"""
    SELECT page_id,
           lower(regexp_replace(regexp_replace(regexp_replace(
               'web_' || CASE WHEN regexp_matches(url, '://([^/]+)/(\w+)')
                              THEN lower(regexp_extract(url, '://([^/]+)/(\w+)', 1))
                              ELSE lower(url) END || '_land',
               '\W', '_', 'g'), '^_+|_+$', '', 'g'), '_{2,}', '_', 'g')) AS table_name,
           lower(regexp_replace(regexp_replace(regexp_replace(
               lower(url), '\W', '_', 'g'), '^_+|_+$', '', 'g'), '_{2,}', '_', 'g')) AS whole_name
    FROM pages
    """,
)
def t8_dest(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = Destination(pattern=r"://([^/]+)/(\w+)", group=1, prefix="web_", suffix="_land")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        host.column(F.col("url")).alias("table_name"),
        Destination().column(F.col("url")).alias("whole_name"),
    )


# --- delimited ------------------------------------------------------------------------


@query(
    "s1_csv_header",
    """
    SELECT l_orderkey::VARCHAR AS l_orderkey, l_partkey::VARCHAR AS l_partkey,
           l_linenumber::VARCHAR AS l_linenumber, l_quantity::VARCHAR AS l_quantity,
           l_extendedprice::VARCHAR AS l_extendedprice, l_returnflag,
           strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
    FROM lineitem
    """,
)
def s1_csv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "s1")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_returnflag",
        F.date_format("l_shipdate", DAY).alias("L SHIPDATE"),
    )
    rows.write.csv(folder, header=True)
    batch = read_delimited(spark, [f"{folder}/*.csv"], has_header=True, replacement="_")
    return batch.rows()


PRESET_VALUES = ", ".join(f"('{p}')" for p in PRESETS)


@query(
    "s2_presets",
    f"""
    SELECT preset, c_custkey::VARCHAR AS column_1,
           'say "' || c_mktsegment || '",' || chr(9) || 'then' || chr(10) || c_name AS column_2,
           CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal::VARCHAR END AS column_3
    FROM customer, (VALUES {PRESET_VALUES}) AS v(preset)
    """,
)
def s2_presets(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("a"),
        F.concat(
            F.lit('say "'), "c_mktsegment", F.lit('",\tthen\n'), "c_name"
        ).alias("b"),
        F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.col("c_acctbal").cast("string")).alias("c"),
    )
    doubled = F.concat(F.lit('"'), F.replace("b", F.lit('"'), F.lit('""')), F.lit('"'))
    escaped = F.replace(F.replace("b", F.lit("\t"), F.lit("\\t")), F.lit("\n"), F.lit("\\n"))
    read = None
    for preset, settings in PRESETS.items():
        value = doubled
        if settings.get("escape"):
            value = escaped
            if settings["quote"]:
                value = F.replace(escaped, F.lit('"'), F.lit('\\"'))
        lines = customers.select(F.concat_ws(settings["sep"], "a", value, "c").alias("line"))
        folder = text_files(spark, lines, "s2")
        batch = read_delimited(spark, [folder], format=dialect(preset), replacement="_")
        part = batch.rows().select(F.lit(preset).alias("preset"), "*")
        read = part if read is None else read.unionByName(part)
    return read


@query(
    "s3_csv_dialect",
    """
    SELECT p_partkey::VARCHAR AS p_key, 'it''s; ' || p_name AS p_name,
           CASE WHEN p_size < 10 THEN NULL ELSE p_size::VARCHAR END AS p_size,
           '' AS p_note
    FROM part
    """,
)
def s3_csv_dialect(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    line = F.concat_ws(
        ";;;",
        F.col("p_partkey").cast("string"),
        F.concat(F.lit("'it''s; "), "p_name", F.lit("'")),
        F.when(F.col("p_size") < 10, "NA").otherwise(F.col("p_size").cast("string")),
        F.lit(""),
    )
    record = F.concat_ws("\n", F.concat(F.lit("# "), "p_brand"), F.lit(""), line)
    folder = text_files(spark, parts.select(record), "s3")
    batch = read_delimited(
        spark,
        [folder],
        format=dialect(
            delimiter=";;;", quote="'", comment="#", escape="", null_string="NA"
        ),
        header=[(".*", ["P_KEY", "P_NAME", "P_SIZE", "P_NOTE"])],
        replacement="_",
    )
    return batch.rows()


@query(
    "s4_multi_header",
    """
    SELECT o_orderkey::VARCHAR AS order_key, o_orderstatus AS status,
           CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice::VARCHAR END AS price
    FROM orders
    """,
)
def s4_multi_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    finished, other = scratch(spark, "s4"), scratch(spark, "s4")
    is_finished = F.col("o_orderstatus") == "F"
    orders.filter(is_finished).select(
        F.col("o_orderkey").alias("Order Key"), F.col("o_orderstatus").alias("Status")
    ).write.csv(finished, header=True)
    orders.filter(~is_finished).select(
        F.col("o_orderstatus").alias("STATUS"),
        F.col("o_totalprice").alias("PRICE"),
        F.col("o_orderkey").alias("ORDER-KEY"),
    ).write.csv(other, header=True)
    batch = read_delimited(spark, [finished, other], has_header=True, replacement="_")
    return batch.rows()


@query(
    "s5_header_by_pattern",
    """
    SELECT c_custkey::VARCHAR AS customer_key, c_name AS name, NULL::VARCHAR AS balance,
           NULL::VARCHAR AS column_1, NULL::VARCHAR AS column_2 FROM customer
    UNION ALL
    SELECT NULL, s_name, s_acctbal::VARCHAR, NULL, NULL FROM supplier
    UNION ALL
    SELECT NULL, NULL, NULL, p_partkey::VARCHAR, p_name FROM part
    """,
)
def s5_header_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier, part = (table(spark, sf_dir, t) for t in ("customer", "supplier", "part"))
    folder = scratch(spark, "s5")
    customer.select(csv_line(F.col("c_custkey"), F.col("c_name"))).write.text(f"{folder}/customer")
    supplier.select("s_name", "s_acctbal").write.csv(f"{folder}/supplier")
    part.select("p_partkey", "p_name").write.csv(f"{folder}/part", compression="gzip")
    batch = read_delimited(
        spark,
        [f"{folder}/*"],
        header=[
            (r".*no_such_name.*", ["X"]),
            (r"PART-.*\.TXT", ["CUSTOMER_KEY", "NAME"]),
            (r"part-.*\d\.csv", ["NAME", "BALANCE"]),
        ],
        replacement="_",
    )
    columns = ["customer_key", "name", "balance", "column_1", "column_2"]
    return batch.rows().select(*columns)


@query(
    "s6_generic_header",
    """
    SELECT o_orderkey::VARCHAR AS column1, o_orderstatus AS column2,
           CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS column3
    FROM orders
    """,
)
def s6_generic_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Only finished orders have a third cell: the widest record decides.
    orders = table(spark, sf_dir, "orders")
    two = csv_line(F.col("o_orderkey"), F.col("o_orderstatus"))
    three = csv_line(F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority"))
    line = F.when(F.col("o_orderstatus") == "F", three).otherwise(two)
    folder = text_files(spark, orders.select(line), "s6")
    return read_delimited(spark, [folder], allow_extra_columns=True).rows()


@query(
    "q2_csv_bad_width",
    """
    SELECT CASE WHEN o_orderstatus = 'O' THEN 'good' ELSE 'bad' END AS side,
           CASE WHEN o_orderstatus = 'O' THEN o_orderkey::VARCHAR END AS o_key,
           CASE o_orderstatus WHEN 'O' THEN o_orderpriority
                WHEN 'F' THEN o_orderkey || ',"' || o_orderpriority || '",extra'
                ELSE o_orderkey::VARCHAR END AS o_priority
    FROM orders
    """,
)
def q2_csv_bad_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    quoted_priority = F.concat(F.lit('"'), "o_orderpriority", F.lit('"'))
    line = (
        F.when(F.col("o_orderstatus") == "O", F.concat_ws(",", key, quoted_priority))
        .when(F.col("o_orderstatus") == "F", F.concat_ws(",", key, quoted_priority, F.lit("extra")))
        .otherwise(key)
    )
    folder = text_files(spark, orders.select(line), "q2")
    batch = read_delimited(
        spark, [folder], header=[(".*", ["O_KEY", "O_PRIORITY"])], replacement="_"
    )
    return sides(batch, "o_key", "o_priority")


@query(
    "d6_extra_cols",
    """
    SELECT o_orderkey::VARCHAR AS okey,
           CASE WHEN o_orderstatus IN ('O', 'F') THEN o_orderpriority END AS opriority
    FROM orders
    """,
)
def d6_extra_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key, priority = F.col("o_orderkey").cast("string"), F.col("o_orderpriority")
    line = (
        F.when(F.col("o_orderstatus") == "O", F.concat_ws(",", key, priority))
        .when(F.col("o_orderstatus") == "F", F.concat_ws(",", key, priority, F.lit("x"), F.lit("y")))
        .otherwise(key)
    )
    folder = text_files(spark, orders.select(line), "d6")
    batch = read_delimited(
        spark, [folder], header=[(".*", ["O_KEY", "O_PRIORITY"])], allow_extra_columns=True
    )
    return batch.rows()


@query(
    "d7_gzip",
    """
    SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderpriority,
           o_totalprice::VARCHAR AS o_totalprice FROM orders
    """,
)
def d7_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "d7")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    orders.write.csv(folder, header=True, compression="gzip")
    return read_delimited(spark, [folder], has_header=True, replacement="_").rows()


@query(
    "s9_multi_glob",
    "SELECT c_custkey::VARCHAR AS ckey, c_name AS cname FROM customer",
)
def s9_multi_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    folder = scratch(spark, "s9")
    rich = F.col("c_acctbal") > 5000
    named = customers.select(F.col("c_custkey").alias("C KEY"), F.col("c_name").alias("C NAME"))
    named.filter(rich).write.csv(f"{folder}/rich", header=True)
    named.filter(~rich | rich.isNull()).write.csv(f"{folder}/other", header=True)
    listed = text_files(
        spark,
        spark.range(1).select(
            F.lit(f"{folder}/rich/*.csv~{folder}/none/*.csv~{folder}/oth*/part-*")
        ),
        "s9list",
    )
    # The patterns come from a file, which takes the place of the other list.
    patterns = file_patterns(spark, "/not/used", patterns_from_file=f"{listed}/*.txt")
    return read_delimited(spark, patterns, has_header=True).rows()


@query(
    "s18_positional",
    """
    SELECT s_suppkey::VARCHAR AS field_1, s_name AS field_2, s_acctbal::VARCHAR AS field_3
    FROM supplier
    """,
)
def s18_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "s18")
    table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal").write.csv(folder)
    return read_staged(spark, [folder], replacement="_").rows()


# --- JSON -----------------------------------------------------------------------------


def broken_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON lines; those of finished orders are cut off."""
    orders = table(spark, sf_dir, "orders")
    text = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("ORDER KEY"),
            F.col("o_orderpriority").alias("PRIORITY"),
            F.col("o_totalprice").alias("PRICE"),
        )
    )
    cut = F.substring(text, 1, F.length(text) - 1)
    return orders.select(F.when(F.col("o_orderstatus") == "F", cut).otherwise(text).alias("line"))


@query(
    "s7_json_lines",
    """
    SELECT o_orderkey::VARCHAR AS order_key, o_orderpriority AS priority,
           o_totalprice::VARCHAR AS price
    FROM orders WHERE o_orderstatus <> 'F'
    """,
)
def s7_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = text_files(spark, broken_order_lines(spark, sf_dir), "s7")
    return read_json_lines(spark, [folder], replacement="_").rows()


@query(
    "t10_json_bad",
    """
    SELECT '{"ORDER KEY":' || o_orderkey || ',"PRIORITY":"' || o_orderpriority
           || '","PRICE":' || o_totalprice AS raw_data, 'txt_error' AS table_name
    FROM orders WHERE o_orderstatus = 'F'
    """,
)
def t10_json_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = text_files(spark, broken_order_lines(spark, sf_dir), "t10")
    batch = read_json_lines(
        spark, [folder], destination=Destination(pattern=r"part-.*\.(txt)", group=1)
    )
    return batch.bad.select(F.col("rawData").alias("raw_data"), F.col("_table").alias("table_name"))


@query(
    "t9_error_record",
    """
    SELECT count(*) AS rejected, 'errorMessage,rawData' AS columns,
           count(*) AS with_message
    FROM orders WHERE o_orderstatus = 'F'
    """,
)
def t9_error_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = text_files(spark, broken_order_lines(spark, sf_dir), "t9")
    rejects = read_json_lines(spark, [folder]).rejects()
    return rejects.agg(
        F.count(F.lit(1)).alias("rejected"),
        F.first(F.lit(",".join(rejects.columns))).alias("columns"),
        F.count("errorMessage").alias("with_message"),
    )


@query(
    "t2_schema_union",
    """
    SELECT event_id::VARCHAR AS eventid,
           CASE event_type WHEN 'click' THEN value::VARCHAR END AS clickvalue,
           CASE event_type WHEN 'view' THEN '[' || user_id || ',"' || event_type || '"]' END
               AS viewtags,
           CASE event_type WHEN 'purchase' THEN json_extract_string(props, '$.k') END AS propsk,
           CASE event_type WHEN 'click' THEN event_type
                WHEN 'view' THEN '{"N":' || user_id || '}' ELSE NULL END AS mixed
    FROM events
    """,
)
def t2_schema_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose keys depend on their type; ``mixed`` is text here and an object there."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    user = F.col("user_id").cast("string")
    parts = [
        F.concat(F.lit('"Event ID":'), F.col("event_id").cast("string")),
        F.when(kind == "click", F.concat(F.lit('"Click-Value":'), F.col("value").cast("string"))),
        F.when(
            kind == "view",
            F.concat(F.lit('"View.Tags":['), user, F.lit(',"'), kind, F.lit('"]')),
        ),
        F.when(kind == "purchase", F.concat(F.lit('"Props":'), "props")),
        F.when(kind == "click", F.concat(F.lit('"MIXED":"'), kind, F.lit('"'))).when(
            kind == "view", F.concat(F.lit('"MIXED":{"N":'), user, F.lit("}"))
        ),
    ]
    text = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    folder = text_files(spark, events.select(text), "t2")
    rows = read_json_lines(spark, [folder]).rows()
    tags = F.col("viewtags")
    return rows.select(
        "eventid",
        "clickvalue",
        F.concat(F.lit("["), tags[0], F.lit(',"'), tags[1], F.lit('"]')).alias("viewtags"),
        F.col("props")["k"].alias("propsk"),
        "mixed",
    )


@query(
    "s19_documents",
    """
    SELECT conv_id || '-' || turn AS oid, turn::VARCHAR AS turn, role, text
    FROM conversations
    """,
)
def s19_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    oid = F.concat_ws("-", "conv_id", "turn")
    documents = conversations.select(
        F.to_json(
            F.struct(F.struct(oid.alias("$oid")).alias("_id"), "turn", "role", "text")
        ).alias("document")
    )
    rows = read_documents(documents, "document").rows()
    return rows.select(F.col("id")["oid"].alias("oid"), "turn", "role", "text")


@query(
    "d5_jsonpath",
    """
    SELECT event_id::VARCHAR AS event_id, json_extract_string(props, '$.k') AS k,
           event_type AS second_tag, NULL::VARCHAR AS attachment
    FROM events
    """,
)
def d5_jsonpath(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    text = F.to_json(
        F.struct(
            F.col("event_id").alias("id"),
            F.struct(
                F.from_json("props", "k bigint").alias("props"),
                F.array(F.struct(F.col("user_id").cast("string").alias("name")),
                        F.struct(F.col("event_type").alias("name"))).alias("tags"),
            ).alias("event"),
        )
    )
    folder = text_files(spark, events.select(text), "d5")
    batch = read_json_lines(
        spark,
        [folder],
        json_fields={
            "EVENT_ID": "id",
            "K": "$.event.props.k",
            "SECOND_TAG": "$.event.tags[1].name",
            "ATTACHMENT": "",
        },
        replacement="_",
    )
    return batch.rows()


# --- XML ------------------------------------------------------------------------------

PER_FILE = 20


def xml_text(column: Column) -> Column:
    """Text with the characters that XML reserves escaped."""
    text = F.replace(column, F.lit("&"), F.lit("&amp;"))
    return F.replace(text, F.lit("<"), F.lit("&lt;"))


def customer_xml(spark: SparkSession, sf_dir: str, closing: Column | None = None) -> DataFrame:
    """One XML text per 20 customers."""
    record = F.concat(
        F.lit('<record id="'),
        F.col("c_custkey").cast("string"),
        F.lit('"><NAME>'),
        xml_text(F.col("c_name")),
        F.lit("</NAME><CODE>00"),
        F.col("c_nationkey").cast("string"),
        F.lit("</CODE><TAGS><value>"),
        "c_mktsegment",
        F.lit("</value>"),
        F.when(F.col("c_acctbal") > 0, "<value>paid</value>").otherwise(""),
        F.lit("</TAGS></record>"),
    )
    row = F.struct("c_custkey", record.alias("record"), "c_acctbal")
    files = (
        table(spark, sf_dir, "customer")
        .groupBy(F.floor(F.col("c_custkey") / PER_FILE).alias("file"))
        .agg(F.array_sort(F.collect_list(row)).alias("rows"))
    )
    end = F.lit("</root>") if closing is None else closing
    body = F.array_join(F.transform("rows", lambda r: r["record"]), "")
    return files.select(F.concat(F.lit("<root>"), body, end).alias("xml"))


XML_ROWS = """
    SELECT c_custkey::VARCHAR AS id, c_name AS name, '00' || c_nationkey AS code,
           c_mktsegment AS first_tag, CASE WHEN c_acctbal > 0 THEN 'paid' END AS second_tag
    FROM customer
"""


def xml_columns(rows: DataFrame) -> DataFrame:
    tags = F.col("tags")["value"]
    return rows.select(
        "id", "name", "code", F.get(tags, 0).alias("first_tag"), F.get(tags, 1).alias("second_tag")
    )


@query("s8_xml", XML_ROWS)
def s8_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = one_file_per_row(spark, customer_xml(spark, sf_dir), "s8")
    return xml_columns(read_xml(spark, [folder]).rows())


@query("s8_xml_rowtag", XML_ROWS)
def s8_xml_rowtag(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = one_file_per_row(spark, customer_xml(spark, sf_dir), "s8tag")
    return xml_columns(read_xml(spark, [folder], row_tag="record").rows())


@query(
    "s8_xml_bad",
    f"""
    WITH files AS (
        SELECT c_custkey // {PER_FILE} AS file, max(c_acctbal) > 9900 AS broken,
               '<root>' || string_agg(
                   '<record id="' || c_custkey || '"><NAME>' || c_name || '</NAME><CODE>00'
                   || c_nationkey || '</CODE><TAGS><value>' || c_mktsegment || '</value>'
                   || CASE WHEN c_acctbal > 0 THEN '<value>paid</value>' ELSE '' END
                   || '</TAGS></record>', '' ORDER BY c_custkey)
               || '<open></root>' || chr(10) AS xml
        FROM customer GROUP BY ALL)
    SELECT 'bad' AS side, NULL::VARCHAR AS id, xml AS name FROM files WHERE broken
    UNION ALL
    SELECT 'good', c_custkey::VARCHAR, c_name FROM customer
    JOIN files ON file = c_custkey // {PER_FILE} WHERE NOT broken
    """,
)
def s8_xml_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    # An unclosed element at the end rejects the whole file.
    rich = F.array_max(F.transform("rows", lambda r: r["c_acctbal"])) > 9900
    end = F.when(rich, "<open></root>").otherwise("</root>")
    folder = one_file_per_row(spark, customer_xml(spark, sf_dir, end), "s8bad")
    return sides(read_xml(spark, [folder]), "id", "name")


# --- archives -------------------------------------------------------------------------

PER_ARCHIVE = 500


def part_archives(spark: SparkSession, sf_dir: str, suffix: Column, line: Column, head: str, ext: str):
    """Archives of 500 parts each, with an entry per brand."""
    archive = F.floor(F.col("p_partkey") / PER_ARCHIVE)
    entry = F.lower(F.regexp_replace("p_brand", "[^A-Za-z0-9]+", "_"))
    lines = (
        table(spark, sf_dir, "part")
        .groupBy(archive.alias("archive"), entry.alias("entry"))
        .agg(F.array_join(F.collect_list(line), "\n").alias("text"))
    )
    file = F.struct(
        F.concat(F.lit("./"), "entry", F.lit(ext)).alias("name"),
        F.concat(F.lit(head), "text").alias("text"),
    )
    return lines.groupBy("archive").agg(F.collect_list(file).alias("files")).select(
        F.concat(F.lit("parts_"), F.col("archive").cast("string"), suffix).alias("name"), "files"
    )


def archive_sql(archive: str) -> str:
    return f"""
    SELECT {archive} AS archive_name,
           lower(regexp_replace(p_brand, '[^A-Za-z0-9]+', '_', 'g')) || '.csv' AS file_name,
           p_partkey::VARCHAR AS key, p_name AS name
    FROM part
    """


def archive_columns(batch) -> DataFrame:
    return batch.good.select(
        F.col("_meta.meta_archive_file_name").alias("archive_name"),
        F.col("_meta.meta_file_name").alias("file_name"),
        "key",
        "name",
    )


TAR_SUFFIX = "CASE WHEN (p_partkey // 500) < 2 THEN '.tar' ELSE '.tar.gz' END"


def part_line() -> Column:
    return csv_line(F.col("p_partkey"), F.col("p_name"))


@query("s10_zip", archive_sql(f"'parts_' || (p_partkey // {PER_ARCHIVE}) || '.zip'"))
def s10_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = part_archives(spark, sf_dir, F.lit(".zip"), part_line(), "KEY,NAME\n", ".csv")
    folder = archives(spark, made, "s10", "zip")
    return archive_columns(
        read_delimited(spark, [f"{folder}/*.zip"], has_header=True, compression="ZIP")
    )


@query("s11_tar", archive_sql(f"'parts_' || (p_partkey // {PER_ARCHIVE}) || {TAR_SUFFIX}"))
def s11_tar(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = F.when(F.col("archive") < 2, ".tar").otherwise(".tar.gz")
    made = part_archives(spark, sf_dir, suffix, part_line(), "KEY,NAME\n", ".csv")
    folder = archives(spark, made, "s11", "tar")
    return archive_columns(
        read_delimited(spark, [f"{folder}/*.tar*"], has_header=True, compression="TAR")
    )


@query(
    "s12_skip",
    """
    SELECT 'parts_' || (p_partkey // 500) || '.zip' AS archive_name,
           lower(regexp_replace(p_brand, '[^A-Za-z0-9]+', '_', 'g')) || '.csv' AS file_name,
           p_partkey::VARCHAR AS key, p_name AS name
    FROM part WHERE p_brand NOT IN ('Brand#1', 'Brand#2')
    """,
)
def s12_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = part_archives(spark, sf_dir, F.lit(".zip"), part_line(), "KEY,NAME\n", ".csv")
    folder = archives(spark, made, "s12", "zip")
    return archive_columns(
        read_delimited(
            spark,
            [folder],
            has_header=True,
            compression="ZIP",
            skip=[r"\./brand_[12]\.csv", "brand"],
        )
    )


@query(
    "s10_zip_json",
    """
    SELECT 'parts_' || (p_partkey // 500) || '.zip' AS archive_name,
           p_partkey::VARCHAR AS key, p_name AS name,
           lower(regexp_replace(p_brand, '[^A-Za-z0-9]+', '_', 'g')) || '_json' AS table_name
    FROM part
    """,
)
def s10_zip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.to_json(F.struct(F.col("p_partkey").alias("KEY"), F.col("p_name").alias("NAME")))
    made = part_archives(spark, sf_dir, F.lit(".zip"), line, "", ".json")
    folder = archives(spark, made, "s10json", "zip")
    batch = read_json_lines(
        spark, [folder], compression="ZIP", destination=Destination(), redistribute=8
    )
    return batch.good.select(
        F.col("_meta.meta_archive_file_name").alias("archive_name"),
        "key",
        "name",
        F.col("_table").alias("table_name"),
    )


@query(
    "s1_mixed_line_ends",
    """
    SELECT setting, o_orderkey::VARCHAR AS "key", o_orderstatus AS status
    FROM orders, (VALUES ('128m'), ('8k')) AS v(setting)
    """,
)
def s1_mixed_line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with several line ends give the same rows whole and cut in ranges."""
    end = F.when(F.col("o_orderkey") % 7 == 0, F.lit("")).otherwise(F.lit("\r"))
    status = F.concat(F.col("o_orderstatus"), end)
    lines = table(spark, sf_dir, "orders").select(F.concat_ws(",", F.col("o_orderkey").cast("string"), status))
    folder = text_files(spark, lines.repartition(6), "mixed")
    return in_two_sizes(spark, folder, ["KEY", "STATUS"])


def in_two_sizes(spark: SparkSession, folder: str, header: list[str]) -> DataFrame:
    """The rows of delimited files, read in large ranges and in small ones, with the ``setting``."""
    names, found = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"), []
    before = [spark.conf.get(n, None) for n in names]
    for size in ("128m", "8k"):
        try:
            for name in names:
                spark.conf.set(name, size)
            batch = read_delimited(spark, [f"{folder}/*.txt"], header=[(".*", header)])
            rows = batch.rows().select(F.lit(size).alias("setting"), *batch.columns)
            kept = scratch(spark, "read-rows")
            rows.write.parquet(kept)
            found.append(spark.read.parquet(kept))
        finally:
            for name, value in zip(names, before, strict=True):
                spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return found[0].unionByName(found[1])


@query(
    "s1_quoted_line_ends",
    """
    SELECT setting, o_orderkey::VARCHAR AS "key",
           CASE o_orderkey % 5 WHEN 0 THEN 'plain' WHEN 1 THEN 'to' || chr(10) || '"' || o_orderpriority || '", ' || chr(10) || chr(10)
           WHEN 2 THEN chr(13) || chr(10) || 'x' ELSE o_orderpriority END AS note,
           o_orderstatus AS status
    FROM orders, (VALUES ('128m'), ('8k')) AS v(setting)
    """,
)
def s1_quoted_line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with line ends within cells are cut in ranges too; a range knows how it begins."""
    kind = F.col("o_orderkey") % 5
    note = (
        F.when(kind == 0, F.lit("plain"))
        .when(kind == 1, F.concat(F.lit('"to\n""'), "o_orderpriority", F.lit('"", \n\n"')))
        .when(kind == 2, F.lit('"\r\nx"'))
        .otherwise(F.col("o_orderpriority"))
    )
    key = F.col("o_orderkey").cast("string")
    lines = table(spark, sf_dir, "orders").select(F.concat_ws(",", key, note, "o_orderstatus"))
    folder = text_files(spark, lines.repartition(6), "quoted")
    return in_two_sizes(spark, folder, ["KEY", "NOTE", "STATUS"])


ODD_FILES = 24


@query(
    "s9_odd_names",
    f"""
    SELECT o_orderkey::VARCHAR AS "key",
           CASE o_orderkey % 3 WHEN 0 THEN '_' WHEN 1 THEN '.' ELSE '' END || (o_orderkey % {ODD_FILES}) || '.csv' AS file
    FROM orders
    """,
)
def s9_odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that Spark's scans leave out for their names are read when a pattern names them."""
    number = F.col("o_orderkey") % ODD_FILES
    lines = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("value"), number.alias("n"))
    written = scratch(spark, "odd")
    lines.repartition(ODD_FILES, "n").write.partitionBy("n").text(written)
    target = Folder(spark, written)
    for part in target.data_files(""):
        n = int(part.partition("/")[0].partition("=")[2])
        target.move(part, f"all/{('_', '.', '')[n % 3]}{n}.csv")
    batch = read_delimited(spark, [f"{written}/all/*.csv"], header=[(".*", ["KEY"])])
    return batch.good.select("key", F.col("_meta.meta_file_name").alias("file"))
