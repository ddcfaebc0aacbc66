"""Queries that transform rows: tables in, flattening, metadata, latest records."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.batch import META, TABLE, Batch, from_frame, no_rejects
from quayside.functions.names import attribute_text, file_stem
from quayside.operators.documents import parse_documents
from quayside.operators.flatten import flatten
from quayside.operators.latest import latest
from quayside.operators.metadata import (
    constant_metadata,
    derived_metadata,
    file_name_metadata,
    inject_metadata,
    read_lookup,
    rename_columns,
    token_metadata,
)
from quayside.operators.routing import redistribute
from quayside.operators.standardise import standardise
from quayside.plans.fixtures import table, text_files
from quayside.plans.registry import query
from quayside.plans.steps import run_steps
from quayside.sources.databases import clean_columns
from quayside.sources.json_lines import read_documents, read_json_lines
from quayside.sources.tables import read_table

LOADED = datetime(2024, 2, 29, 12, 30, 15, 250000, tzinfo=UTC)


def with_file_names(rows: DataFrame, file_name) -> Batch:
    """Rows that know a file they came from."""
    good = rows.withColumn(META, F.struct(file_name.alias("meta_file_name"))).withColumn(
        TABLE, F.lit(None).cast("string")
    )
    return Batch(good, no_rejects(good), bad_tables=[])


# --- tables in ------------------------------------------------------------------------


@query(
    "s15_jdbc_names",
    """
    SELECT s_suppkey AS supp_key, s_name AS name, s_acctbal AS account_balance,
           s_nationkey AS "2nd_key" FROM supplier
    """,
)
def s15_jdbc_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("SUPP-KEY"),
        F.col("s_name").alias("_Name_"),
        F.col("s_acctbal").alias("Account Balance"),
        F.col("s_nationkey").alias("2nd.KEY"),
    )
    return clean_columns(odd, "_")


@query("s16_table", "SELECT * FROM lineitem")
def s16_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = f"lineitem_{uuid.uuid4().hex}"
    table(spark, sf_dir, "lineitem").createOrReplaceTempView(view)
    return read_table(spark, table=view).rows()


@query(
    "s17_query",
    """
    SELECT o_orderpriority, o_orderstatus, count(*) AS n,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) * 100 AS BIGINT) AS cents
    FROM orders GROUP BY ALL
    """,
)
def s17_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = f"orders_{uuid.uuid4().hex}"
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    text = f"""
        SELECT o_orderpriority, o_orderstatus, count(*) AS n,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) * 100 AS BIGINT) AS cents
        FROM {view} GROUP BY o_orderpriority, o_orderstatus
    """
    return read_table(spark, query=text).rows()


# --- flatten --------------------------------------------------------------------------


@query(
    "t3_flatten",
    """
    SELECT event_id::VARCHAR AS id, json_extract_string(props, '$.k') AS props_k,
           event_type AS tags_1, user_id::VARCHAR AS tags_2,
           CASE WHEN event_type <> 'click' THEN value::VARCHAR END AS deep_list_1_v,
           CASE WHEN event_type = 'view' THEN event_type END AS deep_list_2_kind
    FROM events
    """,
)
def t3_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps, arrays and maps in arrays in maps; the list of clicks is empty."""
    events = table(spark, sf_dir, "events")
    kind, none = F.col("event_type"), F.lit(None).cast("string")
    value = F.struct(F.col("value").alias("v"), none.alias("kind"))
    typed = F.struct(none.cast("double").alias("v"), kind.alias("kind"))
    items = (
        F.when(kind == "view", F.array(value, typed))
        .when(kind == "click", F.array().cast("array<struct<v:double,kind:string>>"))
        .otherwise(F.array(value))
    )
    text = F.to_json(
        F.struct(
            F.col("event_id").alias("ID"),
            F.from_json("props", "k bigint").alias("PROPS"),
            F.array(kind, F.col("user_id").cast("string")).alias("TAGS"),
            F.struct(items.alias("LIST")).alias("DEEP"),
            F.array().cast("array<string>").alias("EMPTY"),
            F.create_map().cast("map<string,string>").alias("NOTHING"),
        )
    )
    return flatten(read_documents(events.select(text.alias("value")))).rows()


# --- metadata -------------------------------------------------------------------------


@query(
    "t4_metadata",
    """
    SELECT 'nation_' || c_nationkey || '.csv' AS meta_file_name,
           '2024-02-29 12:30:15.250000' AS meta_load_timestamp,
           c_custkey AS customer, c_name
    FROM customer
    """,
)
def t4_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    file = F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"), F.lit(".csv"))
    batch = with_file_names(customer, file)
    shown = inject_metadata(
        Batch(batch.good.select("c_custkey", "c_name", TABLE, META), batch.bad),
        load_timestamp=LOADED,
        rename={"c_custkey": "customer", "missing": "never"},
    ).rows()
    at = F.to_utc_timestamp("meta_load_timestamp", F.current_timezone())
    at = F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return shown.withColumn("meta_load_timestamp", at)


@query(
    "t5_rename",
    """
    SELECT o_orderkey AS "ORDER", o_orderstatus AS "Status of order", o_totalprice
    FROM orders
    """,
)
def t5_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    names = {"o_orderkey": "ORDER", "o_orderstatus": "Status of order", "no_such": "x"}
    return rename_columns(from_frame(orders), names).rows()


def order_files(spark: SparkSession, sf_dir: str) -> Batch:
    """Orders that came from files named after their date and customer."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyyMMdd").alias("day"), "o_orderstatus"
    )
    dated = F.concat_ws("_", F.lit("land"), "day", F.col("o_custkey").cast("string"))
    name = F.when(F.col("o_orderstatus") == "F", F.lit("land.v2.csv")).otherwise(
        F.concat(dated, F.lit(".csv"))
    )
    return with_file_names(orders, name)


@query(
    "t6_ministry",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'F' THEN '2' ELSE o_custkey::VARCHAR END AS meta_ministryid,
           CASE WHEN o_orderstatus <> 'F' THEN strftime(o_orderdate, '%Y%m%d') END AS meta_filedate,
           CASE WHEN o_orderstatus <> 'F' THEN c_name END AS meta_ministry
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey <> 2
    """,
)
def t6_ministry(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    lookup = customers.select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name")
    ).filter(F.col("id") != "2")
    shown = inject_metadata(file_name_metadata(order_files(spark, sf_dir), lookup)).rows()
    return shown.select("o_orderkey", "meta_ministryid", "meta_filedate", "meta_ministry")


@query(
    "t7_lookup",
    """
    SELECT c_custkey, c_nationkey::VARCHAR AS meta_ministryid, n_name AS meta_ministry
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 0
    """,
)
def t7_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").filter("n_regionkey <> 0")
    entry = F.concat(
        F.lit('"'), F.col("n_nationkey").cast("string"), F.lit('": "'), "n_name", F.lit('"')
    )
    text = nations.agg(
        F.concat(F.lit("{"), F.array_join(F.collect_list(entry), ",\n"), F.lit("}"))
    )
    lookup = read_lookup(spark, text_files(spark, text, "t7") + "/*.txt")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    name = F.concat(F.lit("customers_of_"), F.col("c_nationkey").cast("string"), F.lit(".csv"))
    shown = inject_metadata(file_name_metadata(with_file_names(customers, name), lookup)).rows()
    return shown.select("c_custkey", "meta_ministryid", "meta_ministry")


@query(
    "t11_both",
    """
    SELECT CASE WHEN event_type = 'error' THEN 'bad' ELSE 'good' END AS side,
           count(*) AS n, 'here' AS place, '2024' AS year
    FROM events GROUP BY ALL
    """,
)
def t11_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One custom transform over good rows and rejects."""
    events = table(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "error", "props:").otherwise(F.col("props"))
    batch = read_documents(events.select(text.alias("value")))
    tagged = batch.map(lambda df: df.withColumn("place", F.lit("here")).withColumn("year", F.lit("2024")))
    frames = (("good", tagged.rows()), ("bad", tagged.rejects()))
    counts = [
        df.groupBy("place", "year").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(side).alias("side"), "n", "place", "year"
        )
        for side, df in frames
    ]
    return counts[0].unionByName(counts[1])


@query("t13_redistribute", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def t13_redistribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return redistribute(orders, 16)


@query(
    "s21_attrs",
    """
    SELECT event_id,
           'type=' || event_type || ',user=' || user_id
           || CASE WHEN event_type = 'view' THEN ',seen=true' ELSE '' END AS attributes,
           '' AS none
    FROM events
    """,
)
def s21_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    two = F.create_map(F.lit("type"), "event_type", F.lit("user"), F.col("user_id").cast("string"))
    three = F.map_concat(two, F.create_map(F.lit("seen"), F.lit("true")))
    attributes = F.when(F.col("event_type") == "view", three).otherwise(two)
    return events.select(
        "event_id",
        attribute_text(attributes).alias("attributes"),
        attribute_text(F.lit(None).cast("map<string,string>")).alias("none"),
    )


# --- custom steps and step lists ------------------------------------------------------


@query(
    "u1_custom_read",
    "SELECT s_suppkey, upper(s_name) AS s_name, 'supplier' AS kind FROM supplier",
)
def u1_custom_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    def read(spark: SparkSession, step: dict) -> DataFrame:
        rows = table(spark, sf_dir, step["name"])
        return rows.select("s_suppkey", F.upper("s_name").alias("s_name"))

    def label(df: DataFrame) -> DataFrame:
        return df.withColumn("kind", F.lit("supplier"))

    steps = [
        {"type": "read", "implementation": read, "name": "supplier"},
        {"type": "custom", "implementation": label},
    ]
    return run_steps(spark, steps).rows()


@query(
    "u2_custom",
    "SELECT c_custkey, c_name, c_acctbal * 2 AS doubled FROM customer",
)
def u2_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's transform in Python, over Arrow batches."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def double(batches):
        for batch in batches:
            doubled = pc.multiply(batch.column("c_acctbal"), 2.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("c_custkey"), batch.column("c_name"), doubled],
                names=["c_custkey", "c_name", "doubled"],
            )

    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    schema = "c_custkey bigint, c_name string, doubled double"

    def transform(batch: Batch) -> Batch:
        return from_frame(batch.rows().mapInArrow(double, schema))

    transform.takes_batch = True
    steps = [
        {"type": "read", "implementation": lambda spark, step: customers},
        {"type": "custom", "implementation": transform},
    ]
    return run_steps(spark, steps).rows()


# --- documented jobs ------------------------------------------------------------------


@query(
    "d1_latest",
    """
    SELECT event_id, ts, user_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def d1_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


@query(
    "d2_standardise",
    """
    SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'bad' ELSE 'good' END AS side,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderkey::VARCHAR END AS o_orderkey,
           CASE WHEN o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'F'
                THEN CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) END AS price,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
                ELSE '{"o_orderkey":" ' || o_orderkey || '","price":'
                     || CASE WHEN o_orderstatus = 'F' THEN '"  "' ELSE '"' || o_totalprice || '"' END
                     || ',"day":"urgent"}' END AS day
    FROM orders
    """,
)
def d2_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = F.col("o_orderpriority") == "1-URGENT"
    texts = table(spark, sf_dir, "orders").select(
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("o_orderkey"),
        F.when(F.col("o_orderstatus") == "F", "  ")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("price"),
        F.when(urgent, "urgent").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
    )
    target = {"o_orderkey": "bigint", "price": "decimal(18,2)", "day": "date"}
    batch = standardise(from_frame(texts), target)
    good = batch.good.select(
        F.lit("good").alias("side"),
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("price").cast("string").alias("price"),
        F.col("day").cast("string").alias("day"),
    )
    bad = batch.bad.select(
        F.lit("bad").alias("side"),
        F.lit(None).cast("string").alias("o_orderkey"),
        F.lit(None).cast("string").alias("price"),
        F.col("rawData").alias("day"),
    )
    return good.unionByName(bad)


@query(
    "d3_constant",
    "SELECT c_custkey, c_name, 'ward 7' AS meta_source FROM customer",
)
def d3_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = from_frame(table(spark, sf_dir, "customer"))
    shown = inject_metadata(constant_metadata(customers, "meta_source", "ward 7")).rows()
    return shown.select("c_custkey", "c_name", "meta_source")


@query(
    "d4_tokens",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'F' THEN 'land.v2' ELSE 'land' END AS meta_group,
           CASE WHEN o_orderstatus <> 'F' THEN strftime(o_orderdate, '%Y%m%d') END AS meta_day,
           CASE WHEN o_orderstatus = 'F' THEN 'LAND.V2'
                ELSE 'LAND_' || strftime(o_orderdate, '%Y%m%d') || '_' || o_custkey END AS meta_stem
    FROM orders
    """,
)
def d4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = token_metadata(order_files(spark, sf_dir), "meta_group", 1)
    batch = token_metadata(batch, "meta_day", 2)
    batch = derived_metadata(batch, "meta_stem", lambda file: F.upper(file_stem(file)))
    shown = inject_metadata(batch).rows()
    return shown.select("o_orderkey", "meta_group", "meta_day", "meta_stem")


@query(
    "d11_timestamp_name",
    """
    SELECT s_suppkey, s_name, '2024-02-29' AS loaded_on FROM supplier
    """,
)
def d11_timestamp_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = from_frame(table(spark, sf_dir, "supplier"))
    shown = inject_metadata(
        suppliers, load_timestamp=LOADED, load_timestamp_name="bq_load_timestamp"
    ).rows()
    day = F.date_format("bq_load_timestamp", "yyyy-MM-dd")
    return shown.select("s_suppkey", "s_name", day.alias("loaded_on"))


@query(
    "t2_given_schema",
    """
    SELECT l_orderkey::VARCHAR AS l_orderkey, l_linenumber::VARCHAR AS l_linenumber,
           l_extendedprice::VARCHAR AS l_extendedprice, l_returnflag AS flag_1
    FROM lineitem
    """,
)
def t2_given_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schema given by the user skips the discovery pass."""
    from pyspark.sql import types as T

    lines = table(spark, sf_dir, "lineitem").select(
        F.to_json(
            F.struct(
                "l_orderkey",
                "l_linenumber",
                "l_extendedprice",
                F.array("l_returnflag").alias("flag"),
                "l_linestatus",
            )
        )
    )
    folder = text_files(spark, lines, "t2given")
    schema = T.StructType.fromDDL(
        "l_orderkey string, l_linenumber string, l_extendedprice string, flag array<string>"
    )
    rows = read_json_lines(spark, [folder], replacement="_", schema=schema).rows()
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice", F.col("flag")[0].alias("flag_1"))


@query(
    "t2_repeated_nested_keys",
    """
    SELECT c_custkey::VARCHAR AS id, c_name AS last_name, CASE WHEN c_custkey % 2 = 0 THEN 'x' END AS other
    FROM customer
    """,
)
def t2_repeated_nested_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a nested key that comes twice the last value stays, and no column is lost."""
    customers = table(spark, sf_dir, "customer")
    name, key = F.to_json(F.array("c_name")), F.col("c_custkey").cast("string")
    name = F.substring(name, 2, 1_000_000)
    value = F.concat(
        F.lit('{"ID":'), key, F.lit(',"A":{"N":"first","N":'), F.expr("left(n, length(n) - 1)"), F.lit("}"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit(',"OTHER":"x"')).otherwise(F.lit("")), F.lit("}"),
    )
    batch = read_documents(customers.withColumn("n", name).select(value.alias("value")))
    return batch.rows().select("id", F.try_element_at("a", F.lit("n")).alias("last_name"), "other")


@query(
    "t3_many_destinations",
    """
    SELECT 't' || (c_custkey % 200) AS "table", c_custkey::VARCHAR AS a_id, c_name AS a_name, 61 AS columns
    FROM customer
    """,
)
def t3_many_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """200 destinations with the same 61 leaves are 61 columns."""
    fill = F.create_map(*[x for i in range(59) for x in (F.lit(f"k{i}"), F.lit("v"))])
    own = F.create_map(F.lit("id"), F.col("c_custkey").cast("string"), F.lit("name"), F.col("c_name"))
    documents = table(spark, sf_dir, "customer").select(
        F.to_json(F.struct(F.map_concat(fill, own).alias("a"))).alias("value"),
        F.concat(F.lit("t"), (F.col("c_custkey") % 200).cast("string")).alias(TABLE),
        F.struct(F.lit("f").alias("meta_file_name")).alias(META),
    )
    flat = flatten(parse_documents(documents, routed=True), max_columns=100)
    good = flat.good
    return good.select(
        F.col(TABLE).alias("table"), "a_id", "a_name", F.lit(len(flat.columns)).alias("columns")
    )


@query(
    "p1_documented_steps",
    """
    SELECT o_custkey::VARCHAR AS customer, max(o_orderkey) AS newest, 'orders' AS kind
    FROM orders GROUP BY o_custkey
    """,
)
def p1_documented_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constant metadata, standard types and the latest record of a key as steps."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("customer"),
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("newest"),
    )
    steps = [
        {"type": "Read", "implementation": lambda *_: orders},
        {"type": "AddMetadata", "fields": [{"fieldName": "kind", "fieldValue": "orders"}]},
        {"type": "InjectMetadata"},
        {"type": "Standardise", "types": {"newest": "long"}},
        {"type": "Latest", "keys": ["customer"], "orderBy": ["newest"]},
    ]
    return run_steps(spark, steps).rows().select("customer", "newest", "kind")
