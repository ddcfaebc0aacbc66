"""Queries that land batches and streams, and read back what has landed."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.batch import META, TABLE, Batch, LandingError, from_frame, with_hidden
from quayside.functions.names import Destination
from quayside.operators.flatten import flatten
from quayside.operators.metadata import inject_metadata
from quayside.operators.routing import route
from quayside.plans.fixtures import new_dataset, table, text_files
from quayside.plans.registry import query
from quayside.plans.steps import JobOptions, run_steps
from quayside.scratch import scratch
from quayside.sinks.commits import Folder
from quayside.sinks.files import FileSink, land_files
from quayside.sinks.tables import TableSink, fan_out, land_tables
from quayside.sources.json_lines import read_documents, read_json_lines
from quayside.sources.messages import read_messages
from quayside.sources.spark_files import read_files
from quayside.streaming.landing import AT_LEAST_ONCE, EXACTLY_ONCE, STREAMING_INSERTS, land_stream

DAY = datetime(2024, 2, 29, tzinfo=UTC)
# The Avro module is not part of Spark itself; the layout is the same in any format.
FORMAT = "parquet"


def orders_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
        F.col("o_orderdate").cast("timestamp").alias("o_orderdate"),
    )


def event_documents(spark: SparkSession, sf_dir: str, only_type: str | None = None) -> DataFrame:
    """Events as JSON documents with keys that depend on their type; errors are broken."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    text = F.to_json(
        F.struct(
            F.col("event_id").alias("ID"),
            kind.alias("TYPE"),
            F.when(kind == "click", F.col("value")).alias("CLICK"),
            F.when(kind == "view", F.array("user_id")).alias("SEEN"),
        )
    )
    broken = F.concat(F.lit('{"ID": '), F.col("event_id").cast("string"))
    return events.select(
        F.when(kind == "error", broken).otherwise(text).alias("value"), "event_id", "event_type"
    )


# --- table sinks ----------------------------------------------------------------------


@query("w1_land", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def w1_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = new_dataset(spark, "w1")
    batch = from_frame(orders_of(spark, sf_dir).select("o_orderkey", "o_orderstatus", "o_totalprice"))
    land_tables(batch, TableSink(dataset, "orders"))
    return spark.table(f"{dataset}.orders")


@query(
    "w2_create",
    """
    SELECT o_orderpriority, count(*) AS n, 'refused' AS without_table
    FROM orders GROUP BY ALL
    """,
)
def w2_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = new_dataset(spark, "w2")
    batch = from_frame(orders_of(spark, sf_dir))
    try:
        land_tables(batch, TableSink(dataset, "orders", create="CREATE_NEVER"))
        outcome = "landed"
    except LandingError:
        outcome = "refused"
    land_tables(batch, TableSink(dataset, "orders"))
    counts = spark.table(f"{dataset}.orders").groupBy("o_orderpriority")
    return counts.agg(F.count(F.lit(1)).alias("n")).withColumn("without_table", F.lit(outcome))


@query(
    "w3_truncate",
    """
    SELECT 'truncated' AS name, o_orderkey FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'appended', o_orderkey FROM orders
    UNION ALL SELECT 'refused', o_orderkey FROM orders WHERE o_orderstatus <> 'F'
    """,
)
def w3_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = new_dataset(spark, "w3")
    orders = orders_of(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    finished = from_frame(orders.filter("o_orderstatus = 'F'"))
    other = from_frame(orders.filter("o_orderstatus <> 'F'"))
    for name, second in (("truncated", "WRITE_TRUNCATE"), ("appended", "WRITE_APPEND"),
                         ("refused", "WRITE_EMPTY")):
        land_tables(other, TableSink(dataset, name))
        try:
            land_tables(finished, TableSink(dataset, name, write=second))
        except LandingError:
            if name != "refused":
                raise
    found = [
        spark.table(f"{dataset}.{name}").select(F.lit(name).alias("name"), "o_orderkey")
        for name in ("truncated", "appended", "refused")
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    "w4_partition",
    """
    SELECT strftime(o_orderdate, '%Y-%m-01') AS month, count(*) AS n,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) * 100 AS BIGINT) AS cents
    FROM orders GROUP BY ALL
    """,
)
def w4_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = new_dataset(spark, "w4")
    sink = TableSink(dataset, "orders", partition_by=("o_orderdate", "MONTH"))
    land_tables(from_frame(orders_of(spark, sf_dir)), sink)
    landed = spark.table(f"{dataset}.orders")
    return landed.groupBy(F.col("o_orderdate_month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum(F.col("o_totalprice").cast("decimal(18,2)")) * 100).cast("bigint").alias("cents"),
    )


@query(
    "w5_evolve",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority,
           CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice
    FROM orders
    """,
)
def w5_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = new_dataset(spark, "w5")
    orders = orders_of(spark, sf_dir)
    finished = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderpriority")
    other = orders.filter("o_orderstatus <> 'F'").select("o_totalprice", "o_orderkey")
    land_tables(from_frame(finished), TableSink(dataset, "orders"))
    land_tables(from_frame(other), TableSink(dataset, "orders"))
    return spark.table(f"{dataset}.orders")


@query(
    "w6_batch",
    "SELECT o_orderkey, o_orderpriority, o_totalprice, 2 AS copies FROM orders",
)
def w6_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = new_dataset(spark, "w6")
    batch = from_frame(orders_of(spark, sf_dir).drop("o_orderdate", "o_orderstatus"))
    for _ in range(2):
        land_tables(batch, TableSink(dataset, "orders"))
    landed = spark.table(f"{dataset}.orders")
    copies = landed.groupBy(*landed.columns).agg(F.count(F.lit(1)).cast("int").alias("copies"))
    return copies.select("o_orderkey", "o_orderpriority", "o_totalprice", "copies")


@query(
    "t12_routing",
    """
    SELECT 'click' AS table_name, 'click,id,type' AS columns, event_id::VARCHAR AS id
    FROM events WHERE event_type = 'click'
    UNION ALL SELECT 'view', 'id,seen,type', event_id::VARCHAR FROM events WHERE event_type = 'view'
    UNION ALL SELECT 'purchase', 'id,type', event_id::VARCHAR
    FROM events WHERE event_type = 'purchase'
    UNION ALL SELECT 'signup', 'id,type', event_id::VARCHAR FROM events WHERE event_type = 'signup'
    UNION ALL SELECT 'error_error', 'errorMessage,rawData', '{"ID": ' || event_id
    FROM events WHERE event_type = 'error'
    """,
)
def t12_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row asks for its table; each table has the columns its rows have."""
    from quayside.batch import empty_meta
    from quayside.operators.documents import parse_documents

    dataset = new_dataset(spark, "t12")
    documents = event_documents(spark, sf_dir).select(
        "value", F.col("event_type").alias(TABLE), empty_meta().alias(META)
    )
    land_tables(parse_documents(documents, routed=True), TableSink(dataset))
    found = None
    for name in ("click", "view", "purchase", "signup", "error_error"):
        landed = spark.table(f"{dataset}.{name}")
        shown = landed.select(
            F.lit(name).alias("table_name"),
            F.lit(",".join(sorted(landed.columns))).alias("columns"),
            F.col("rawData" if name == "error_error" else "id").alias("id"),
        )
        found = shown if found is None else found.unionByName(shown)
    return found


@query(
    "t12_many_tables",
    """
    SELECT 'segment_' || (c_custkey % 150) AS table_name, c_custkey, c_name FROM customer
    """,
)
def t12_many_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hundreds of destinations in one load."""
    dataset = new_dataset(spark, "t12many")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    chosen = F.concat(F.lit("segment_"), (F.col("c_custkey") % 150).cast("string"))
    land_tables(route(from_frame(customers), chosen), TableSink(dataset))
    place = spark.sql(f"DESCRIBE DATABASE {dataset}").filter("info_name = 'Location'").first()["info_value"]
    name = F.regexp_extract(F.col("_metadata.file_path"), r"/(segment_\d+)/[^/]*$", 1)
    return spark.read.schema(customers.schema).parquet(f"{place}/*").select(
        name.alias("table_name"), "c_custkey", "c_name"
    )


@query(
    "w4_partition_with_rejects",
    """
    SELECT CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'landed' END AS side,
           CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-01') END AS month,
           count(*) AS n
    FROM events GROUP BY ALL
    """,
)
def w4_partition_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects have no column to be stored by; they land all the same."""
    dataset = new_dataset(spark, "w4rejects")
    events = table(spark, sf_dir, "events")
    text = F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at")))
    broken = F.concat(F.lit('{"at": '), F.col("event_id").cast("string"))
    documents = events.select(F.when(F.col("event_type") == "error", broken).otherwise(text).alias("value"))
    land_tables(read_documents(documents), TableSink(dataset, "events", partition_by=("at", "MONTH")))
    good = spark.table(f"{dataset}.events").groupBy(F.col("at_month").cast("string").alias("month"))
    good = good.agg(F.count("*").alias("n")).select(F.lit("landed").alias("side"), "month", "n")
    bad = spark.table(f"{dataset}.events_error").agg(F.count("*").alias("n")).where("n > 0")
    none = F.lit(None).cast("string").alias("month")
    return good.unionByName(bad.select(F.lit("rejected").alias("side"), none, "n"))


@query(
    "w9_error_table",
    """
    SELECT CASE WHEN event_type = 'error' THEN 'events_rejected' ELSE 'events' END AS table_name,
           CASE WHEN event_type = 'error' THEN '{"ID": ' || event_id
                ELSE event_id::VARCHAR END AS content
    FROM events
    """,
)
def w9_error_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = new_dataset(spark, "w9")
    batch = read_documents(event_documents(spark, sf_dir))
    land_tables(batch, TableSink(dataset, "events", error_suffix="_rejected"))
    good = spark.table(f"{dataset}.events").select(
        F.lit("events").alias("table_name"), F.col("id").alias("content")
    )
    bad = spark.table(f"{dataset}.events_rejected").select(
        F.lit("events_rejected").alias("table_name"), F.col("rawData").alias("content")
    )
    return good.unionByName(bad)


@query(
    "w13_fanout",
    """
    SELECT sink, c_custkey, c_name FROM customer, (VALUES ('table'), ('avro'), ('callable')) v(sink)
    """,
)
def w13_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch to a table, to files and to a user's sink (U3)."""
    dataset, root, own = new_dataset(spark, "w13"), scratch(spark, "w13avro"), scratch(spark, "w13own")
    batch = from_frame(table(spark, sf_dir, "customer").select("c_custkey", "c_name"))
    fan_out(
        batch,
        [
            lambda b: land_tables(b, TableSink(dataset, "customer")),
            lambda b: land_files(b, FileSink(root, format=FORMAT), DAY),
            lambda b: b.rows().write.parquet(own),
        ],
    )
    found = [
        ("table", spark.table(f"{dataset}.customer")),
        ("avro", read_files(spark, [f"{root}/*/*/*.avro"], FORMAT).rows()),
        ("callable", spark.read.parquet(own)),
    ]
    shown = [df.select(F.lit(sink).alias("sink"), "c_custkey", "c_name") for sink, df in found]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


# --- Avro files -----------------------------------------------------------------------


@query(
    "w10_avro_layout",
    """
    SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' ELSE 'default' END AS "table",
           '2024-02-29' AS meta_load_date, o_orderkey, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS status_of
    FROM orders
    """,
)
def w10_avro_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_of(spark, sf_dir).select(
        "o_orderkey", "o_totalprice", "o_orderdate",
        F.create_map(F.lit("status"), F.array("o_orderstatus")).alias("facts"), "o_orderstatus",
    )
    finished = F.when(F.col("o_orderstatus") == "F", "finished")
    batch = route(from_frame(orders), finished)
    root = scratch(spark, "w10")
    land_files(batch, FileSink(root, format=FORMAT), DAY)
    read = read_files(spark, [f"{root}/table=*/meta_load_date=*/*.avro"], FORMAT, ("table", "meta_load_date"))
    return read.rows().select(
        "table",
        "meta_load_date",
        "o_orderkey",
        "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.col("facts")["status"][0].alias("status_of"),
    )


@query(
    "w11_shards",
    "SELECT 3 AS shards, count(*) AS n, 3 AS named FROM orders",
)
def w11_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "w11")
    batch = from_frame(orders_of(spark, sf_dir))
    land_files(batch, FileSink(root, directory="orders", suffix=".av", shards=3, format=FORMAT), DAY)
    read = read_files(spark, [f"{root}/table=orders/meta_load_date=2024-02-29/*.av"], FORMAT)
    file = F.col("_meta.meta_file_name")
    return read.good.agg(
        F.countDistinct(file).cast("int").alias("shards"),
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(F.when(file.rlike(r"^[012]-[0-9a-f-]{36}\.av$"), file)).cast("int").alias("named"),
    )


@query(
    "w12_error_dir",
    """
    SELECT CASE WHEN event_type = 'error' THEN 'events_bad' ELSE 'events' END AS "table",
           CASE WHEN event_type <> 'error' THEN event_id::VARCHAR END AS id,
           CASE WHEN event_type = 'error' THEN '{"ID": ' || event_id END AS raw
    FROM events
    """,
)
def w12_error_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "w12")
    batch = read_documents(event_documents(spark, sf_dir))
    land_files(batch, FileSink(root, directory="events", error_suffix="_bad", format=FORMAT), DAY)
    rows = read_files(spark, [f"{root}/*/*/*.avro"], FORMAT, ("table",)).rows()
    return rows.select("table", "id", F.col("rawData").alias("raw"))


# --- streams --------------------------------------------------------------------------


def message_stream(spark: SparkSession, sf_dir: str, files: int = 4, per_batch: int = 1) -> DataFrame:
    """Events as messages in several files, read as a stream of so many files per batch."""
    events = event_documents(spark, sf_dir).select(
        F.col("value").cast("binary").alias("payload"),
        F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("message_id"),
        F.create_map(F.lit("kind"), F.col("event_type")).alias("attributes"),
    )
    folder = scratch(spark, "messages")
    events.repartition(files, "message_id").write.parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


@query(
    "s20_stream",
    """
    SELECT CASE WHEN event_type = 'error' THEN 'bad' ELSE 'good' END AS side,
           'm' || event_id AS message_id, 'kind=' || event_type AS attributes,
           CASE WHEN event_type = 'click' THEN value::VARCHAR END AS click,
           CASE WHEN event_type = 'error' THEN '{"ID": ' || event_id END AS raw
    FROM events
    """,
)
def s20_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = new_dataset(spark, "s20")
    stream = land_stream(
        message_stream(spark, sf_dir),
        read_messages,
        TableSink(dataset, "events"),
        scratch(spark, "s20check"),
        steps=[inject_metadata],
        available_now=True,
    )
    stream.awaitTermination()
    shown = [
        F.col("meta_pubsub_message_id").alias("message_id"),
        F.col("meta_pubsub_attributes").alias("attributes"),
    ]
    none = F.lit(None).cast("string")
    good = spark.table(f"{dataset}.events").select(
        F.lit("good").alias("side"), *shown, "click", none.alias("raw")
    )
    bad = spark.table(f"{dataset}.events_error").select(
        F.lit("bad").alias("side"), *shown, none.alias("click"), F.col("rawData").alias("raw")
    )
    return good.unionByName(bad)


def read_events(micro: DataFrame) -> Batch:
    return read_messages(micro)


def forget_last_batch(spark: SparkSession, checkpoint: str) -> None:
    """Leave a checkpoint as it is when a batch was landed and the driver then lost."""
    commits = Folder(spark, f"{checkpoint}/commits")
    last = max(int(n) for n in commits.names("") if n.isdigit())
    commits.delete(str(last))


@query(
    "w7_stream_append",
    """
    SELECT event_id::VARCHAR AS id, event_type AS type, 1 AS copies
    FROM events WHERE event_type <> 'error'
    UNION ALL SELECT '{"ID": ' || event_id, 'rejected', 1 FROM events WHERE event_type = 'error'
    """,
)
def w7_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last micro-batch is replayed from the stream's own checkpoint: no row repeats."""
    dataset, checkpoint = new_dataset(spark, "w7"), scratch(spark, "w7check")
    messages = message_stream(spark, sf_dir)
    sink = TableSink(dataset, "events")
    for attempt in range(2):
        if attempt:
            forget_last_batch(spark, checkpoint)
        land_stream(
            messages, read_events, sink, checkpoint, method=EXACTLY_ONCE, available_now=True
        ).awaitTermination()
    good = spark.table(f"{dataset}.events").select("id", "type")
    bad = spark.table(f"{dataset}.events_error").select(F.col("rawData").alias("id"), F.lit("rejected").alias("type"))
    landed = good.unionByName(bad)
    return landed.groupBy("id", "type").agg(F.count(F.lit(1)).cast("int").alias("copies"))


def landed_copies(spark: SparkSession, dataset: str, table: str) -> DataFrame:
    """``id, side, copies`` of a table's rows and of its rejects."""
    good = spark.table(f"{dataset}.{table}").select("id", F.lit("good").alias("side"))
    bad = spark.table(f"{dataset}.{table}_error").select(F.col("rawData").alias("id"), F.lit("bad").alias("side"))
    return good.unionByName(bad).groupBy("id", "side").agg(F.count(F.lit(1)).cast("int").alias("copies"))


#: Every event once: by its id, or as the broken text it came as.
EVENT_SIDES = """
    SELECT CASE event_type WHEN 'error' THEN '{"ID": ' || event_id ELSE event_id::VARCHAR END AS id,
           CASE event_type WHEN 'error' THEN 'bad' ELSE 'good' END AS side
    FROM events
"""


@query("w7_two_streams", f"SELECT id, side, 2 AS copies FROM ({EVENT_SIDES})")
def w7_two_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams append all of their rows to one table."""
    dataset = new_dataset(spark, "w7two")
    messages = message_stream(spark, sf_dir, files=2)
    for _ in range(2):
        land_stream(
            messages, read_events, TableSink(dataset, "events"), scratch(spark, "w7check"), available_now=True
        ).awaitTermination()
    return landed_copies(spark, dataset, "events")


@query(
    "w7_unknown_columns",
    f"""
    SELECT method, id, side, 1 AS copies, columns
    FROM ({EVENT_SIDES}), (VALUES ('STORAGE_WRITE_API', 'id'), ('STREAMING_INSERTS', 'click,id,seen,type')) AS v(method, columns)
    """,
)
def w7_unknown_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The storage methods leave out what a table does not have, the others add it."""
    dataset = new_dataset(spark, "w7unknown")
    messages = message_stream(spark, sf_dir, files=2)
    found = []
    for method in (EXACTLY_ONCE, STREAMING_INSERTS):
        sink = TableSink(dataset, method.lower())
        land_tables(from_frame(spark.createDataFrame([], "id string")), sink)
        land_stream(
            messages, read_events, sink, scratch(spark, "w7check"), method=method, available_now=True
        ).awaitTermination()
        columns = F.lit(",".join(sorted(spark.table(f"{dataset}.{method.lower()}").columns)))
        found.append(
            landed_copies(spark, dataset, method.lower()).select(
                F.lit(method).alias("method"), "id", "side", "copies", columns.alias("columns")
            )
        )
    return found[0].unionByName(found[1])


@query(
    "w8_stream_retry",
    f"""
    SELECT method, id, side, n AS copies
    FROM ({EVENT_SIDES}),
         (VALUES ('STREAMING_INSERTS', 2), ('STORAGE_API_AT_LEAST_ONCE', 2), ('STORAGE_WRITE_API', 1)) AS v(method, n)
    """,
)
def w8_stream_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A micro-batch replayed from its checkpoint comes again with the at-least-once methods, and once with the other."""
    dataset = new_dataset(spark, "w8")
    messages = message_stream(spark, sf_dir, per_batch=1000)
    found = []
    for method in (STREAMING_INSERTS, AT_LEAST_ONCE, EXACTLY_ONCE):
        checkpoint = scratch(spark, "w8check")
        for attempt in range(2):
            if attempt:
                forget_last_batch(spark, checkpoint)
            land_stream(
                messages, read_events, TableSink(dataset, method.lower()), checkpoint, method=method, available_now=True
            ).awaitTermination()
        copies = landed_copies(spark, dataset, method.lower())
        found.append(copies.select(F.lit(method).alias("method"), "id", "side", "copies"))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    "w1_two_routes",
    """
    SELECT CASE o_orderkey % 5 WHEN 3 THEN 'orders_error' ELSE 'orders' END AS landed_in,
           o_orderkey::VARCHAR AS id, 1 AS copies
    FROM orders
    UNION ALL SELECT 'orders_error', '!' || o_orderkey, 1 FROM orders WHERE o_orderkey % 5 = 4
    """,
)
def w1_two_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a table, with the default's name, in two spellings, and rows routed to the error table;
    landed under one id and tried again."""
    key = F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % 5
    target = F.when(kind == 1, F.lit("orders")).when(kind == 2, F.lit("ORDERS")).when(kind == 3, F.lit("orders_error"))
    orders = table(spark, sf_dir, "orders")
    good = with_hidden(orders.select(key.alias("id"), target.alias(TABLE)))
    bad = with_hidden(
        orders.where(kind == 4).select(
            F.lit("no order").alias("errorMessage"), F.concat(F.lit("!"), key).alias("rawData"), F.lit(None).cast("string").alias(TABLE)
        )
    )
    dataset = new_dataset(spark, "w1routes")
    for _ in range(2):
        land_tables(Batch(good, bad, routed=True), TableSink(dataset, "orders"), "stream-0")
    found = [
        spark.table(f"{dataset}.{name}").select(F.lit(name).alias("landed_in"), value.alias("id"))
        for name, value in (("orders", F.col("id")), ("orders_error", F.coalesce("id", "rawData")))
    ]
    landed = found[0].unionByName(found[1])
    return landed.groupBy("landed_in", "id").agg(F.count(F.lit(1)).cast("int").alias("copies"))


# --- whole jobs -----------------------------------------------------------------------


@query(
    "p1_steps",
    """
    SELECT event_id::VARCHAR AS event, event_type AS type,
           CASE WHEN event_type = 'click' THEN value::VARCHAR END AS click,
           CASE WHEN event_type = 'view' THEN user_id::VARCHAR END AS seen_1,
           'true' AS named
    FROM events WHERE event_type <> 'error'
    UNION ALL
    SELECT NULL, '{"ID": ' || event_id, NULL, NULL, 'true' FROM events WHERE event_type = 'error'
    """,
)
def p1_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job as a list of steps, from files to tables chosen by file name."""
    folder = text_files(spark, event_documents(spark, sf_dir).select("value"), "p1")
    dataset = new_dataset(spark, "p1")
    steps = [
        {
            "type": "ReadJSON",
            "dynamicDestinationConfig": {
                "filenameParserRegex": r"(part)-.*\.txt",
                "patternMatchIndex": 1,
                "tablePrefix": "events_",
            },
        },
        {"type": "Flatten"},
        {
            "type": "InjectMetadata",
            "fieldsToRename": [{"fromField": "id", "toField": "event"}],
        },
        {"type": "WriteBigQuery", "bqLandDataset": dataset},
    ]
    run_steps(spark, steps, JobOptions(input_file_pattern=f"{folder}/part-*~{folder}/none*"))
    named = F.col("meta_file_name").rlike(r"^part-.*\.txt$").cast("string").alias("named")
    good = spark.table(f"{dataset}.events_part")
    bad = spark.table(f"{dataset}.events_part_error")
    none = F.lit(None).cast("string")
    return good.select("event", "type", "click", "seen_1", named).unionByName(
        bad.select(
            none.alias("event"), F.col("rawData").alias("type"), none.alias("click"),
            none.alias("seen_1"), named,
        )
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken and nested JSON lines to typed, flattened rows with metadata in a table."""
    folder = text_files(spark, event_documents(spark, sf_dir).select("value"), "flagship")
    dataset = new_dataset(spark, "flagship")
    batch = read_json_lines(spark, [folder], destination=Destination(pattern=r"(part)-", group=1))
    land_tables(inject_metadata(flatten(batch)), TableSink(dataset))
    return spark.table(f"{dataset}.part")
