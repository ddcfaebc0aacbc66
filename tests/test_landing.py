import os
import time
from dataclasses import replace
from datetime import UTC, date, datetime
from decimal import Decimal

import pytest
from landing_helpers import tuples
from pyspark.sql import functions as F

from quayside.batch import Batch, LandingError, from_frame, with_hidden
from quayside.operators.flatten import flatten
from quayside.operators.metadata import inject_metadata
from quayside.operators.routing import route
from quayside.plans.steps import JobOptions, run_steps
from quayside.sinks.commits import Folder, location
from quayside.sinks.files import FileSink, land_files
from quayside.sinks.tables import TableSink, fan_out, land_tables
from quayside.sources.spark_files import read_files
from quayside.sources.json_lines import read_documents
from quayside.sources.messages import read_messages
from quayside.streaming.landing import STREAMING_INSERTS, land_stream

SCHEMA_TEST = (
    "id int, name string, boolean_value boolean, float_value float, long_value bigint,"
    " timestamp_value timestamp"
)


def schema_test(spark, rows=20):
    at = datetime(2023, 1, 2, 12, 5)
    data = [(i, f"value_{i}", True, 5.5, i * 800000, at) for i in range(rows)]
    return spark.createDataFrame(data, SCHEMA_TEST)


def documents(spark, *lines):
    return read_documents(spark.createDataFrame([(x,) for x in lines], "value string"))


# --- tables ---------------------------------------------------------------------------


def test_good_rows_and_rejects_land_apart(spark, dataset):
    batch = inject_metadata(documents(spark, '{"a":1,"m":{"x":[1]}}', "{broken", '{"a":2}'))
    land_tables(batch, TableSink(dataset, "t", error_suffix="_err"))
    assert tuples(spark.table(f"{dataset}.t").select("a")) == [("1",), ("2",)]
    landed = spark.table(f"{dataset}.t_err")
    assert landed.columns == ["meta_load_timestamp", "errorMessage", "rawData"]
    assert landed.first()["rawData"] == "{broken"


def test_no_error_table_without_rejects(spark, dataset):
    land_tables(documents(spark, '{"a":1}'), TableSink(dataset, "t"))
    assert not spark.catalog.tableExists(f"{dataset}.t_error")


def test_rows_choose_their_table(spark, dataset):
    df = spark.createDataFrame(
        [(i, ["hot", "b", None][min(i % 5, 2)]) for i in range(100)], "id int, t string"
    )
    batch = route(from_frame(df), F.col("t"))
    land_tables(batch, TableSink(dataset, "rest"))
    counts = {t: spark.table(f"{dataset}.{t}").count() for t in ("hot", "b", "rest")}
    assert counts == {"hot": 20, "b": 20, "rest": 60}
    with pytest.raises(LandingError, match="no table"):
        land_tables(batch, TableSink(dataset))


def test_dispositions(spark, dataset):
    batch = from_frame(schema_test(spark))
    with pytest.raises(LandingError, match="must not be created"):
        land_tables(batch, TableSink(dataset, "t", create="CREATE_NEVER"))
    land_tables(batch, TableSink(dataset, "t", write="WRITE_EMPTY"))
    with pytest.raises(LandingError, match="not empty"):
        land_tables(batch, TableSink(dataset, "t", write="WRITE_EMPTY"))
    land_tables(batch, TableSink(dataset, "t", create="CREATE_NEVER"))
    assert spark.table(f"{dataset}.t").count() == 40
    land_tables(batch, TableSink(dataset, "t", write="WRITE_TRUNCATE"))
    assert spark.table(f"{dataset}.t").count() == 20


def test_schema_evolution(spark, dataset):
    sink = TableSink(dataset, "t")
    for frame in (
        "SELECT 1 AS a, 'x' AS b",
        "SELECT array(1) AS c, 2 AS a",
        "SELECT 3L AS a, array('n') AS b",
    ):
        land_tables(from_frame(spark.sql(frame)), sink)
    rows = spark.table(f"{dataset}.t")
    assert rows.columns == ["a", "b", "c"]
    assert tuples(rows) == sorted([(1, "x", None), (2, None, [1]), (3, '["n"]', None)], key=repr)
    with pytest.raises(LandingError, match="column c"):
        land_tables(from_frame(spark.sql("SELECT 'text' AS c")), sink)
    ignoring = TableSink(dataset, "t", unknown_columns="ignore")
    land_tables(from_frame(spark.sql("SELECT 4 AS a, 5 AS other")), ignoring)
    assert spark.table(f"{dataset}.t").columns == ["a", "b", "c"]
    assert spark.table(f"{dataset}.t").count() == 4


@pytest.mark.parametrize(
    ("unit", "expected"),
    [
        ("DAY", {"2023-01-02", "2023-02-02"}), ("MONTH", {"2023-01-01", "2023-02-01"}),
        ("HOUR", {"2023-01-02-12", "2023-02-02-13"}), ("YEAR", {"2023-01-01"}),
    ],
)
def test_time_partitions(spark, dataset, unit, expected):
    rows = spark.createDataFrame(
        [(1, datetime(2023, 1, 2, 12, 5)), (2, datetime(2023, 2, 2, 13))], "id int, at timestamp"
    )
    sink = TableSink(dataset, "t", partition_by=("at", unit))
    land_tables(from_frame(rows), sink)
    land_tables(from_frame(rows), sink)
    landed = spark.table(f"{dataset}.t")
    stored = f"at_{unit.lower()}"
    assert {str(r[0]) for r in landed.select(stored).collect()} == expected
    assert landed.count() == 4
    plan = landed.filter(F.col(stored) == sorted(expected)[0])._jdf.queryExecution().toString()
    assert f"PartitionFilters: [isnotnull({stored}" in plan


def test_a_replayed_batch_lands_once(spark, dataset):
    sink = TableSink(dataset, "t", partition_by=("timestamp_value", "DAY"))
    batch = from_frame(schema_test(spark, 5))
    for batch_id in ("s-0", "s-1", "s-1", "other-0", "s-2", "s-3", "s-3"):
        land_tables(batch, sink, batch_id)
    landed = spark.table(f"{dataset}.t")
    assert landed.count() == 25 and "_batch_id" not in landed.columns
    place = location(spark, f"{dataset}.t")
    # what can no longer be replayed is forgotten
    kept = Folder(spark, place.rpartition("/")[0]).names("_commits")
    assert sorted((n.partition(".")[0], n.rpartition("-")[2]) for n in kept) == [("other", "0"), ("s", "2"), ("s", "3")]
    assert Folder(spark, place).names("_staging") == []


def routes_to_one_table(spark):
    """Rows without a table, with the default's name, in another spelling, and routed to the error table."""
    names = [None, "t", "T", "t_error", "other"]
    good = spark.createDataFrame([(i, names[i % 5]) for i in range(50)], "n int, _table string")
    bad = spark.createDataFrame([("no", f"r{i}", None) for i in range(7)], "errorMessage string, rawData string, _table string")
    return Batch(with_hidden(good), with_hidden(bad), routed=True)


@pytest.mark.parametrize("batch_id", [None, "s-0"])
def test_routes_that_end_in_one_table_are_one_write(spark, dataset, batch_id):
    for times in (1, 2):
        land_tables(routes_to_one_table(spark), TableSink(dataset, "t"), batch_id)
        landed = 1 if batch_id else times
        assert spark.table(f"{dataset}.t").count() == 30 * landed
        assert spark.table(f"{dataset}.other").count() == 10 * landed
        errors = spark.table(f"{dataset}.t_error")
        assert errors.where("n IS NOT NULL").count() == 10 * landed
        assert errors.where("rawData IS NOT NULL").count() == 7 * landed


def test_columns_of_two_routes_with_different_types_become_text(spark, dataset):
    good = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, 't' AS _table UNION ALL SELECT 2, 'x', NULL")
    batch = replace(from_frame(good), routed=True, layout={None: ["a"], "t": ["b"]}, names={"b": "A"})
    land_tables(batch, TableSink(dataset, "t"))
    assert tuples(spark.table(f"{dataset}.t")) == [("2",), (None,)]


def test_sinks_of_one_batch_do_not_take_each_others_commits(spark, dataset):
    for sink, n in ((TableSink(dataset, "a"), 3), (TableSink(dataset, "b"), 4), (TableSink(dataset, "a"), 3)):
        land_tables(from_frame(spark.range(n)), sink, "s-0")
    assert (spark.table(f"{dataset}.a").count(), spark.table(f"{dataset}.b").count()) == (3, 4)


def test_all_tables_of_a_batch_are_one_commit(spark, dataset, monkeypatch):
    """A try that is lost before the commit leaves nothing in any table."""
    write = Folder.write

    def lost(self, name, text):
        raise OSError("lost")

    monkeypatch.setattr(Folder, "write", lost)
    with pytest.raises(OSError, match="lost"):
        land_tables(routes_to_one_table(spark), TableSink(dataset, "t"), "s-0")
    counts = [spark.table(f"{dataset}.{t}").count() for t in ("t", "other", "t_error")]
    assert counts == [0, 0, 0]
    monkeypatch.setattr(Folder, "write", write)
    land_tables(routes_to_one_table(spark), TableSink(dataset, "t"), "s-0")
    assert [spark.table(f"{dataset}.{t}").count() for t in ("t", "other", "t_error")] == [30, 10, 17]


def test_a_stream_lands_on_a_timed_trigger(spark, dataset, tmp_path):
    """Two batches, each started by the clock, land what has come since the one before."""
    schema = "payload binary, message_id string, attributes map<string,string>"

    def arrive(n):
        rows = [(f'{{"id": {n}}}'.encode(), f"m{n}", {})]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_path}/in")

    arrive(0)
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    running = land_stream(
        stream, read_messages, TableSink(dataset, "t"), f"{tmp_path}/check", trigger="1 second"
    )

    def landed():
        if not spark.catalog.tableExists(f"{dataset}.t"):
            return []
        spark.catalog.refreshTable(f"{dataset}.t")  # the stream writes in a session of its own
        return tuples(spark.table(f"{dataset}.t").select("id"))

    try:
        for n in range(2):
            if n:
                arrive(n)
            for _ in range(120):
                if len(landed()) > n:
                    break
                time.sleep(0.5)
        assert landed() == [("0",), ("1",)]
        assert running.lastProgress["batchId"] >= 1
    finally:
        running.stop()


def test_a_try_that_was_lost_half_way_is_finished(spark, dataset, monkeypatch):
    sink, batch = TableSink(dataset, "t"), from_frame(schema_test(spark, 50).repartition(4))
    move, calls = Folder.move, []

    def lost(self, source, target):
        calls.append(target)
        if len(calls) == 3:
            raise OSError("lost")
        move(self, source, target)

    monkeypatch.setattr(Folder, "move", lost)
    with pytest.raises(OSError, match="lost"):
        land_tables(batch, sink, "s-0")
    monkeypatch.setattr(Folder, "move", move)
    land_tables(batch, sink, "s-0")
    assert spark.table(f"{dataset}.t").count() == 50


def test_no_copy_stays_after_landing(spark, dataset, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    rows = spark.range(100).withColumn("_table", F.when(F.col("id") < 50, "a").otherwise("b"))
    batch = route(from_frame(rows.drop("_table")), F.when(F.col("id") < 50, "a").otherwise("b"))
    land_tables(batch, TableSink(dataset))
    fan_out(batch, [lambda b: land_tables(b, TableSink(dataset)), lambda b: b.rows().count()])
    assert {n for n in os.listdir(shared) if n.startswith(("stage", "parsed"))} <= before
    assert spark.table(f"{dataset}.a").count() == 100


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    from quayside import scratch

    class Cluster:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        sparkContext = Cluster()

        class conf:
            get = staticmethod(lambda *_: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch(Session(), "x")
    Session.sparkContext.master = "local[2]"
    assert scratch.scratch(Session(), "x")


# --- files ----------------------------------------------------------------------------


def test_file_layout_and_types(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    rows = schema_test(spark).selectExpr(
        "*", "CAST(id AS decimal(10,2)) / 4 AS price", "date'2023-01-02' AS day",
        "map('k', array(name, NULL)) AS m", "named_struct('x', id) AS s", "binary(name) AS raw",
        "CAST(id AS smallint) AS small", "IF(id = 3, NULL, -id * 1e300) AS dbl",
    )
    rows = rows.withColumn("price", F.col("price").cast("decimal(12,2)"))
    load = land_files(from_frame(rows), FileSink(root, shards=2, format="parquet"), datetime(2023, 1, 2, tzinfo=UTC))
    folder = tmp_path / "out" / "table=default" / "meta_load_date=2023-01-02"
    assert sorted(f for f in os.listdir(folder) if f[0] != ".") == [f"0-{load}.avro", f"1-{load}.avro"]
    assert not os.listdir(tmp_path / "out" / "_temporary")
    read = read_files(spark, [f"{root}/*/*/*.avro"], "parquet", ("table",)).rows()
    assert read.count() == 20
    row = read.filter("id = 7").first()
    assert row["name"] == "value_7" and row["float_value"] == 5.5 and row["long_value"] == 5600000
    assert row["timestamp_value"] == datetime(2023, 1, 2, 12, 5)
    assert row["price"] == Decimal("1.75") and row["day"] == date(2023, 1, 2)
    assert row["m"] == {"k": ["value_7", None]} and row["s"]["x"] == 7
    assert bytes(row["raw"]) == b"value_7" and row["small"] == 7 and row["dbl"] == -7e300
    assert read.filter("id = 3").first()["dbl"] is None
    assert row["table"] == "default"


def test_files_have_the_columns_of_their_table(spark, tmp_path):
    df = spark.createDataFrame(
        [('{"a":1}', "t1"), ('{"b":[2]}', "t2"), ("{", "t2")], "value string, _table string"
    ).withColumn("_meta", F.struct(F.lit("f").alias("meta_file_name")))
    from quayside.operators.documents import parse_documents

    land_files(parse_documents(df, routed=True), FileSink(str(tmp_path), format="parquet"))
    found = {t: spark.read.parquet(f"{tmp_path}/table={t}/*").columns for t in ("t1", "t2", "t2_error")}
    assert found == {"t1": ["a"], "t2": ["b"], "t2_error": ["errorMessage", "rawData"]}
    with pytest.raises(LandingError, match="cannot write avro"):
        land_files(parse_documents(df, routed=True), FileSink(str(tmp_path / "avro")))


def test_a_failed_file_write_leaves_nothing(spark, tmp_path):
    def fail(batches):
        for batch in batches:
            yield batch
        raise RuntimeError("lost")

    rows = schema_test(spark).mapInArrow(fail, SCHEMA_TEST)
    with pytest.raises(Exception, match="lost"):
        land_files(from_frame(rows), FileSink(str(tmp_path / "out"), format="parquet"))
    left = [f for _, _, files in os.walk(tmp_path / "out") for f in files]
    assert left == []


# --- streams --------------------------------------------------------------------------


def messages(spark, folder, rows):
    df = spark.createDataFrame(
        [(p.encode(), str(i), {"k": "v"}) for i, p in rows],
        "payload binary, message_id string, attributes map<string,string>",
    )
    df.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(df.schema).parquet(folder)


def test_stream_goes_on_from_its_checkpoint_and_grows_the_schema(spark, dataset, tmp_path):
    folder, check = f"{tmp_path}/in", f"{tmp_path}/check"

    def run(stream):
        land_stream(
            stream, read_messages, TableSink(dataset, "t"), check,
            steps=[flatten, inject_metadata], available_now=True, method=STREAMING_INSERTS,
        ).awaitTermination()

    run(messages(spark, folder, [(0, '{"a":1}'), (1, "{broken")]))
    run(messages(spark, folder, [(2, '{"a":2,"m":{"x":3}}')]))
    landed = spark.table(f"{dataset}.t")
    assert tuples(landed.select("a", "m_x", "meta_pubsub_message_id", "meta_pubsub_attributes")) == [
        ("1", None, "0", "k=v"), ("2", "3", "2", "k=v"),
    ]
    assert tuples(spark.table(f"{dataset}.t_error").select("rawData")) == [("{broken",)]


def test_a_failing_batch_stops_the_stream_and_is_retried(spark, dataset, tmp_path):
    stream = messages(spark, f"{tmp_path}/in", [(0, '{"a":1}')])
    calls = []

    def flaky(batch):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("once")
        return batch

    settings = {"checkpoint": f"{tmp_path}/check", "available_now": True, "method": STREAMING_INSERTS}
    sink = TableSink(dataset, "t")
    with pytest.raises(Exception, match="once"):
        land_stream(stream, read_messages, sink, steps=[flaky], **settings).awaitTermination()
    land_stream(stream, read_messages, sink, steps=[flaky], **settings).awaitTermination()
    assert spark.table(f"{dataset}.t").count() == 1


# --- whole jobs -----------------------------------------------------------------------


def test_step_list(spark, dataset, write, tmp_path):
    write("in/orders_1.csv", "ID;NAME\n1;a\n2;b;c\n")
    write("in/orders_2.csv", "ID;AGE\n3;4\n")
    seen = []
    steps = [
        {
            "type": "readcsv", "hasHeader": True, "delimiterChar": ";",
            "dynamicDestinationConfig": {"filenameParserRegex": r"(\w+)_\d", "patternMatchIndex": 1},
        },
        {"type": "InjectMetadata", "fieldsToRename": [{"fromField": "id", "toField": "KEY"}]},
        {"type": "WriteBigQuery", "partitionBy": {"columnName": "meta_load_timestamp", "dataType": "DAY"}},
        {"type": "WriteAvro", "outputRoot": f"{tmp_path}/avro", "numShards": 1, "format": "parquet"},
        {"type": "write", "implementation": lambda df, is_error: seen.append((df.count(), is_error))},
    ]
    options = JobOptions(input_file_pattern=f"{tmp_path}/in/*.csv", land_dataset=dataset)
    run_steps(spark, steps, options)
    landed = spark.table(f"{dataset}.orders")
    assert tuples(landed.select("KEY", "name", "age")) == sorted(
        [("1", "a", None), ("3", None, "4")], key=repr
    )
    assert spark.table(f"{dataset}.orders_error").first()["rawData"] == "2;b;c"
    assert sorted(os.listdir(f"{tmp_path}/avro")) == ["_temporary", "table=orders", "table=orders_error"]
    assert seen == [(2, False), (1, True)]


def test_step_list_on_a_stream(spark, dataset, tmp_path):
    stream = messages(spark, f"{tmp_path}/in", [(0, '{"a":{"b":1}}'), (1, "x")])
    steps = [
        {"type": "ReadPubsub", "source": stream},
        {"type": "Flatten"},
        {"type": "WriteBigQuery", "bqLandDataset": dataset, "bqLandTable": "t"},
    ]
    options = JobOptions(checkpoint=f"{tmp_path}/check", available_now=True)
    run_steps(spark, steps, options).awaitTermination()
    assert tuples(spark.table(f"{dataset}.t").select("a_b")) == [("1",)]
    assert spark.table(f"{dataset}.t_error").count() == 1


def test_step_errors(spark, dataset, tmp_path):
    with pytest.raises(LandingError, match="before any read"):
        run_steps(spark, [{"type": "Flatten"}])
    read = {"type": "ReadBigQuery", "query": "SELECT 1 AS a"}
    with pytest.raises(LandingError, match="unknown step"):
        run_steps(spark, [read, {"type": "Sort"}])
    with pytest.raises(LandingError, match="no dataset"):
        run_steps(spark, [read, {"type": "WriteBigQuery", "bqLandTable": "t"}])
    with pytest.raises(LandingError, match="no table"):
        run_steps(spark, [read, {"type": "WriteBigQuery", "bqLandDataset": dataset}])
