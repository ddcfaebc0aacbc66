from datetime import UTC, datetime

import pytest
from landing_helpers import tuples
from pyspark.sql import functions as F

from quayside.batch import Batch, LandingError, from_frame
from quayside.operators.flatten import flatten
from quayside.operators.latest import latest
from quayside.operators.metadata import (
    constant_metadata,
    file_name_metadata,
    inject_metadata,
    read_lookup,
    rename_columns,
    token_metadata,
)
from quayside.operators.standardise import standardise
from quayside.sources.databases import bounds_query, clean_columns, connect_options, range_options
from quayside.sources.delimited import read_delimited
from quayside.sources.json_lines import read_documents
from quayside.sources.tables import read_table

CSV = "Tide,Harbour,Depth\nebb,Cork,4\nflow,Lima,11\nneap,,9\nshort\n"
LOADED = datetime(2023, 1, 2, 12, 5, tzinfo=UTC)


def csv_batch(spark, write, name="tides-orion_20240229_777.csv") -> Batch:
    return read_delimited(spark, [write(name, CSV)], has_header=True)


# --- metadata -------------------------------------------------------------------------


def test_file_name_metadata(spark, write):
    lookup = read_lookup(spark, write("lookup.json", '{"777": "Coast", "2": null, "3": 4}'))
    batch = inject_metadata(
        file_name_metadata(csv_batch(spark, write), lookup), load_timestamp=LOADED
    )
    assert batch.columns == [
        "meta_file_name", "meta_filedate", "meta_load_timestamp", "meta_ministry", "meta_ministryid",
        "tide", "harbour", "depth",
    ]
    assert batch.layout == {None: batch.columns}
    row = batch.rows().orderBy("tide").first()
    assert tuple(row)[:5] == (
        "tides-orion_20240229_777.csv", "20240229", LOADED.replace(tzinfo=None),
        "Coast", "777",
    )
    bad = batch.rejects().first().asDict()
    assert bad["meta_ministry"] == "Coast" and bad["rawData"] == "short"


def test_file_name_without_metadata(spark, write):
    lookup = read_lookup(spark, write("lookup.json", '{"777": "Coast"}'))
    batch = csv_batch(spark, write, "tides-orion.csv")
    row = inject_metadata(file_name_metadata(batch, lookup)).rows().first()
    assert (row["meta_filedate"], row["meta_ministry"], row["meta_ministryid"]) == (None, None, None)


@pytest.mark.parametrize("text", ['{"12345": ', "[1]", ""])
def test_broken_lookup(spark, write, text):
    with pytest.raises(LandingError):
        read_lookup(spark, write("lookup.json", text))


def test_rename(spark, write):
    batch = inject_metadata(csv_batch(spark, write), rename={"tide": "PHASE", "x": "y"})
    assert batch.columns[2:] == ["PHASE", "harbour", "depth"]
    assert rename_columns(batch, {"harbour": "F 2"}).layout[None][-2:] == ["F 2", "depth"]
    with pytest.raises(LandingError, match="depth"):
        inject_metadata(csv_batch(spark, write), rename={"tide": "depth"})
    with pytest.raises(LandingError, match="meta_file_name"):
        inject_metadata(inject_metadata(csv_batch(spark, write)))


def test_given_metadata(spark, write):
    batch = constant_metadata(csv_batch(spark, write, "a_b_c.csv"), "meta_source", "s")
    batch = inject_metadata(token_metadata(batch, "meta_second", 2))
    row = batch.rows().first()
    assert (row["meta_source"], row["meta_second"]) == ("s", "b")


# --- flatten --------------------------------------------------------------------------


def documents(spark, *lines):
    return read_documents(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_flatten_nested(spark):
    batch = flatten(
        documents(
            spark,
            '{"id":1,"m":{"l":[{"x":1},{"y":2}],"e":[]},"a":[[1,2],[3]],"empty":[],"gone":{}}',
            '{"id":2,"m":{"k":[{"x":5}]},"a":[[],[9,8,7]]}',
            '{"id":3,"m":null}',
        )
    )
    rows = {r["id"]: r.asDict() for r in batch.rows().collect()}
    assert set(batch.columns) == {
        "id", "m_l_1_x", "m_l_2_y", "m_k_1_x", "a_1_1", "a_1_2", "a_2_1", "a_2_2", "a_2_3",
    }
    assert rows["1"]["m_l_2_y"] == "2" and rows["1"]["a_2_1"] == "3" and rows["1"]["m_k_1_x"] is None
    assert rows["2"]["m_k_1_x"] == "5" and rows["2"]["a_2_3"] == "7" and rows["2"]["a_1_1"] is None
    assert all(v is None for k, v in rows["3"].items() if k != "id")


def test_flatten_null_container_stays(spark):
    df = spark.sql("SELECT 1 AS id, CAST(NULL AS array<int>) AS a, array(1L, 2L) AS b")
    batch = flatten(from_frame(df))
    assert batch.columns == ["id", "a", "b_1", "b_2"]
    assert tuple(batch.rows().first()) == (1, None, 1, 2)


def test_flatten_layout_and_limits(spark):
    df = spark.sql(
        "SELECT 't' AS _table, map('x', 1) AS m UNION ALL SELECT 'u', map('y', 2) UNION ALL SELECT 'u', map()"
    )
    batch = Batch(from_frame(df).good, from_frame(df).bad, {"t": ["m"], "u": ["m"]}, [], True)
    flat = flatten(batch)
    assert flat.layout == {"t": ["m_x"], "u": ["m_y"]}
    with pytest.raises(LandingError, match="more than 1 "):
        flatten(batch, max_columns=1)
    clash = spark.sql("SELECT 1 AS m_x, map('x', 1) AS m")
    with pytest.raises(LandingError, match="m_x"):
        flatten(from_frame(clash))


def test_flatten_keeps_column_order(spark):
    batch = flatten(documents(spark, '{"z":[1],"m":{"b":1,"a":2},"c":3}', '{"z":[],"m":{"a":1}}'))
    assert batch.columns == ["z_1", "m_a", "m_b", "c"]
    assert flatten(documents(spark, '{"a":1}')).columns == ["a"]


# --- the rest -------------------------------------------------------------------------


def test_standardise(spark):
    df = spark.createDataFrame(
        [(" 1 ", "2023-01-02", "x"), ("", None, " "), ("n", "2023-01-02", "y")], "n string, d string, s string"
    )
    batch = standardise(from_frame(df), {"n": "int", "d": "date"})
    assert tuples(batch.rows().select("n", F.col("d").cast("string"), "s")) == sorted(
        [(1, "2023-01-02", "x"), (None, None, None)], key=repr
    )
    bad = batch.bad.first()
    assert bad["errorMessage"] == "cannot cast n"
    assert bad["rawData"] == '{"n":"n","d":"2023-01-02","s":"y"}'


def test_standardise_after_metadata_keeps_both_kinds_of_rejects(spark, write):
    batch = standardise(inject_metadata(csv_batch(spark, write)), {"tide": "int"})
    assert batch.good.count() == 0
    assert batch.bad.count() == 4


def test_latest_with_one_hot_key(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") % 1000).alias("at"),
        "id",
        F.struct("id").alias("payload"),
    )
    found = {r["k"]: r["id"] for r in latest(df, ["k"], ["at", "id"]).collect()}
    expected = {}
    for i in range(5000):
        k = 7 if i % 3 == 0 else i % 50
        expected[k] = max(expected.get(k, (-1, -1)), (i % 1000, i))
    assert found == {k: v[1] for k, v in expected.items()}


def test_tables_and_queries(spark):
    rows = spark.createDataFrame([("1", 2, 3.0)] * 10, "field_1 string, field_2 int, FIELD_3 double")
    rows.createOrReplaceTempView("ten_rows")
    assert read_table(spark, table="ten_rows").columns == ["field_1", "field_2", "FIELD_3"]
    assert read_table(spark, query="SELECT * FROM ten_rows").good.count() == 10
    with pytest.raises(LandingError):
        read_table(spark, dataset="d", project="p")


def test_jdbc_options(spark):
    assert connect_options("jdbc:x", "D", "u", None, "a=1;b=2=3", 1000) == {
        "url": "jdbc:x", "driver": "D", "user": "u", "a": "1", "b": "2=3", "fetchsize": "1000",
    }
    assert range_options("SELECT * FROM t", "id", 0, 20, 2) == {
        "dbtable": "(SELECT * FROM t) sq", "partitionColumn": "id",
        "lowerBound": "0", "upperBound": "20", "numPartitions": "2",
    }
    assert range_options("q", "id", None, None, 2) == {"dbtable": "(q) sq"}
    assert bounds_query("q", "id") == "SELECT MIN(id) AS lo, MAX(id) AS hi FROM (q) sq"


def test_clean_columns_keep_types(spark):
    df = spark.sql("SELECT 1 AS `ID`, 'x' AS `NAME $`, true AS `BOOLEAN_VALUE`, 5.5F AS `FLOAT_VALUE`")
    cleaned = clean_columns(df, "_")
    assert cleaned.columns == ["id", "name", "boolean_value", "float_value"]
    assert [f.dataType for f in cleaned.schema] == [f.dataType for f in df.schema]
