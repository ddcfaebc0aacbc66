import json

import pytest
from landing_helpers import tuples
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from quayside.batch import LandingError
from quayside.functions.names import Destination, clean_name
from quayside.operators.documents import parse_documents
from quayside.operators.flatten import flatten
from quayside.sources.json_lines import read_documents, read_json_lines
from quayside.sources.messages import read_messages

GOOD = [
    '{"Ship-Name":"Argo","crew":{"mate":{"Name":"Idas","years":4}},"Holds":[[10,2.5],[]],"log":null}',
    '{"Ship-Name":"Beagle","crew":{"cook":{"Name":"Syms"}},"Holds":[[7]],"afloat":true}',
]
BROKEN = '{"Ship-Name":"Cutty Sark","crew":{"mate":'


def documents(spark, lines, **settings):
    return read_documents(spark.createDataFrame([(x,) for x in lines], "value string"), **settings)


def test_json_lines(spark, write):
    # The broken line comes second: the good one after it stays good.
    path = write("ships-2024.json", "\n".join([GOOD[0], BROKEN, "", GOOD[1]]))
    destination = Destination(r"(.*)\.json", 1, "in_", "_raw")
    batch = read_json_lines(spark, [path], replacement="_", destination=destination)
    assert {f.name: f.dataType.simpleString() for f in batch.rows().schema} == {
        "ship_name": "string",
        "crew": "map<string,map<string,string>>",
        "holds": "array<array<string>>",
        "log": "string",
        "afloat": "string",
    }
    argo, beagle = batch.good.orderBy("ship_name").collect()
    assert argo["crew"] == {"mate": {"name": "Idas", "years": "4"}} and argo["holds"] == [["10", "2.5"], []]
    assert (argo["log"], argo["afloat"], beagle["afloat"]) == (None, None, "true")
    assert argo["_table"] == beagle["_table"] == "in_ships_2024_raw"
    assert argo["_meta"]["meta_file_name"] == "ships-2024.json"
    (bad,) = batch.bad.collect()
    assert bad["rawData"] == BROKEN and bad["errorMessage"]
    assert bad["_table"] == "in_ships_2024_raw_error"
    assert batch.bad_tables == ["in_ships_2024_raw_error"]


def test_flattened_ships(spark):
    flat = flatten(documents(spark, GOOD, replacement="_"))
    assert set(flat.columns) == {
        "ship_name", "crew_mate_name", "crew_mate_years", "crew_cook_name", "holds_1_1", "holds_1_2", "log", "afloat",
    }
    assert flat.layout == {None: flat.columns}


def test_columns_are_counted_once_for_all_destinations(spark):
    rows = [(json.dumps({"m": {f"k{i}": 1 for i in range(6)}}), f"t{t}") for t in range(30)]
    df = spark.createDataFrame(rows, "value string, _table string")
    batch = parse_documents(df.selectExpr("*", "struct('f' AS f) AS _meta"), routed=True)
    assert len(flatten(batch, max_columns=6).columns) == 6
    with pytest.raises(LandingError, match="more than 5"):
        flatten(batch, max_columns=5)


def test_of_repeated_nested_keys_the_last_value_stays(spark):
    batch = documents(spark, ['{"a":{"x":1,"x":2},"b":1}', '{"b":2}', '{"c":[{"y":1,"y":"z"}]}'])
    rows = sorted(tuples(batch.rows()), key=repr)
    assert batch.columns == ["a", "c", "b"] or set(batch.columns) == {"a", "b", "c"}
    got = {tuple(sorted((k, str(v)) for k, v in r.asDict().items() if v is not None)) for r in batch.rows().collect()}
    assert got == {(("a", "{'x': '2'}"), ("b", "1")), (("b", "2"),), (("c", "[{'y': 'z'}]"),)}
    assert batch.bad.count() == 0 and len(rows) == 3


@given(st.lists(st.recursive(
    st.integers() | st.text("ab"),
    lambda inner: st.lists(st.tuples(st.text("ab", min_size=1, max_size=1), inner), max_size=3),
    max_leaves=6,
), min_size=1, max_size=3))
@settings(max_examples=8, deadline=None)
def test_every_key_the_parse_takes_is_discovered(spark, values):
    def text(value) -> str:
        if isinstance(value, list):
            return "{" + ",".join(f'"{k}":{text(v)}' for k, v in value) + "}"
        return json.dumps(value)

    batch = documents(spark, [f'{{"k{i}":{text(v)}}}' for i, v in enumerate(values)])
    assert set(batch.columns) == {f"k{i}" for i in range(len(values))}
    assert batch.good.count() == len(values)


def test_a_key_like_the_hidden_column(spark):
    assert tuples(documents(spark, ['{"_CORRUPT":1,"_corrupt_":2}']).rows().select("corrupt")) in ([("1",)], [("2",)])


def test_roots_that_are_not_objects_are_rejected(spark):
    batch = documents(spark, ['{"a":1}', "", "  ", "\t", "[1]", "5", '"x"', "null", "{'a':1}", "{a:1}"])
    assert tuples(batch.rows()) == [("1",)]
    assert tuples(batch.bad.select("rawData")) == sorted(
        [("[1]",), ("5",), ('"x"',), ("null",), ("{'a':1}",), ("{a:1}",)], key=repr
    )


def test_no_rejects_are_known_without_another_look(spark):
    assert documents(spark, GOOD).bad_tables == []


def test_leaves_are_text(spark):
    batch = documents(spark, ['{"a":1,"b":2.50,"c":1e5,"d":true,"e":null,"f":"00501","g":123456789012345678901}'])
    assert tuple(batch.rows().first()) == (
        "1", "2.5", "100000.0", "true", None, "00501", "123456789012345678901",
    )


def test_json_null_as_text(spark):
    lines = ['{"a":null,"m":{"x":null,"y":"1"},"l":[null,"2"]}', '{"b":1}']
    rows = documents(spark, lines, json_null="text").rows().collect()
    assert rows[0].asDict() == {
        "a": "null", "m": {"x": "null", "y": "1"}, "l": ["null", "2"], "b": None,
    }
    assert rows[1].asDict() == {"a": None, "m": None, "l": None, "b": "1"}


def test_kinds_that_differ_meet_as_text(spark):
    batch = documents(spark, ['{"a":"x","m":{"k":1},"l":[1,{"z":[2]}]}', '{"a":{"b":[1]},"m":{"k":[1]}}'])
    rows = batch.rows().collect()
    assert [r["a"] for r in rows] == ["x", '{"b":[1]}']
    assert [r["m"] for r in rows] == [{"k": "1"}, {"k": "[1]"}]
    assert rows[0]["l"] == ["1", '{"z":[2]}']


def test_text_that_looks_like_an_object_stays_text(spark):
    batch = documents(spark, ['{"a":"{\\"b\\":1}","c":["[1]"]}'])
    assert tuple(batch.rows().first()) == ('{"b":1}', ["[1]"])


def test_nested_containers(spark):
    batch = documents(spark, ['{"a":{"v":[{"x":"1"},{"y":"2"}]}}', '{"a":{}}', '{"a":null}'])
    assert batch.rows().schema["a"].dataType.simpleString() == "map<string,array<map<string,string>>>"
    assert [r["a"] for r in batch.rows().collect()] == [{"v": [{"x": "1"}, {"y": "2"}]}, {}, None]


def test_the_last_of_colliding_keys_wins(spark):
    batch = documents(
        spark,
        ['{"A-B":1,"a b":2,"m":{"X-Y":1,"xy":2}}', '{"a b":3,"A-B":4}', '{"AB":5,"AB":6}', '{"c":1}'],
    )
    assert [r["ab"] for r in batch.rows().collect()] == ["2", "4", "6", None]
    assert batch.rows().first()["m"] == {"xy": "2"}


def test_keys_with_odd_characters(spark):
    batch = documents(spark, ['{"a.b`c":{"d.e: <x>":[1]},"b€":1,"A":2}'], replacement="_")
    row = batch.rows().first().asDict()
    assert row["a_b_c"] == {"d_e___x": ["1"]} and row["a"] == "2"


def test_keys_without_letters_are_an_error(spark):
    with pytest.raises(ValueError, match="without any letter"):
        documents(spark, ['{"#":1}'])


def test_a_given_schema_skips_discovery(spark):
    schema = T.StructType.fromDDL("a string, m map<string,string>")
    batch = documents(spark, ['{"a":1,"m":{"K-1":2},"other":3}', '{"a":1,"m":[]}', "{"], schema=schema)
    assert tuples(batch.rows()) == [("1", {"k1": "2"})]
    assert tuples(batch.bad.select("rawData")) == [('{"a":1,"m":[]}',), ("{",)]
    assert batch.bad_tables is None


def test_layout_per_destination(spark):
    rows = [('{"a":1,"b":2}', "t1"), ('{"b":1,"c":[2]}', "t2"), ("x", "t2"), ("{}", "t3")]
    df = spark.createDataFrame(
        [(v, t, (t,)) for v, t in rows], "value string, _table string, _meta struct<f:string>"
    )
    batch = parse_documents(df, routed=True)
    assert batch.layout == {"t1": ["a", "b"], "t2": ["b", "c"], "t3": []}
    assert batch.bad_tables == ["t2_error"]
    assert {r["_table"] for r in batch.bad.collect()} == {"t2_error"}


def test_destinations_may_differ_in_the_type_of_a_column(spark, dataset, tmp_path):
    from quayside.operators.metadata import inject_metadata, rename_columns
    from quayside.operators.stage import stage
    from quayside.sinks.files import FileSink, land_files
    from quayside.sinks.tables import TableSink, land_tables
    from quayside.sources.spark_files import read_files

    rows = [
        ('{"x":{"k":[1,2]},"A":1}', "m"), ('{"x":{"k":[3]}}', "m"), ('{"x":"text"}', "t"),
        ('{"x":{"k":"v"}}', "n"), ('{"x":[1]}', None), ('{"x":[{"y":2.50}]}', "d"), ('{"x":5}', "t"),
    ]
    df = spark.createDataFrame(
        [(v, t, ("f",)) for v, t in rows], "value string, _table string, _meta struct<f:string>"
    )
    batch = parse_documents(df, routed=True)
    land_tables(batch, TableSink(dataset, "rest"))
    landed = {t: spark.table(f"{dataset}.{t}") for t in ("m", "n", "t", "d", "rest")}
    assert {t: df.schema["x"].dataType.simpleString() for t, df in landed.items()} == {
        "m": "map<string,array<string>>", "t": "string", "d": "array<map<string,string>>",
        "rest": "array<string>", "n": "map<string,string>",
    }
    assert tuples(landed["m"]) == sorted([({"k": ["1", "2"]}, "1"), ({"k": ["3"]}, None)], key=repr)
    assert tuples(landed["n"]) == [({"k": "v"},)]
    assert tuples(landed["t"]) == [("5",), ("text",)]
    assert tuples(landed["d"]) == [([{"y": "2.5"}],)]
    assert tuples(landed["rest"]) == [(["1"],)]

    flat = rename_columns(inject_metadata(stage(flatten(batch)), rename={"x": "z"}), {"a": "aa"})
    land_files(flat, FileSink(str(tmp_path), format="parquet"))
    columns = {
        t: set(read_files(spark, [f"{tmp_path}/table={t}/*/*.avro"], "parquet").columns) - {"f", "meta_load_timestamp"}
        for t in ("m", "t", "d", "default")
    }
    assert columns == {"m": {"x_k_1", "x_k_2", "aa"}, "t": {"z"}, "d": {"x_1_y"}, "default": {"x_1"}}


def test_document_export(spark):
    batch = documents(spark, ['{"_id":{"$oid":"5f"},"n":{"$numberLong":"12"}}'])
    assert batch.rows().first().asDict() == {"id": {"oid": "5f"}, "n": {"numberlong": "12"}}


def test_messages(spark):
    lines = [*GOOD, BROKEN]
    df = spark.createDataFrame(
        [(x.encode(), str(i), {"key1": "val1", "key2": "val2"}) for i, x in enumerate(lines)],
        "payload binary, message_id string, attributes map<string,string>",
    )
    batch = read_messages(df)
    assert tuples(batch.good.select("shipname", "_meta.*")) == [
        (n, str(i), "key1=val1,key2=val2") for i, n in enumerate(("Argo", "Beagle"))
    ]
    assert tuples(batch.bad.select("rawData", "_meta.meta_pubsub_message_id")) == [(BROKEN, "2")]


def test_json_paths(spark, write):
    book = {"store": {"book": [{"category": "reference", "price": 8.95}]}, "TITLE.X": "t"}
    path = write("a.json", json.dumps(book) + "\n{broken\n\n{}\n")
    batch = read_json_lines(
        spark,
        [path],
        json_fields={
            "PRICE": "$.store.book[0].price", "CATEGORY": "$.store.book[0].category",
            "TITLE": "TITLE.X", "ATTACHMENT": "",
        },
    )
    assert tuples(batch.rows()) == sorted(
        [("8.95", "reference", "t", None), (None, None, None, None)], key=repr
    )
    assert tuples(batch.bad.select("rawData")) == [("{broken",)]


LEAF = st.one_of(st.none(), st.integers(-9, 9), st.text("ab{[\"", max_size=3), st.booleans())
VALUE = st.recursive(
    LEAF,
    lambda v: st.one_of(st.lists(v, max_size=3), st.dictionaries(st.sampled_from("xyz"), v, max_size=3)),
    max_leaves=6,
)


def expected_type(values):
    kinds = {type(v) if isinstance(v, (list, dict)) else str for v in values if v is not None}
    if kinds == {list}:
        inner = expected_type([x for v in values if v is not None for x in v])
        return f"array<{inner}>"
    if kinds == {dict}:
        inner = expected_type([x for v in values if v is not None for x in v.values()])
        return f"map<string,{inner}>"
    return "string"


@settings(max_examples=12, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from(["K1", "k-2"]), VALUE, max_size=2), min_size=1, max_size=5))
def test_types_against_brute_force(spark, docs):
    batch = documents(spark, [json.dumps(d) for d in docs])
    found = {f.name: f.dataType.simpleString() for f in batch.rows().schema}
    keys = {k for d in docs for k in d}
    assert found == {clean_name(k): expected_type([d.get(k) for d in docs]) for k in keys}
    assert batch.good.count() == len(docs)
