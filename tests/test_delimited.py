import gzip

import pytest
from landing_helpers import tuples

from quayside.batch import LandingError
from quayside.functions.names import Destination
from quayside.sources.delimited import read_delimited
from quayside.sources.dialects import dialect, records
from quayside.sources.files import existing, file_patterns
from quayside.sources.tables import read_staged

HEADED = "Plant,Bed No,Height\nleek,north,\nkale,south,31\nchard,,7"
BARE = HEADED.partition("\n")[2]
ROWS = [("chard", None, "7"), ("kale", "south", "31"), ("leek", "north", None)]


@pytest.fixture(params=["spark", "tasks"])
def path_taken(request, monkeypatch):
    """Run a test on Spark's CSV source and on the record splitter."""
    if request.param == "tasks":
        from quayside.sources.dialects import Dialect

        monkeypatch.setattr(Dialect, "spark_reads_it", property(lambda self: False))
    return request.param


def test_header_from_file(spark, write, path_taken):
    batch = read_delimited(spark, [write("in/a.csv", HEADED)], has_header=True)
    assert batch.columns == ["plant", "bedno", "height"]
    assert tuples(batch.rows()) == ROWS
    assert batch.rejects().columns == ["errorMessage", "rawData"]
    assert batch.bad.count() == 0
    assert [r[0] for r in batch.good.select("_meta.meta_file_name").distinct().collect()] == ["a.csv"]


@pytest.mark.parametrize(("replacement", "prefix"), [("_", "column_"), ("", "column")])
def test_generic_header(spark, write, path_taken, replacement, prefix):
    batch = read_delimited(spark, [write("a.csv", BARE)], replacement=replacement)
    assert batch.columns == [f"{prefix}{i}" for i in (1, 2, 3)]
    assert tuples(batch.rows()) == ROWS


def test_generic_header_counts_columns_not_rows(spark, write, path_taken):
    path = write("a.csv", "1,a\n2,b\n3,c\n4,d\n5,e\n")
    batch = read_delimited(spark, [path], replacement="_")
    assert batch.columns == ["column_1", "column_2"]
    assert batch.rows().count() == 5


def test_header_by_pattern(spark, write, path_taken):
    path = write("beds-2021.csv", BARE)
    rules = [("frames-.*", ["X"]), ("BEDS-[0-9]+.csv", ["Plant", "Bed No", "Height"])]
    batch = read_delimited(spark, [path], header=rules, replacement="_")
    assert batch.columns == ["plant", "bed_no", "height"]
    assert tuples(batch.rows()) == ROWS
    # A pattern has to match the whole name; without a match the header is generic.
    batch = read_delimited(spark, [path], header=[("beds", ["X"])], replacement="_")
    assert batch.columns == ["column_1", "column_2", "column_3"]


def test_header_rule_beats_the_header_in_the_file(spark, write, path_taken):
    batch = read_delimited(
        spark, [write("a.csv", HEADED)], has_header=True, header=[(".*", ["A", "B", "C"])]
    )
    assert batch.columns == ["a", "b", "c"]
    assert tuples(batch.rows()) == ROWS


def test_dynamic_destination(spark, write, path_taken):
    destination = Destination(r"(plot-)(.*)\.csv", 2, "garden_", "_raw")
    path = write("plot-west.csv", HEADED + "\nonly one")
    batch = read_delimited(spark, [path], has_header=True, destination=destination)
    assert {r[0] for r in batch.good.select("_table").collect()} == {"garden_west_raw"}
    assert {r[0] for r in batch.bad.select("_table").collect()} == {"garden_west_raw_error"}
    assert batch.layout == {"garden_west_raw": ["plant", "bedno", "height"]}


def test_files_with_different_headers(spark, write, path_taken):
    paths = [write("a.csv", "A,B\n1,2\n"), write("b.csv", "C,B\n3,4\n"), write("c.csv", "A,B\n5,6\n")]
    batch = read_delimited(spark, paths, has_header=True, destination=Destination(r"^(.)", 1))
    assert tuples(batch.rows()) == sorted([("1", "2", None), (None, "4", "3"), ("5", "6", None)], key=repr)
    assert batch.layout == {"a": ["a", "b"], "b": ["c", "b"], "c": ["a", "b"]}


def test_width_mismatch_is_rejected_with_its_text(spark, write, path_taken):
    path = write("a.csv", 'A,B\n1,2\n1,"x,\ny",3\n4\n   \n5,6\n')
    batch = read_delimited(spark, [path], has_header=True)
    assert tuples(batch.rows()) == [("1", "2"), ("5", "6")]
    assert tuples(batch.bad.select("rawData")) == [("   ",), ('1,"x,\ny",3',), ("4",)]


def test_extra_columns_allowed(spark, write, path_taken):
    path = write("a.csv", "A,,C\n1,2,3,4\n5\n")
    batch = read_delimited(spark, [path], has_header=True, allow_extra_columns=True)
    assert batch.columns == ["a", "column2", "c"]
    assert tuples(batch.rows()) == [("1", "2", "3"), ("5", None, None)]


def test_colliding_header(spark, write):
    with pytest.raises(LandingError, match="ab"):
        read_delimited(spark, [write("a.csv", "A-B,a b\n1,2\n")], has_header=True)


def test_quotes_line_feeds_and_nulls(spark, write, path_taken):
    path = write("a.csv", 'A,B\n"x ""y""","1\n2"\n"",z\n,\n')
    batch = read_delimited(spark, [path], has_header=True)
    assert tuples(batch.rows()) == sorted([('x "y"', "1\n2"), (None, "z"), (None, None)], key=repr)


@pytest.mark.parametrize(
    ("settings", "text", "expected"),
    [
        ({"null_string": "NA"}, "NA,\n", [(None, "")]),
        ({"null_string": None}, "NA,\n", [("NA", "")]),
        ({"delimiter": "||"}, "a||b|c\n", [("a", "b|c")]),
        ({"quote": "'", "comment": "#"}, "#x\n'a,b',c\n", [("a,b", "c")]),
        ({"quote": "", "escape": "", "comment": ""}, '"a,b"\n', [('"a', 'b"')]),
        ({"ignore_surrounding_spaces": True}, '  a , " b " \n', [("a", " b ")]),
        ({"escape": "\\"}, "a\\,b,c\\nd\n", [("a,b", "c\nd")]),
        ({"escape": "\\"}, '"a\\"b",c\\xd\n', [('a"b', "c\\xd")]),
        ({"preset": "TDF"}, "a \tb\n\t\n", [("a ", "b"), (None, None)]),
        ({"preset": "MYSQL"}, "a\\tb\t\\N\nc\\\nd\te\n", [("a\tb", "\\N"), ("c\nd", "e")]),
        ({"preset": "POSTGRES_CSV"}, '"",\n', [("", None)]),
        ({"preset": "POSTGRES_TEXT"}, '"a\\"b""c"\t""\n', [('a"b"c', "")]),
        ({"preset": "EXCEL"}, '"a\r\nb",c\r\n', [("a\r\nb", "c")]),
    ],
)
def test_dialects(spark, write, settings, text, expected):
    d = dialect(settings.pop("preset", "DEFAULT"), **settings)
    batch = read_delimited(spark, [write("a.txt", text)], format=d, header=[(".*", ["A", "B"])])
    assert tuples(batch.rows()) == sorted(expected, key=repr)
    assert batch.bad.count() == 0
    # The splitter gives the same cells as Spark's source.
    split = [tuple(cells) for cells, _ in records(text.splitlines(keepends=True), d)]
    assert sorted(split, key=repr) == sorted(expected, key=repr)


def test_blank_lines_count_when_they_are_not_ignored(spark, write):
    d = dialect(ignore_empty_lines=False)
    batch = read_delimited(spark, [write("a.csv", "x\n\ny\n")], format=d)
    assert tuples(batch.rows()) == sorted([("x",), (None,), ("y",)], key=repr)


def test_line_ends(spark, write, path_taken):
    texts = {
        "lf.csv": b'A,B\n1,"x\r\ny"\n2,z\n',
        "crlf.csv": b'A,B\r\n1,"x\r\ny"\r\n2,"u\nv"\r\n\r\n3,z',
        "cr.csv": b"A,B\r1,2\r3,4\r",
        "mixed.csv": b'A,B\n1,2\r\n3,"4"\r\n5,6\n',
    }
    expected = {
        "lf.csv": [("1", "x\r\ny"), ("2", "z")],
        "crlf.csv": [("1", "x\r\ny"), ("2", "u\nv"), ("3", "z")],
        "cr.csv": [("1", "2"), ("3", "4")],
        "mixed.csv": [("1", "2"), ("3", "4"), ("5", "6")],
    }
    for name, text in texts.items():
        batch = read_delimited(spark, [write(name, text)], has_header=True)
        assert tuples(batch.rows()) == expected[name], name


def test_unknown_preset():
    with pytest.raises(LandingError, match="NOPE"):
        dialect("NOPE")


@pytest.mark.parametrize("preset", ["DEFAULT", "TDF", "MYSQL", "POSTGRES_TEXT"])
@pytest.mark.parametrize("open_cell", [False, True])
def test_big_files_are_cut_only_where_no_cell_is(spark, write, preset, open_cell, monkeypatch):
    """Every record arrives once, whatever the size of a range."""
    d = dialect(preset)
    body = "".join(f"{i}{d.sep}{'v' * (i % 37)}\n" for i in range(2000))
    if open_cell:
        cell = f"a{d.escape}\nb" if preset == "MYSQL" else '"a\nb"'
        body += f"2000{d.sep}{cell}\n"
    path = write("big.txt", f"ID{d.sep}V\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    try:
        rows = read_delimited(spark, [path], format=d, has_header=True).rows().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = {(str(i), "v" * (i % 37) or None) for i in range(2000)}
    if open_cell:
        expected.add(("2000", "a\nb"))
    assert len(rows) == len(expected)
    assert {tuple(r) for r in rows} == expected


def test_generic_width_over_ranges(spark, write):
    path = write("big.txt", "".join(f"{i}\tx\n" for i in range(1000)) + "1000\ty\tz\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    try:
        for preset in ("TDF", "MYSQL"):
            batch = read_delimited(
                spark, [path], format=dialect(preset), allow_extra_columns=True, replacement="_"
            )
            assert batch.columns == ["column_1", "column_2", "column_3"]
            assert batch.rows().count() == 1001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_gzip_and_odd_file_names(spark, write, path_taken):
    write("in/a b+%41é.csv", HEADED)
    write("in/b.csv.gz", gzip.compress(HEADED.encode()))
    folder = write("in/c.csv", HEADED).rsplit("/", 1)[0]
    batch = read_delimited(spark, [folder + "/*"], has_header=True)
    assert batch.rows().count() == 9
    names = {r[0] for r in batch.good.select("_meta.meta_file_name").collect()}
    assert names == {"a b+%41é.csv", "b.csv.gz", "c.csv"}


def test_patterns(spark, write):
    a, b = write("x/a.csv", HEADED), write("x/b.csv", HEADED)
    folder = a.rsplit("/", 1)[0]
    assert file_patterns(spark, "a~b") == ["a", "b"]
    listed = write("list.txt", f"{a}~{b}\n")
    assert file_patterns(spark, "ignored", listed) == [a, b]
    assert existing(spark, [a, folder + "/none*"]) == [a]
    with pytest.raises(FileNotFoundError):
        existing(spark, [folder + "/none.csv"])
    with pytest.raises(LandingError):
        file_patterns(spark, None)


def test_no_files_at_all(spark, tmp_path):
    batch = read_delimited(spark, [f"{tmp_path}/none*"], has_header=True)
    assert batch.good.count() == 0 and batch.bad.count() == 0


def test_staged(spark, write):
    batch = read_staged(spark, [write("s.csv", "1,2,3\n4,5,6\n")], replacement="_")
    assert batch.columns == ["field_1", "field_2", "field_3"]
    assert tuples(batch.rows()) == [("1", "2", "3"), ("4", "5", "6")]


def test_line_ends_do_not_depend_on_the_size(spark, write):
    lines = [f"{i},x{i}" + ("\n" if i % 400 == 7 else "\r\n") for i in range(1000)]
    path = write("mixed.csv", "K,V\r\n" + "".join(lines))
    found = []
    for size in ("128m", "2k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        try:
            batch = read_delimited(spark, [path], has_header=True)
            found.append((sorted(map(tuple, batch.rows().collect())), batch.bad.count()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found[0] == found[1] and len(found[0][0]) == 1000 and found[0][1] == 0


def in_small_ranges(spark, size="64"):
    """Files are cut in ranges of a few bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.fixture
def small_ranges(spark):
    yield lambda size="64": in_small_ranges(spark, size)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_line_ends_within_cells_do_not_depend_on_the_size(spark, write, small_ranges):
    records_ = [f'{i},"a{i}\r\n""b"",\n\n{"x" * (i % 90)}"' if i % 3 else f"{i},plain" for i in range(200)]
    path = write("cells.csv", "\n".join(["K,V", *records_, "1,2,3", '7,"tail', ""]))
    want = sorted((str(i), f'a{i}\r\n"b",\n\n{"x" * (i % 90)}' if i % 3 else "plain") for i in range(200))
    for size in ("64", "128m"):
        small_ranges(size)
        batch = read_delimited(spark, [path], has_header=True)
        got = sorted(map(tuple, batch.rows().collect()))
        # the quote that is never closed takes what is left of the file
        assert got == sorted([*want, ("7", "tail")])
        assert tuples(batch.bad.select("rawData")) == [("1,2,3",)]


def test_more_than_one_task_parses_a_file_with_line_ends_in_cells(spark, write, small_ranges):
    from quayside.sources.lines import lines_together

    path = write("cells.csv", "".join(f'{i},"a\nb"\n' for i in range(300)))
    small_ranges("512")
    records_ = lines_together(spark, [path], dialect())
    assert records_.count() == 300
    plan = records_._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Python" not in plan
    assert spark.read.text(path).rdd.getNumPartitions() > 3


def test_small_ranges_are_no_tasks_of_their_own(spark, write, small_ranges):
    """The 166 ranges of a file are read by few tasks, in each of the passes over it."""
    path = write("cells.csv", "".join(f'{i},"a\nb"\n' if i % 2 else f"{i},c\n" for i in range(1300)))
    small_ranges("64")
    assert spark.read.text(path).rdd.getNumPartitions() > 150
    spark.sparkContext.setJobGroup("ranges", "")
    try:
        rows = read_delimited(spark, [path], header=[(".*", ["K", "V"])]).rows().collect()
        tracker = spark.sparkContext.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("ranges") for s in tracker.getJobInfo(j).stageIds]
        most = max(info.numTasks for info in map(tracker.getStageInfo, stages) if info)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert most <= 20
    assert sorted(map(tuple, rows)) == sorted((str(i), "a\nb" if i % 2 else "c") for i in range(1300))


def test_a_file_does_not_depend_on_its_namesakes(spark, write):
    mixed = "1,a\r\n2,b\n3,c\r4,d\n"
    one, other = write("a/f.csv", mixed), write("b/f.csv", '1,"a\nb"'.ljust(len(mixed), "x"))
    alone = tuples(read_delimited(spark, [one], header=[(".*", ["K", "V"])]).rows())
    both = tuples(read_delimited(spark, [one, other], header=[(".*", ["K", "V"])]).rows())
    assert alone == [("1", "a"), ("2", "b"), ("3", "c"), ("4", "d")]
    assert [r for r in both if "\n" not in r[1]] == alone and len(both) == 5


@pytest.mark.parametrize("name", ["csv", "mysql", "postgres", "odd", "blank"])
def test_records_are_those_of_a_reader_from_front_to_back(spark, tmp_path, small_ranges, name):
    """Random texts of the characters that matter, cut in ranges of eleven bytes."""
    import io
    import random

    from pyspark.sql import functions as F

    from quayside.sources.dialects import text_lines
    from quayside.sources.lines import Grammar, lines_together

    d, alphabet = {
        "csv": (dialect(), 'a,"\n\r x'),
        "mysql": (dialect("MYSQL"), 'a\t\\\nnx"'),
        "postgres": (dialect("POSTGRES_TEXT"), 'a\t\\\n"n x'),
        "odd": (dialect(delimiter="||", quote="'", comment="#"), "|a'\n# \r"),
        "blank": (dialect(ignore_empty_lines=False), 'a,"\n'),
    }[name]
    rng, want = random.Random(7), {}
    for i in range(40):
        text = "".join(rng.choices(alphabet, k=rng.randint(1, 80))) + "x"
        (tmp_path / f"f{i:02}.csv").write_text(text, newline="")
        want[f"f{i:02}.csv"] = [list(cells) for cells, _ in records(text_lines(io.BytesIO(text.encode())), d)]
    small_ranges("11")
    split = lines_together(spark, [str(tmp_path)], d).withColumn("cells", Grammar(d).cells(F.col("record")))
    got: dict = {}
    for row in split.orderBy("file_name", "number").collect():
        got.setdefault(row.file_name, []).append(list(row.cells))
    assert got == {name: rows for name, rows in want.items() if rows}


def test_escape_dialects_stay_in_the_jvm(spark, write):
    path = write("a.tsv", "a\\tb\t\\N\nc\t\\\\d\n")
    batch = read_delimited(spark, [path], format=dialect("MYSQL"), header=[(".*", ["A", "B"])])
    plan = batch.good._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Python" not in plan
    assert tuples(batch.rows()) == [("a\tb", "\\N"), ("c", "\\d")]


def test_oddly_named_files_do_not_change_how_others_are_read(spark, write):
    write("d/_a.csv", "1,x\n")
    write("d/b.csv", '2,"y\nz"\n3,w\n')
    path = write("d/c.csv", "4,v\n")
    batch = read_delimited(spark, [path.replace("c.csv", "*.csv")], header=[(".*", ["K", "V"])])
    assert tuples(batch.rows()) == [("1", "x"), ("2", "y\nz"), ("3", "w"), ("4", "v")]
    plan = batch.good._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" in plan and "FileScan text" in plan
