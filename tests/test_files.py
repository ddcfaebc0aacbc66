import io
import json
import os
import tarfile
import zipfile

import pytest
from landing_helpers import tuples
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from quayside.batch import LandingError
from quayside.functions.names import Destination
from quayside.sources.delimited import read_delimited
from quayside.sources.dialects import dialect
from quayside.sources.files import list_files
from quayside.sources.json_lines import read_json_lines
from quayside.sources.units import units
from quayside.sources.xml_files import read_xml, tagged_records, united

RECORD = (
    "<voyage><Port>{}</Port><days>31</days><Stops><stop>Cork</stop><stop>Lima</stop></Stops>"
    "<Cargo><tea>12</tea><Rum>3</Rum></Cargo></voyage>"
)
XML = "<voyages>" + "".join(RECORD.format(x) for x in ("Bergen", "Dakar", "Galle")) + "</voyages>"
BAD_XML = XML.replace("</voyages>", "<voyage><Port>Hull</voyage></voyages>")
CSV = "Port,Tons,Flag\nBergen,80,no\nDakar,95,sn\n"
ROWS = [("Bergen", "80", "no"), ("Dakar", "95", "sn")]
SKIPPED = {"readme.txt": "x", "x_audit.csv": "a\n1\n", "./.hidden": "z"}


def zipped(files: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.mkdir("folder")
        for name, text in files.items():
            archive.writestr(name, text)
    return out.getvalue()


def tarred(files: dict[str, str], mode: str = "w:gz") -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as archive:
        for name, text in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            archive.addfile(info, io.BytesIO(text.encode()))
    return out.getvalue()


# --- XML ------------------------------------------------------------------------------


def test_xml(spark, write):
    batch = read_xml(spark, [write("voyages.xml", XML)], replacement="_")
    kinds = {f.name: f.dataType.simpleString() for f in batch.rows().schema}
    assert kinds == {
        "port": "string", "days": "string", "stops": "map<string,array<string>>", "cargo": "map<string,string>",
    }
    rows = batch.rows().orderBy("port").collect()
    assert [r["port"] for r in rows] == ["Bergen", "Dakar", "Galle"]
    assert rows[1]["stops"] == {"stop": ["Cork", "Lima"]}
    assert rows[2]["cargo"] == {"tea": "12", "rum": "3"}
    assert batch.bad.count() == 0


def test_an_xml_error_rejects_the_whole_file(spark, write):
    paths = [write("bad.xml", BAD_XML), write("good.xml", XML), write("empty.xml", "")]
    batch = read_xml(spark, paths, destination=Destination(r"(\w+)\.xml", 1))
    assert {r["_table"] for r in batch.good.collect()} == {"good"}
    assert batch.good.count() == 3
    assert tuples(batch.bad.select("_table", "rawData")) == [("bad_error", BAD_XML), ("empty_error", "")]


def test_xml_shapes(spark, write):
    one = '<r xmlns="urn:x"><a id="7">text</a><a><n>1</n></a><b><n>00501</n><e/></b></r>'
    batch = read_xml(spark, [write("a.xml", one), write("b.xml", "<q><b><n>x</n><n>&lt;y</n></b></q>")])
    rows = [r.asDict() for r in batch.rows().orderBy("id", "n").collect()]
    rows.sort(key=lambda r: (r["n"] is not None, len(r["n"] or []), (r["n"] or ["1"])[0] != "1"))
    # Children of any tag are records; what repeats in one is an array in all.
    assert {"id": "7", "value": "text"}.items() <= rows[0].items()
    assert [r["n"] for r in rows] == [None, ["1"], ["00501"], ["x", "<y"]]
    single = read_xml(spark, [write("single.xml", "<root><record><x>00501</x><y/></record></root>")])
    assert tuples(single.rows()) == [("00501", "")]


def test_xml_arrays_of_single_elements(spark, write):
    text = "<root><r><v>1</v></r><r><v>2</v><v>3</v></r></root>"
    assert tuples(read_xml(spark, [write("a.xml", text)]).rows()) == [(["1"],), (["2", "3"],)]


def test_xml_text_records_are_rejected(spark, write):
    batch = read_xml(spark, [write("a.xml", "<root><r>plain</r><r><x>1</x></r></root>")])
    assert tuples(batch.rows()) == [("1",)]
    assert tuples(batch.bad.select("rawData")) == [('"plain"',)]


def test_xml_row_tag(spark, write):
    path = write("a.xml", XML.replace("</voyages>", "<voyage><Port>G<x></Port></voyage></voyages>"))
    batch = read_xml(spark, [path], replacement="_", row_tag="voyage")
    assert [r[0] for r in tuples(batch.rows().select("port"))] == ["Bergen", "Dakar", "Galle"]
    assert batch.rows().first()["stops"] == {"stop": ["Cork", "Lima"]}
    assert "G<x>" in batch.bad.first()["rawData"]


ODD_XML = {
    "cut.xml": "<root><!-- <r><N>no</N></r> --><r a='1'><N>x&amp;y</N></r><r/><rx><r/></rx><r\n b='2'><N><![CDATA[</r>]]></N></r ></root>",
    "nested.xml": "<root><a><r><r><N>in</N></r><N>out</N></r></a></root>",
    "mixed.xml": "<root><r>t<N>1</N>u</r><r> </r></root>",
    "space.xml": "<x:root xmlns:x='u'><x:r><N>p</N></x:r><r><q:N xmlns:q='v'>q</q:N></r></x:root>",
}
BROKEN_XML = {
    "broken.xml": "<root><r><N>1</N></r><r><M>2</N></r><r><N>3</N></r></root>",
    "open.xml": "<root><r><N>1</N></r>",
    "two.xml": "<r><N>1</N></r><r><N>2</N></r>",
    "marked.xml": "\ufeff<root><r><N>b</N></r></root>",
    "typed.xml": "<!DOCTYPE root><root><r><N>d</N></r></root>",
}


def by_source(spark, path):
    """Records as Spark's XML source has them, without the fields that are not there."""
    options = {"rowTag": "r", "inferSchema": "false", "columnNameOfCorruptRecord": "_corrupt"}
    rows = spark.read.format("xml").options(**options).load(path)
    texts = rows.select(F.to_json(F.struct("*")).alias("t")) if rows.columns else rows.selectExpr("'{}' AS t")
    return sorted(r["t"] for r in texts.collect())


@pytest.mark.parametrize("name", [*ODD_XML, *BROKEN_XML])
def test_records_with_a_tag_are_those_of_sparks_source(spark, write, name, monkeypatch):
    """Records cut out of small files are what the source gives, which only reads files that may differ."""
    path = write(name, (ODD_XML | BROKEN_XML)[name])
    asked, load = [], DataFrameReader.format
    want = by_source(spark, path)
    monkeypatch.setattr(DataFrameReader, "format", lambda self, kind: asked.append(kind) or load(self, kind))
    found = tagged_records(spark, [path], "r").collect()
    assert ("xml" in asked) == (name in BROKEN_XML)
    rejects = [r["bad"] for r in found if r["bad"] is not None]
    good = [r["value"] for r in found if r["bad"] is None]
    assert sorted(good + [json.dumps({"_corrupt": t}, separators=(",", ":")) for t in rejects]) == want
    assert {r["file_name"] for r in found} == {name}


def test_records_of_files_that_differ_have_one_schema(spark, write):
    for name, text in {"a.xml": "<x><r><N>1</N><N>2</N></r></x>", "b.xml": "<x><r><N>3</N></r></y>", "c.xml": "<x><r><M k='1'/></r></x>"}.items():
        path = write(name, text)
    batch = read_xml(spark, [path.rsplit("/", 1)[0]], row_tag="r")
    assert sorted(r[0] or [] for r in batch.rows().select("n").collect()) == [[], ["1", "2"], ["3"]]
    assert [r["rawData"] for r in batch.bad.collect()] == ["<x><r><N>3</N></r></y>"]


def test_a_file_of_nothing_but_errors(spark, write):
    batch = read_xml(spark, [write("a.xml", "<root><r><N>a & b</N></r></root>")], row_tag="r")
    assert batch.good.count() == 0
    assert [r["rawData"] for r in batch.bad.collect()] == ["<root><r><N>a & b</N></r></root>"]


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [
        ("string", "array<string>", "array<string>"),
        ("struct<a:string>", "struct<b:string>", "struct<a:string,b:string>"),
        ("struct<a:string>", "string", "struct<_VALUE:string,a:string>"),
        ("array<struct<a:string>>", "struct<a:array<string>>", "array<struct<a:array<string>>>"),
    ],
)
def test_types_of_records_meet(a, b, both):
    from pyspark.sql.types import StructType

    kinds = [StructType.fromDDL(f"x {t}")["x"].dataType for t in (a, b)]
    assert united(*kinds).simpleString() == united(*reversed(kinds)).simpleString() == both


# --- archives -------------------------------------------------------------------------


def test_zip_of_csv(spark, write):
    files = {"ports-5.csv": CSV, "skip_pattern": "x,y\n", "a/b.csv": CSV, **SKIPPED}
    path = write("ports.zip", zipped(files))
    write("not-a-zip.txt", CSV)
    batch = read_delimited(
        spark, [path.rsplit("/", 1)[0]], has_header=True, compression="ZIP", skip=["skip_pattern"]
    )
    assert tuples(batch.rows()) == sorted(ROWS * 2)
    meta = batch.good.select("_meta.meta_archive_file_name", "_meta.meta_file_name").distinct()
    assert tuples(meta) == [
        ("ports.zip", "a/b.csv"), ("ports.zip", "ports-5.csv"),
    ]


@pytest.mark.parametrize("mode", ["w:gz", "w", "w:bz2"])
def test_tar_of_csv(spark, write, mode):
    files = {"./ports-6.csv": CSV, "other.csv": "Z,Y\n1,2\n3\n", **SKIPPED}
    path = write("ports.tar.gz", tarred(files, mode))
    destination = Destination(r"(.*)\.csv", 1, "prefix_", "_suffix")
    batch = read_delimited(
        spark, [path], has_header=True, compression="TAR", replacement="_", destination=destination
    )
    table = "prefix_ports_6_suffix"
    own = batch.good.filter(f"_table = '{table}'")
    assert tuples(own.select(*batch.layout[table])) == ROWS
    assert batch.layout["prefix_other_suffix"] == ["z", "y"]
    assert tuples(batch.bad.select("rawData", "_table")) == [("3", "prefix_other_suffix_error")]
    names = {r[0] for r in batch.good.select("_meta.meta_file_name").collect()}
    assert names == {"ports-6.csv", "other.csv"}


@pytest.mark.parametrize("mode", ["w:gz", "w"])
@pytest.mark.parametrize("allow", [True, False])
def test_tar_with_generic_headers(spark, write, mode, allow):
    files = {"a.csv": "1,2\n3,4,5\n", "b.csv": "6\n"}
    path = write("x.tar", tarred(files, mode))
    batch = read_delimited(
        spark, [path], compression="TAR", replacement="_", allow_extra_columns=allow
    )
    assert batch.columns == ["column_1", "column_2", "column_3"]
    expected = [("3", "4", "5"), ("6", None, None)]
    if allow:
        expected.append(("1", "2", None))
    assert tuples(batch.rows()) == sorted(expected)
    assert [r["rawData"] for r in batch.bad.collect()] == ([] if allow else ["1,2"])


def test_archived_dialect(spark, write):
    path = write("x.zip", zipped({"a.txt": "A\tB\nx\\ty\t\\\\N\n"}))
    batch = read_delimited(
        spark, [path], has_header=True, compression="ZIP", format=dialect("MYSQL")
    )
    assert tuples(batch.rows()) == [("x\ty", "\\N")]


def test_zip_and_tar_of_json(spark, write):
    lines = '{"port":"A","L":[1]}\r\n{"broken\n\n{"port":"C"}'
    for name, data, kind in (
        ("ports.zip", zipped({"j_2.json": lines}), "ZIP"),
        ("ports.tar.gz", tarred({"./j_2.json": lines}), "TAR"),
    ):
        batch = read_json_lines(spark, [write(name, data)], compression=kind, redistribute=3)
        assert tuples(batch.rows()) == sorted([("A", ["1"]), ("C", None)], key=repr)
        assert tuples(batch.bad.select("rawData", "_meta.meta_archive_file_name")) == [('{"broken', name)]


def test_zip_and_tar_of_xml(spark, write):
    files = {"good.xml": XML, "bad.xml": BAD_XML}
    for name, data, kind in (("x.zip", zipped(files), "ZIP"), ("x.tgz.tar", tarred(files), "TAR")):
        batch = read_xml(spark, [write(name, data)], compression=kind)
        assert batch.good.count() == 3
        assert tuples(batch.bad.select("rawData", "_meta.meta_file_name")) == [(BAD_XML, "bad.xml")]


def test_sparse_entries_of_a_plain_tar(spark, write, tmp_path):
    if os.system("tar --version > /dev/null 2>&1"):
        pytest.skip("there is no tar")
    path = tmp_path / "holes.csv"
    with open(path, "wb") as f:
        f.write(b"a,b\n1,")
        f.seek(1 << 20)
        f.write(b"2\n3,4\n")
    assert not os.system(f"cd {tmp_path} && tar --sparse -cf holes.tar holes.csv")
    with tarfile.open(tmp_path / "holes.tar") as tar:
        sparse = tar.getmember("holes.csv").issparse()
    batch = read_delimited(spark, [str(tmp_path / "holes.tar")], has_header=True, compression="TAR")
    assert sparse and batch.good.count() == 2
    assert tuples(batch.rows().where("a = '3'")) == [("3", "4")]


def test_zip_directories_are_not_read_for_each_entry(spark, write):
    path = write("many.zip", zipped({f"e{i}.json": f'{{"i":{i}}}' for i in range(2500)}))
    work = units(list_files(spark, [path]), "ZIP")
    assert work.count() <= 3
    assert read_json_lines(spark, [path], compression="ZIP", skip=["e1.*"]).good.count() == 2500 - 1111


def test_a_row_tag_without_files(spark, tmp_path):
    assert read_xml(spark, [f"{tmp_path}/none*.xml"], row_tag="r").good.count() == 0


def test_names_that_scans_leave_out(spark, write, tmp_path):
    for name in ("_a", ".c", "b"):
        write(f"{name}.csv", f"K,V\n{name},1\n")
        write(f"{name}.json", f'{{"k":"{name}"}}\n')
    for pattern, count in (("*.csv", 3), ("_a.csv", 1), ("[.]c.csv", 1)):
        batch = read_delimited(spark, [f"{tmp_path}/{pattern}"], has_header=True)
        assert batch.good.count() == count and batch.columns == ["k", "v"]
    for pattern, count in (("*.json", 3), ("_a.json", 1)):
        assert read_json_lines(spark, [f"{tmp_path}/{pattern}"]).good.count() == count


def test_unknown_compression(spark, write):
    with pytest.raises(LandingError, match="RAR"):
        read_delimited(spark, [write("a.csv", CSV)], compression="RAR")


@pytest.mark.parametrize("kind", ["ZIP", "TAR"])
def test_archives_are_split_once(spark, write, kind):
    """Headers, good rows and rejects come from one table of records; nothing opens the archive again."""
    from quayside.plans.fixtures import packed
    from quayside.sources.delimited import read_delimited

    files = [("beds.csv", b"K,V\n1,a\n2\n3,b\n"), ("frames.csv", b"V,W\nx,y\n"), ("none.csv", b"")]
    name = "in.zip" if kind == "ZIP" else "in.tar.gz"
    path = write(name, packed(files, kind.lower(), name))
    batch = read_delimited(spark, [path], has_header=True, compression=kind)
    for side in (batch.good, batch.bad):
        assert "MapInArrow" not in side._jdf.queryExecution().executedPlan().toString()
    os.remove(path)
    assert batch.columns == ["k", "v", "w"]
    assert tuples(batch.rows()) == sorted([("1", "a", None), ("3", "b", None), (None, "x", "y")], key=repr)
    assert [r["rawData"] for r in batch.bad.collect()] == ["2"]


def test_generic_headers_of_entries_have_the_width_of_the_widest_record(spark, write):
    from quayside.plans.fixtures import packed
    from quayside.sources.delimited import read_delimited

    path = write("in.zip", packed([("a.csv", b"1,2,3\n4\n"), ("b.csv", b"5\n")], "zip", "in.zip"))
    batch = read_delimited(spark, [path], compression="ZIP", replacement="_")
    assert tuples(batch.rows()) == sorted([("1", "2", "3"), ("5", None, None)], key=repr)
    assert [r["rawData"] for r in batch.bad.collect()] == ["4"]
