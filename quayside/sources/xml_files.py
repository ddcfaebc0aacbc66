"""XML files: every element below the root is a record.

The default reads a file as a whole, so that an error anywhere rejects all of it; with a row
tag the records before an error are good. Records of small files are cut out once, and Spark's XML
parser gets them as a table of texts; the others go through Spark's XML source.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import BinaryIO
from xml.etree import ElementTree
from xml.parsers import expat

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.batch import META, TABLE, Batch, error_record, quoted
from quayside.functions.names import Destination, decoded
from quayside.operators.documents import BAD, fold_keys, parse_documents, union_keys
from quayside.operators.documents import DOCUMENT as RECORDS
from quayside.scratch import Workspace
from quayside.sources.files import existing, list_files
from quayside.sources.json_lines import with_origin
from quayside.sources.units import NONE, emitter, open_unit, spread, units

KEYS = "key string, shape string, at int, file_name string, archive string"
DOCUMENT = "value string, bad string, message string, file_name string, archive string"
# Fixed value: the name of text next to child elements, as Spark's XML source calls it.
MIXED_TEXT = "_VALUE"
CUT = "text string, path string, file_name string"
CORRUPT = "_corrupt"
# Files up to so many bytes are cut into records, up to so many of them and so much text by a task.
SMALL_FILE, TASK_FILES, TASK_BYTES = 1 << 20, 2000, 1 << 24
# The marks of encodings that Spark's XML source may read in a way of its own.
MARKS = (b"\xef\xbb\xbf", b"\xfe\xff", b"\xff\xfe")


def read_xml(
    spark: SparkSession,
    patterns: list[str],
    *,
    replacement: str = "",
    destination: Destination | None = None,
    compression: str = NONE,
    skip: Iterable[str] = (),
    schema: T.StructType | None = None,
    row_tag: str | None = None,
) -> Batch:
    """Records of XML files; an element that repeats anywhere is an array everywhere."""
    known = None
    if row_tag is not None:
        docs = tagged_records(spark, existing(spark, patterns), row_tag)
        archived = False
    else:
        skip, archived = tuple(skip), compression != NONE
        listed = list_files(spark, patterns, empty=not archived)
        work = spread(units(listed, compression, skip))
        if schema is None:
            keys = with_origin(work.mapInArrow(key_finder(skip), KEYS), destination, archived)
            known = fold_keys(keys, singles=True)
            kinds = {k: kind for k, (_, kind) in union_keys(known[0], singles=True).items()}
        else:
            kinds = {f.name: f.dataType for f in schema.fields}
        docs = work.mapInArrow(record_reader(skip, kinds), DOCUMENT)
    docs = with_origin(docs, destination, archived)
    routed = destination is not None
    parsed = parse_documents(
        docs.filter(F.col("message").isNull()),
        replacement=replacement,
        routed=routed,
        schema=schema,
        known=known,
        singles=True,
    )
    rejected = docs.filter(F.col("message").isNotNull()).select(
        *error_record(F.col("message"), F.col("bad"), F.col(TABLE), routed)
    )
    bad = rejected.unionByName(parsed.bad)
    if known is None:
        return Batch(parsed.good, bad, parsed.layout, None, routed)
    return Batch(parsed.good, bad, parsed.layout, parsed.bad_tables, routed)


def tagged_records(spark: SparkSession, paths: list[str], row_tag: str) -> DataFrame:
    """``value, bad, message, file_name, archive`` of the elements with a tag, as a written table.

    Spark's source opens each file anew to find a schema, in one task that carries the names of all
    files along, so it gets only large files and those in which the records cannot be cut out for sure.
    """
    if not paths:
        return spark.createDataFrame([], DOCUMENT)
    work, cores = Workspace(spark, "xml"), spark.sparkContext.defaultParallelism
    files = spark.read.format("binaryFile").load(paths)
    small = F.col("length") <= SMALL_FILE
    n, total = files.coalesce(cores).where(small).agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    contents = files.where(small).select("path", "content").coalesce(max(cores, n // TASK_FILES, total // TASK_BYTES))
    cut = work.table(contents.mapInArrow(record_cutter(row_tag), CUT), "records")
    unsure = files.coalesce(cores).where(~small).select("path").unionByName(cut.where("text IS NULL").select("path"))
    unsure = sorted(r["path"] for r in unsure.collect())
    options = {"rowTag": row_tag, "inferSchema": "false", "valueTag": MIXED_TEXT, "columnNameOfCorruptRecord": CORRUPT}
    texts = cut.where("text IS NOT NULL")
    schema = schema_of_records(texts.select("text"), options)
    if unsure:
        schema = united(schema, spark.read.format("xml").options(**options).load(unsure).schema)
    cells = [f for f in schema.fields if f.name != CORRUPT]
    # Spark refuses to read nothing but the corrupt record: 0 characters go along.
    schema = T.StructType([*(cells or [T.StructField(MIXED_TEXT, T.StringType())]), T.StructField(CORRUPT, T.StringType())])
    record = F.from_xml("text", schema, options).alias("r")
    found = texts.select(record, "file_name").select("r.*", F.col("file_name").alias("_file"))
    if unsure:
        rows = spark.read.format("xml").options(**options).schema(schema).load(unsure)
        found = found.unionByName(rows.select("*", decoded("_metadata.file_name").alias("_file")))
    value = F.to_json(F.struct(*[quoted(f.name) for f in cells])) if cells else F.lit(None).cast("string")
    beside = value if cells else F.col(MIXED_TEXT)
    bad = F.concat(F.left(F.coalesce(beside, F.lit("")), F.lit(0)), F.col(CORRUPT))
    docs = found.select(
        value.alias("value"),
        bad.alias("bad"),
        F.when(bad.isNotNull(), F.lit("not a valid XML record")).alias("message"),
        F.col("_file").alias("file_name"),
        F.lit(None).cast("string").alias("archive"),
    )
    return work.table(docs, "documents")


def schema_of_records(texts: DataFrame, options: dict[str, str]) -> T.StructType:
    """What Spark's XML source finds for such records."""
    spark = texts.sparkSession
    strings = getattr(texts._jdf, "as")(spark.sparkContext._jvm.org.apache.spark.sql.Encoders.STRING())
    return T.StructType.fromJson(json.loads(spark.read.options(**options)._jreader.xml(strings).schema().json()))


def united(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both, as Spark's XML source merges the types of records that are text in the end."""
    if isinstance(a, T.ArrayType) or isinstance(b, T.ArrayType):
        inner = [kind.elementType if isinstance(kind, T.ArrayType) else kind for kind in (a, b)]
        return T.ArrayType(united(*inner))
    if not isinstance(a, T.StructType) and not isinstance(b, T.StructType):
        return T.StringType()
    found: dict[str, T.DataType] = {}
    for kind in (a, b):
        fields = kind.fields if isinstance(kind, T.StructType) else [T.StructField(MIXED_TEXT, T.StringType())]
        for f in fields:
            found[f.name] = united(found[f.name], f.dataType) if f.name in found else f.dataType
    return T.StructType([T.StructField(name, found[name]) for name in sorted(found)])


def record_cutter(row_tag: str):
    """Files to the texts of their records, or to one row without a text if it takes Spark's source to tell."""

    def rows(file: dict) -> Iterator[tuple]:
        path = file["path"]
        name = path.rpartition("/")[2]
        texts = records_in(file["content"], row_tag)
        if texts is None:
            yield None, path, name
        else:
            for text in texts:
                yield text, None, name

    return emitter(rows, CUT)


def records_in(content: bytes, row_tag: str) -> list[str] | None:
    """The outermost elements with a tag; None for what is not plain, well-formed UTF-8 without a document type."""
    if content.startswith(MARKS) or b"<!DOCTYPE" in content:
        return None
    found: list[str] = []
    depth = start = 0
    parser = expat.ParserCreate("utf-8")
    closing = b"</" + row_tag.encode()

    def begin(name: str, _) -> None:
        nonlocal depth, start
        if depth:
            depth += 1
        elif name == row_tag:
            depth, start = 1, parser.CurrentByteIndex

    def end(_) -> None:
        nonlocal depth
        if not depth:
            return
        depth -= 1
        if not depth:
            # an empty element ends where this event is, any other one with the tag that begins here
            at = parser.CurrentByteIndex
            after = content[at + len(closing) : at + len(closing) + 1]
            if content.startswith(closing, at) and (after == b">" or after.isspace()):
                at = content.index(b">", at) + 1
            found.append(content[start:at].decode())

    parser.StartElementHandler, parser.EndElementHandler = begin, end
    try:
        parser.Parse(content, True)
    except (expat.ExpatError, UnicodeDecodeError):
        return None
    return found


def record_reader(skip: tuple[str, ...], kinds: dict[str, T.DataType]):
    nested = {k: kind for k, kind in kinds.items() if kind != T.StringType()}
    dump = json.JSONEncoder(ensure_ascii=False).encode

    def rows(unit: dict) -> Iterator[tuple]:
        for file_name, stream in whole_entries(unit, skip):
            message = error_in(stream)
            stream.seek(0)
            if message is not None:
                text = stream.read().decode("utf-8", "replace")
                yield None, text, message, file_name, unit["archive"]
                continue
            for element in elements(stream):
                value = node(element)
                if isinstance(value, dict):
                    for key in nested.keys() & value.keys():
                        value[key] = fitted(value[key], nested[key])
                yield dump(value), None, None, file_name, unit["archive"]

    return emitter(rows, DOCUMENT)


def key_finder(skip: tuple[str, ...]):
    """Per file: the keys of its records with their shapes, or that it has an error."""

    def rows(unit: dict) -> Iterator[tuple]:
        for file_name, stream in whole_entries(unit, skip):
            archive = unit["archive"]
            if error_in(stream) is not None:
                yield None, BAD, 0, file_name, archive
                continue
            stream.seek(0)
            keys: dict[str, tuple[int, set[str]]] = {}
            for element in elements(stream):
                value = node(element)
                if not isinstance(value, dict):
                    yield None, BAD, 0, file_name, archive
                    continue
                for at, (key, cell) in enumerate(value.items()):
                    first, shapes = keys.get(key) or keys.setdefault(key, (at, set()))
                    shapes.add("STRING" if type(cell) is str else shape_of(cell))
                    if at < first:
                        keys[key] = at, shapes
            yield None, RECORDS, 0, file_name, archive
            for key, (at, shapes) in keys.items():
                for text in shapes:
                    yield key, text, at, file_name, archive

    return emitter(rows, KEYS)


def whole_entries(unit: dict, skip: tuple[str, ...]) -> Iterator[tuple[str, BinaryIO]]:
    """Entries that can be read twice; one that cannot be rewound is held in memory."""
    for file_name, stream in open_unit(unit, skip):
        rewinds = unit["how"] != "tar stream" and stream.seekable()
        yield file_name, stream if rewinds else io.BytesIO(stream.read())


def error_in(stream: BinaryIO) -> str | None:
    try:
        expat.ParserCreate().ParseFile(stream)
    except expat.ExpatError as e:
        return f"not valid XML: {e}"
    return None


def elements(stream: BinaryIO) -> Iterator[ElementTree.Element]:
    """The children of the root, one at a time."""
    depth, root = 0, None
    for event, element in ElementTree.iterparse(stream, events=("start", "end")):
        if event == "start":
            depth += 1
            root = element if root is None else root
        else:
            depth -= 1
            if depth == 1:
                yield element
                root.clear()


@lru_cache(maxsize=4096)
def local(tag: str) -> str:
    return tag.rpartition("}")[2]


def node(element: ElementTree.Element):
    """An element as a JSON value: text, or an object of attributes and children.

    Children of one name are an array.
    """
    children, text = list(element), element.text or ""
    if not children and not element.attrib:
        return text
    value = {local(k): v for k, v in element.attrib.items()}
    mixed = text + "".join([child.tail for child in children if child.tail])
    if mixed and not mixed.isspace():
        value[MIXED_TEXT] = mixed
    repeated: dict[str, list] = {}
    for child in children:
        name = local(child.tag)
        below = node(child) if len(child) or child.attrib else child.text or ""
        if name not in value:
            value[name] = below
        elif name in repeated:
            repeated[name].append(below)
        else:
            value[name] = repeated[name] = [value[name], below]
    return value


def shape_of(value) -> str:
    """The shape of a value, as ``documents.shape`` writes it."""
    if isinstance(value, dict):
        inner = ", ".join(f"k: {s}" for s in sorted({shape_of(v) for v in value.values()}))
        return f"OBJECT<{inner}>"
    if isinstance(value, list):
        shapes = sorted({shape_of(v) for v in value})
        # Different elements count as fields, which merge to one type just the same.
        return f"ARRAY<{shapes[0]}>" if len(shapes) == 1 else f"ARRAY<{mixed_shape(shapes)}>"
    return "STRING"


def mixed_shape(shapes: list[str]) -> str:
    """One shape for elements of several: objects together, anything else as text."""
    if all(s.startswith("OBJECT<") for s in shapes):
        inner = ", ".join(s[len("OBJECT<") : -1] for s in shapes if s != "OBJECT<>")
        return f"OBJECT<{inner}>"
    return "STRING"


def fitted(value, kind: T.DataType | None):
    """A value where arrays are expected: a single one is an array of one."""
    if isinstance(kind, T.ArrayType):
        items = value if isinstance(value, list) else [value]
        return [fitted(v, kind.elementType) for v in items]
    if isinstance(kind, T.MapType) and isinstance(value, dict):
        return {k: fitted(v, kind.valueType) for k, v in value.items()}
    return value
