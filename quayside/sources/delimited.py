"""Delimited files: every cell is text, headers come from the data or the job.

Files with the same header are read together by Spark's CSV source. Files with line ends in
their cells and dialects that source cannot read are put together and split by ``lines``, in
the JVM as well. Entries of archives, which are not lines to Spark, are split into records inside tasks,
once: the records are a table from which headers, good rows and rejects are taken, and which
Spark cuts anew, so that what comes after does not depend on how large an entry is.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from hashlib import blake2b

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.batch import META, TABLE, Batch, error_record, keep, no_rejects
from quayside.functions.names import (
    Destination,
    clean_header,
    decoded,
    generic_header,
    without_dot_slash,
)
from quayside.scratch import Workspace
from quayside.sources.dialects import Dialect, dialect, records, text_lines
from quayside.sources.files import hidden_files, list_files, open_plain, short
from quayside.sources.lines import Grammar, lines_alone, lines_together, short_path, task_count
from quayside.sources.units import NONE, emitter, open_unit, spread, units

# A header for the files whose name matches a pattern: (pattern, column names).
HeaderRule = tuple[str, list[str]]
SPLIT = (
    "path string, file_name string, archive string, first boolean, names array<string>,"
    " header long, record string"
)
HEAD = "path string, file_name string, names array<string>, header_line long"
ORIGIN = "bad string, message string, file_name string, archive string"


def read_delimited(
    spark: SparkSession,
    patterns: list[str],
    *,
    format: Dialect | None = None,
    has_header: bool = False,
    header: Iterable[HeaderRule] = (),
    replacement: str = "",
    destination: Destination | None = None,
    compression: str = NONE,
    skip: Iterable[str] = (),
    allow_extra_columns: bool = False,
    generic_prefix: str = "COLUMN_",
) -> Batch:
    """Read delimited files or archive entries.

    A record whose width differs from its file's header is rejected with its raw text;
    ``allow_extra_columns`` pads or cuts it instead. Files without a header get generic
    names for as many columns as their widest record has.
    """
    d, skip = format or dialect(), tuple(skip)
    plain = compression == NONE
    listed = list_files(spark, patterns)
    choice = HeaderChoice(d, has_header, header, replacement, allow_extra_columns, generic_prefix)
    if plain:
        # Files that Spark leaves out for their names are opened by path in tasks.
        seen = listed.filter(~F.col("file_name").rlike("^[_.]"))
        work = units(listed.filter(F.col("file_name").rlike("^[_.]")))
        odd = bool(hidden_files(spark, patterns))
        found = described(seen, choice, destination)
    else:
        work, odd, found = units(listed, compression, skip), True, []

    named = [(r[TABLE], r["columns"]) for r in found]
    if odd:
        split = Workspace(spark, "records").table(split_units(work, choice, skip), "split")
        headers = headers_of(split, choice, destination)
        named += [(r[TABLE], r["columns"]) for r in headers]
    columns = union_of(named)
    scans = scan_files(spark, found, columns, choice)
    if odd:
        scans.append(placed_cells(split, headers, columns, choice))
    parsed = reduce(DataFrame.unionByName, scans) if scans else empty_cells(spark, columns)

    meta = [without_dot_slash(F.col("file_name")).alias("meta_file_name")]
    if not plain:
        meta.insert(0, F.col("archive").alias("meta_archive_file_name"))
    marked = parsed.withColumn(META, F.struct(*meta)).withColumn(TABLE, table_of(destination))
    cells = [F.col(f"c{i}").alias(c) for i, c in enumerate(columns)]
    routed, layout = destination is not None, layout_of(named)
    if allow_extra_columns:
        good = marked.select(*cells, TABLE, META)
        return Batch(good, no_rejects(good), layout, [], routed)
    good = keep(marked, F.col("bad").isNull()).select(*cells, TABLE, META)
    bad = keep(marked, F.col("bad").isNotNull()).select(
        *error_record(F.col("message"), F.col("bad"), F.col(TABLE), routed)
    )
    return Batch(good, bad, layout, None, routed)


def table_of(destination: Destination | None):
    if destination is None:
        return F.lit(None).cast("string")
    return destination.column(F.col("file_name"))


def union_of(named: list[tuple[str | None, list[str]]]) -> list[str]:
    return list(dict.fromkeys(c for _, columns in named for c in columns))


def layout_of(named: list[tuple[str | None, list[str]]]) -> dict[str | None, list[str]]:
    layout: dict[str | None, dict[str, None]] = {}
    for table, columns in named:
        layout.setdefault(table, {}).update(dict.fromkeys(columns))
    return {table: list(columns) for table, columns in layout.items()}


def described(files: DataFrame, choice: HeaderChoice, destination: Destination | None) -> list[dict]:
    """Files with their table and columns, in the order of their paths.

    ``alone`` says whether all lines of a file are records, whichever line ends it has; then it
    can be read by lines. ``header_line`` is the number of the line that its header begins in.
    """
    spark, d = files.sparkSession, choice.d
    heads = spread(files.select("path", "file_name", "length")).mapInArrow(choice.head(), HEAD)
    found = [r.asDict() for r in heads.withColumn(TABLE, table_of(destination)).collect()]
    found.sort(key=lambda r: r["path"])
    if not found:
        return []
    paths = [r["path"] for r in found]
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), "value").coalesce(task_count(spark, paths))
    others = lines.filter(~line_is_record(d)).select("file").distinct()
    together = {r["path"] for r in others.select(short_path(decoded("file")).alias("path")).collect()}
    for r in found:
        r["alone"] = short(r["path"]) not in together
    generic = [r for r in found if r["names"] is None]
    widths = {}
    if generic:
        counted = file_records(spark, generic, choice).groupBy("path").agg(F.max(Grammar(d).count(F.col("record"))))
        widths = {r[0]: r[1] for r in counted.collect()}
    for r in found:
        r["columns"] = choice.columns(r["names"], widths.get(short(r["path"]), 0))
    return found


def line_is_record(d: Dialect) -> Column:
    """Whether a line alone is a record for the reader that would read it by lines."""
    return F.col("value").rlike(d.closed_line()) if d.spark_reads_it else Grammar(d).alone(F.col("value"))


def file_records(spark: SparkSession, files: list[dict], choice: HeaderChoice) -> DataFrame:
    """``record, path, file_name`` of files, without their headers."""
    alone = [r["path"] for r in files if r["alone"]]
    others = [r for r in files if not r["alone"]]
    parts = []
    if alone:
        parts.append(lines_alone(spark, alone, choice.d, choice.has_header))
    if others:
        records = lines_together(spark, [r["path"] for r in others], choice.d)
        if choice.has_header:
            at = spark.createDataFrame([(short(r["path"]), r["header_line"]) for r in others], "path string, header long")
            records = records.join(at, "path").filter(F.col("number") > F.col("header")).drop("header")
        parts.append(records)
    return reduce(DataFrame.unionByName, parts)


class HeaderChoice:
    """Where the header of a file comes from: a rule for its name, itself, or its width."""

    def __init__(self, d, has_header, rules, replacement, lenient, prefix):
        self.d, self.has_header, self.lenient = d, has_header, lenient
        self.replacement, self.prefix = replacement, prefix
        self.rules = [(re.compile(p, re.IGNORECASE), list(columns)) for p, columns in rules]

    @property
    def from_file(self) -> bool:
        return self.has_header and not self.rules

    def by_name(self, file_name: str) -> list[str] | None:
        for pattern, columns in self.rules:
            if pattern.fullmatch(file_name):
                return columns
        return None

    def columns(self, names: list[str] | None, width: int) -> list[str]:
        if names is None:
            names = generic_header(width, self.prefix)
        return clean_header(names, self.replacement, fill_missing=self.lenient)

    def head(self) -> Callable:
        """Files to the names that rules or their own first records give them; reads no further."""

        def rows(file: dict) -> Iterator[tuple]:
            names, number = self.by_name(file["file_name"]), 0
            if self.has_header and file["length"]:
                with open_plain(file["path"]) as stream:
                    lines = CountedLines(text_lines(stream))
                    first, text = next(records(lines, self.d), ([], ""))
                number = lines.count - max(len(ANY_LINE.findall(text)) - 1, 0)
                if names is None and self.from_file:
                    names = [n or "" for n in first]
            yield file["path"], file["file_name"], names, number

        return emitter(rows, HEAD)


class CountedLines:
    """Lines that are counted as they are taken."""

    def __init__(self, lines: Iterable[str]):
        self.lines, self.count = iter(lines), 0

    def __iter__(self) -> CountedLines:
        return self

    def __next__(self) -> str:
        line = next(self.lines)
        self.count += 1
        return line


#: A line with or without its end.
ANY_LINE = re.compile(r"[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+")


def scan_files(spark: SparkSession, found: list[dict], columns: list[str], choice: HeaderChoice) -> list[DataFrame]:
    """A scan per header, all with the cells of ``columns``: Spark's CSV source where a file is
    read by lines and the source gives its cells, else records and their cells in the JVM."""
    d = choice.d
    by_spark = d.spark_reads_it and not (choice.lenient and d.null != "")
    groups: dict[tuple, list[dict]] = {}
    for r in found:
        if r["columns"]:
            groups.setdefault((tuple(r["columns"]), by_spark and r["alone"]), []).append(r)
    return [
        (scan_csv if simple else scan_records)(spark, list(names), files, columns, choice)
        for (names, simple), files in groups.items()
    ]


def scan_csv(spark: SparkSession, names: list[str], files: list[dict], columns: list[str], choice: HeaderChoice) -> DataFrame:
    d = choice.d
    fields = [T.StructField(f"s{i}", T.StringType()) for i in range(len(names))]
    scan = (
        spark.read.schema(T.StructType([*fields, T.StructField("bad", T.StringType())]))
        .options(**d.spark_options())
        .option("columnNameOfCorruptRecord", "bad")
        .option("columnPruning", False)
        .option("header", choice.has_header)
        .csv([r["path"] for r in files])
    )
    at = {name: F.col(f"s{i}") for i, name in enumerate(names)}
    cells = [d.spark_cell(at[c]) if c in at else F.lit(None).cast("string") for c in columns]
    # Spark refuses to read nothing but the corrupt record, so a cell goes along with
    # it: as its first 0 characters.
    beside = F.left(F.coalesce(F.col("s0"), F.lit("")), F.lit(0))
    return scan.select(
        *[cell.alias(f"c{i}") for i, cell in enumerate(cells)],
        F.concat(beside, F.col("bad")).alias("bad"),
        F.lit(f"record does not have {len(names)} cells").alias("message"),
        decoded("_metadata.file_name").alias("file_name"),
        F.lit(None).cast("string").alias("archive"),
    )


def scan_records(spark: SparkSession, names: list[str], files: list[dict], columns: list[str], choice: HeaderChoice) -> DataFrame:
    split = file_records(spark, files, choice).withColumn("cells", Grammar(choice.d).cells(F.col("record")))
    at = {name: F.get("cells", F.lit(i)) for i, name in enumerate(names)}
    nothing = F.lit(None).cast("string")
    wrong = F.lit(False) if choice.lenient else F.size("cells") != len(names)
    message = F.concat(F.lit("record has "), F.size("cells"), F.lit(f" cells instead of {len(names)}"))
    return split.select(
        *[at.get(c, nothing).alias(f"c{i}") for i, c in enumerate(columns)],
        F.when(wrong, F.col("record")).alias("bad"),
        message.alias("message"),
        "file_name",
        nothing.alias("archive"),
    )


def empty_cells(spark: SparkSession, columns: list[str]) -> DataFrame:
    return spark.createDataFrame([], cell_schema(columns))


def cell_schema(columns: list[str]) -> str:
    return "".join(f"c{i} string, " for i in range(len(columns))) + ORIGIN


def split_units(work: DataFrame, choice: HeaderChoice, skip: tuple[str, ...]) -> DataFrame:
    """The records of archive entries and oddly named files, each opened once.

    ``names`` are with the first record of a file, if rules or the record itself name its
    cells, and ``header`` stands for them with every record. The text of a record is split into
    its cells in the JVM.
    """
    d = choice.d

    def rows(unit: dict) -> Iterator[tuple]:
        for file_name, stream in open_unit(unit, skip):
            names, header = choice.by_name(file_name), None
            for i, (cells, text) in enumerate(records(text_lines(stream), d)):
                if i == 0 and names is None and choice.from_file:
                    names = [c or "" for c in cells]
                if i == 0 and names is not None:
                    header = header_key(names)
                first = i == 0
                yield unit["path"], file_name, unit["archive"], first, names if first else None, header, text.rstrip("\r\n")

    return spread(work).mapInArrow(emitter(rows, SPLIT), SPLIT)


def headers_of(split: DataFrame, choice: HeaderChoice, destination: Destination | None) -> list[dict]:
    """The different headers of what was split: names, or the width of the widest record, and columns."""
    firsts = split.filter("first").select("path", "file_name", "names")
    counted = (split.filter(~F.col("first")) if choice.has_header else split).filter(F.col("header").isNull())
    widths = counted.groupBy("path", "file_name").agg(F.max(Grammar(choice.d).count(F.col("record"))).alias("width"))
    files = firsts.join(widths, ["path", "file_name"], "left").withColumn(
        "width", F.when(F.col("names").isNull(), F.coalesce("width", F.lit(0)))
    )
    found = files.withColumn(TABLE, table_of(destination)).groupBy(TABLE, "names", "width").agg(F.min("path").alias("at"))
    headers = sorted((r.asDict() for r in found.collect()), key=lambda r: (r["at"], r["width"] or len(r["names"] or [])))
    for r in headers:
        r["columns"] = choice.columns(r["names"], r["width"] or 0)
    return headers


def header_key(names: list[str]) -> int:
    text = "\0".join(f"{len(n)}:{n}" for n in names).encode()
    return int.from_bytes(blake2b(text, digest_size=8).digest(), "little", signed=True)


#: Headers of up to so many cells together are sent to all executors, more are joined by a shuffle.
BROADCAST_CELLS = 1_000_000


def placed_cells(split: DataFrame, headers: list[dict], columns: list[str], choice: HeaderChoice) -> DataFrame:
    """Split records with the cells of ``columns``, by the header of their file."""
    spark = split.sparkSession
    rows = split.filter(~F.col("first")) if choice.has_header else split
    rows = rows.drop("names", "first")

    def known(key: str, own: dict[int, list[str]]) -> DataFrame:
        places = [(k, len(names), [names.index(c) if c in names else -1 for c in columns]) for k, names in own.items()]
        frame = spark.createDataFrame(places, f"{key} long, count int, places array<int>")
        return F.broadcast(frame) if len(own) * len(columns) <= BROADCAST_CELLS else frame

    parts = []
    if named := {header_key(r["names"]): r["columns"] for r in headers if r["names"] is not None}:
        parts.append(rows.filter(F.col("header").isNotNull()).join(known("header", named), "header"))
    if wide := {r["width"]: r["columns"] for r in headers if r["names"] is None}:
        generic = rows.filter(F.col("header").isNull())
        widths = generic.groupBy("path", "file_name").agg(F.max(Grammar(choice.d).count(F.col("record"))).cast("long").alias("width"))
        parts.append(generic.join(widths.join(known("width", wide), "width").drop("width"), ["path", "file_name"]))
    if not parts:
        return empty_cells(spark, columns)
    placed = reduce(DataFrame.unionByName, parts).withColumn("cells", Grammar(choice.d).cells(F.col("record")))
    wrong = F.lit(False) if choice.lenient else F.size("cells") != F.col("count")
    place = [F.get("places", F.lit(i)) for i in range(len(columns))]
    return placed.select(
        *[F.when(p >= 0, F.get("cells", p)).alias(f"c{i}") for i, p in enumerate(place)],
        F.when(wrong, F.col("record")).alias("bad"),
        F.concat(F.lit("record has "), F.size("cells"), F.lit(" cells instead of "), F.col("count")).alias("message"),
        "file_name",
        "archive",
    )
