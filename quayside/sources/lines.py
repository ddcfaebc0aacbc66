"""Records of delimited text in the JVM: where lines belong together, and what their cells are.

A record may run over line ends, inside quotes or after an escape character. Whether a line begins
inside quotes depends on all lines before it, but each line only changes that in one of
four ways: it keeps it, swaps it, or ends outside or inside whatever came before. So the
lines of a range of a file are summed up in one row, which does the same to the state, and from the rows before it
each range knows how it begins. No file is read front to back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.functions.names import decoded
from quayside.scratch import Workspace
from quayside.sources.dialects import ESCAPES, Dialect, java_char

OUTSIDE, INSIDE = False, True
#: A task reads so many bytes at least, and so many ranges of files at most are sent to all executors.
TASK_BYTES, BROADCAST_RANGES = 1 << 23, 250_000


def file_path() -> Column:
    """The path of a row's file, as listings of files have it."""
    return short_path(decoded("_metadata.file_path"))


def short_path(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


class Grammar:
    """The patterns of a dialect, for Spark's regular expressions."""

    def __init__(self, d: Dialect):
        self.d = d
        self.sep = sep = "".join(java_char(c) for c in d.sep)
        self.quote = q = java_char(d.quote) if d.quote else ""
        self.escape = e = java_char(d.escape) if d.escape else ""
        self.escaped = rf"{e}(?:\r\n|{sep}|.)?" if e else ""
        bare = [rf"[^{sep}{e}]++" if len(d.sep) == 1 else rf"(?!{sep})[^{e}]" if e else rf"(?!{sep})."]
        self.rest = "(?:" + "|".join(bare + ([self.escaped] if e else [])) + ")*+"
        self.lead = rf"[\s&&[^{sep}]]*+" if d.trim else ""
        if not q:
            self.cell = self.whole_cell = self.rest
            return
        within = [rf"[^{q}{e}]++", q + q] + ([self.escaped] if e else [])
        self.body = "(?:" + "|".join(within) + ")*+"
        plain = rf"(?!{self.lead}{q}){self.rest}"
        self.cell = rf"(?:{self.lead}{q}{self.body}(?:{q}{self.rest}|\z)|{plain})"
        self.whole_cell = rf"(?:{self.lead}{q}{self.body}{q}{self.rest}|{plain})"

    @property
    def more(self) -> str:
        return rf"(?:{self.sep}{self.whole_cell})*+\z"

    def comment(self, line: Column) -> Column:
        return line.startswith(self.d.comment) if self.d.comment else F.lit(False)

    def opens(self, line: Column) -> Column:
        """Whether a line that begins a record ends inside quotes."""
        if not self.quote:
            return F.lit(OUTSIDE)
        return ~(self.comment(line) | line.rlike(rf"(?s)\A{self.whole_cell}{self.more}"))

    def opens_continued(self, line: Column) -> Column:
        """Whether a line that goes on with a cell without quotes ends inside quotes."""
        return ~line.rlike(rf"(?s)\A{self.rest}{self.more}") if self.quote else F.lit(OUTSIDE)

    def stays_open(self, line: Column) -> Column:
        """Whether a line that begins inside quotes ends there."""
        return ~line.rlike(rf"(?s)\A{self.body}{self.quote}{self.rest}{self.more}") if self.quote else F.lit(OUTSIDE)

    def continues(self, line: Column) -> Column:
        """Whether the last character of a line escapes its end."""
        e = self.escape
        if not e:
            return F.lit(False)
        return line.rlike(rf"(?:\A|[^{e}])(?:{e}{e})*+{e}\z") & ~self.comment(line)

    def alone(self, line: Column) -> Column:
        """Whether a line is a record, or one that every reader leaves out."""
        blank = line.rlike(r"\A(?=.)\s+\z") if self.d.skip_blank else line.rlike(r"\A\s*\z")
        return ~(self.opens(line) | self.continues(line) | blank)

    def cells(self, record: Column) -> Column:
        """The cells of a record; one that is not there is NULL."""
        found = F.regexp_extract_all(
            F.concat(F.lit(self.d.sep), record), F.lit(rf"(?s){self.sep}({self.cell})"), F.lit(1)
        )
        return F.transform(found, self.value)

    def count(self, record: Column) -> Column:
        return F.regexp_count(F.concat(F.lit(self.d.sep), record), F.lit(rf"(?s){self.sep}{self.cell}"))

    def value(self, cell: Column) -> Column:
        d = self.d
        bare = self.unescaped(cell)
        if d.trim:
            bare = F.regexp_replace(bare, r"\A\s+|\s+\z", "")
        if not self.quote:
            return self.known(bare)
        start = rf"(?s)\A{self.lead}{self.quote}"
        inner = F.regexp_extract(cell, rf"{start}({self.body})", 1)
        inner = self.unescaped(inner, quoted=True) if d.escape else F.replace(inner, F.lit(d.quote * 2), F.lit(d.quote))
        after = F.regexp_extract(cell, rf"{start}{self.body}{self.quote}(.*)\z", 1)
        if d.trim:
            after = F.when(after.rlike(r"\A\s*\z"), F.lit("")).otherwise(after)
        text = F.concat(inner, self.unescaped(after))
        if d.keep_quoted_empty:
            text = F.when(text == "", F.lit("")).otherwise(self.known(text))
        else:
            text = self.known(text)
        if d.trim:
            return F.when(cell.rlike(start), text).otherwise(self.known(bare))
        # most quoted cells have nothing to resolve
        middle = F.substring(cell, F.lit(2), F.length(cell) - 2)
        simple = (F.length(cell) > 2) & cell.endswith(d.quote) & ~middle.contains(d.quote)
        if d.escape:
            simple = simple & ~middle.contains(d.escape)
        text = F.when(simple, self.known(middle)).otherwise(text)
        return F.when(cell.startswith(d.quote), text).otherwise(self.known(bare))

    def known(self, text: Column) -> Column:
        return text if self.d.null is None else F.nullif(text, F.lit(self.d.null))

    def unescaped(self, text: Column, quoted: bool = False) -> Column:
        """A text with its escapes, and doubled quotes where it was quoted, resolved from left to right."""
        d = self.d
        if not d.escape:
            return text
        tokens = rf"(?s){self.escaped}|[^{self.escape}]++"
        meant = {d.escape + c: c for c in ("\r\n", *"\r\n\t\b\f", d.sep, d.escape, d.quote, d.comment) if c}
        meant |= {d.escape + c: v for c, v in ESCAPES.items()}
        if quoted:
            tokens = rf"(?s){self.escaped}|{self.quote}{self.quote}|[^{self.escape}{self.quote}]++|{self.quote}"
            meant[d.quote * 2] = d.quote
        table = F.create_map(*[F.lit(x) for pair in meant.items() for x in pair])
        parts = F.transform(
            F.regexp_extract_all(text, F.lit(tokens), F.lit(0)), lambda t: F.coalesce(F.try_element_at(table, t), t)
        )
        marked = text.contains(d.escape) | text.contains(d.quote) if quoted else text.contains(d.escape)
        return F.when(marked, F.array_join(parts, "")).otherwise(text)


RECORD = ["record", "path", "file_name", "number"]


def lines_alone(spark: SparkSession, paths: list[str], d: Dialect, has_header: bool) -> DataFrame:
    """``record, path, file_name, number`` of files whose lines all are records; without their headers.

    Spark's CSV source reads the lines as one cell, so that it leaves out headers, blank lines
    and comments. A line with the character that would separate cells comes as what it rejects.
    """
    options = {"sep": "\u0001", "quote": "", "escape": "", "header": str(has_header).lower()}
    if d.comment:
        options["comment"] = d.comment
    lines = (
        spark.read.schema("line string, rejected string")
        .options(**options, columnNameOfCorruptRecord="rejected", columnPruning="false")
        .csv(paths)
    )
    return lines.select(
        F.coalesce("rejected", "line").alias("record"),
        file_path().alias("path"),
        decoded("_metadata.file_name").alias("file_name"),
        F.lit(None).cast("long").alias("number"),
    )


def lines_together(spark: SparkSession, paths: list[str], d: Dialect) -> DataFrame:
    """``record, path, file_name, number`` of any files; ``number`` is that of its first line in the file, from 1.

    Line ends outside of quotes end records, those inside are kept as they are. A quote that is never
    closed takes the rest of its file into one record. The lines are written once, with all that
    their own range tells of them.
    """
    g, work = Grammar(d), Workspace(spark, "lines")
    tasks = task_count(spark, paths)
    lines = work.table(numbered(spark, paths, g, tasks), "lines").coalesce(tasks)
    begin = work.table(beginnings(lines), "ranges").coalesce(tasks)
    if begin.count() <= BROADCAST_RANGES:
        begin = F.broadcast(begin)
    first = F.col("n") == 1
    known = lines.join(begin, ["file", "block"])
    inside = F.when(first, F.col("begins")).otherwise(F.coalesce("last_fixed", F.col("then")) != F.col("swapped"))
    continued = F.when(first, F.col("begins_continued")).otherwise(F.col("continued"))
    after = F.when(first, F.col("then")).when(inside, F.col("stays")).otherwise(F.col("opens"))
    begins_record = (~F.col("begins") & ~F.col("begins_continued")).cast("int")
    to_here = F.when(F.col("then"), F.col("starts_inside")).otherwise(F.col("starts_outside"))
    counted = known.select(
        "path", "file_name", "block", "text", "end", "owner",
        (~inside & ~continued & ~F.col("continues")).alias("may_be_alone"),
        after.alias("after"),
        (to_here + begins_record > 0).alias("started"),
        (F.col("starts") - to_here).alias("starts_after"),
        (F.col("before") + F.col("n")).alias("number"),
    )
    # A record is known by the range it starts in and the starts that follow it there; lines before
    # the first start of a range belong to the last record of the range that has one.
    counted = counted.select(
        "path", "file_name", "text", "end", "number",
        (F.col("may_be_alone") & ~F.col("after")).alias("alone"),
        F.when(F.col("started"), F.col("block")).otherwise(F.col("owner")).alias("owner"),
        F.when(F.col("started"), F.col("starts_after")).otherwise(F.lit(0)).alias("from_last"),
    )
    single = counted.where("alone").select(F.col("text").alias("record"), "path", "file_name", "number")
    parts = F.sort_array(F.collect_list(F.struct("number", "text", "end")))
    several = counted.where("NOT alone").groupBy("path", "file_name", "owner", "from_last").agg(parts.alias("parts"))
    but_last = F.slice("parts", F.lit(1), F.size("parts") - 1)
    several = several.select(
        F.concat(
            F.array_join(F.transform(but_last, lambda p: F.concat(p["text"], p["end"])), ""),
            F.element_at("parts", -1)["text"],
        ).alias("record"),
        "path",
        "file_name",
        F.col("parts")[0]["number"].alias("number"),
    )
    records = single.unionByName(several)
    if d.skip_blank:
        records = records.where(F.col("record") != "")
    if d.comment:
        records = records.where(~g.comment(F.col("record")))
    return records


def odd(until: Column, since: Column) -> Column:
    """Whether the state was swapped an odd number of times since."""
    return F.pmod(until - F.coalesce(since, F.lit(0)), F.lit(2)) == 1


def task_count(spark: SparkSession, paths: list[str]) -> int:
    """How many tasks read files in parts of some MB, however small the ranges are that Spark cuts them into."""
    cores = spark.sparkContext.defaultParallelism
    total = spark.read.format("binaryFile").load(paths).select("length").coalesce(cores).agg(F.sum("length")).first()[0]
    return max(cores, (total or 0) // TASK_BYTES)


def numbered(spark: SparkSession, paths: list[str], g: Grammar, tasks: int) -> DataFrame:
    """Lines with their place in their range of a file, and what they do to the state of quotes there."""
    read = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    text = F.col("text")
    pieces = F.when(F.col("value").contains("\r"), F.split("value", r"\r(?!\z)")).otherwise(F.array("value"))
    lines = read.coalesce(tasks).select(
        "file", "block", F.monotonically_increasing_id().alias("at"), pieces.alias("pieces")
    )
    ended = text.endswith("\r")
    lines = lines.select("*", F.posexplode("pieces").alias("piece", "text")).select(
        "file", "block", "at", "piece",
        F.when(ended, F.left(text, F.length(text) - 1)).otherwise(text).alias("text"),
        F.when(F.col("piece") < F.size("pieces") - 1, "\r").when(ended, "\r\n").otherwise("\n").alias("end"),
    )
    here = Window.partitionBy("file", "block").orderBy("at", "piece")
    to_here = here.rowsBetween(Window.unboundedPreceding, 0)
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("n", F.row_number().over(here)).withColumn("continues", g.continues(text))
    lines = lines.withColumn("continued", F.coalesce(F.lag("continues").over(here), F.lit(False)))
    lines = (
        lines.withColumn("opens", F.when(F.col("continued"), g.opens_continued(text)).otherwise(g.opens(text)))
        .withColumn("opens_continued", F.when(F.col("n") == 1, g.opens_continued(text)))
        .withColumn("stays", g.stays_open(text))
    )
    later = F.col("n") > 1  # what the first line does depends on the range before
    fixed = F.when(later & (F.col("opens") == F.col("stays")), F.col("opens"))
    swaps = (later & F.col("opens") & ~F.col("stays")).cast("int")
    lines = (
        lines.withColumn("fixed", fixed)
        .withColumn("swaps", F.sum(swaps).over(to_here))
        .withColumn("swap", swaps)
        .withColumn("at_fixed", F.when(F.col("fixed").isNotNull(), F.col("swaps")))
    )
    lines = (
        lines.withColumn("last_fixed", F.last("fixed", True).over(before))
        .withColumn("swapped", odd(F.col("swaps") - F.col("swap"), F.last("at_fixed", True).over(before)))
        .withColumn("fixed_here", F.last("fixed", True).over(to_here))
        .withColumn("swapped_here", odd(F.col("swaps"), F.last("at_fixed", True).over(to_here)))
    )

    def starts_if(state: bool) -> Column:
        """How many records start up to a line, if the range's second line begins in a state."""
        within = F.coalesce("last_fixed", F.lit(state)) != F.col("swapped")
        return F.sum((later & ~F.col("continued") & ~within).cast("long")).over(to_here)

    lines = lines.withColumn("starts_outside", starts_if(OUTSIDE)).withColumn("starts_inside", starts_if(INSIDE))
    return lines.drop("at", "piece", "fixed", "swaps", "swap", "at_fixed")


def beginnings(lines: DataFrame) -> DataFrame:
    """How each range of a file begins: ``file, block, path, file_name, begins, then, begins_continued, before, owner, starts``.

    ``begins`` and ``then`` say whether its first and second line begin inside quotes, ``before``
    how many lines are before it, ``owner`` in which range the record starts that it begins with,
    ``starts`` how many records start after its first line. A range keeps, swaps or fixes the state
    as a line does.
    """
    first = F.col("n") == 1
    ranges = lines.groupBy("file", "block").agg(
        F.max("n").cast("long").alias("lines"),
        F.max(F.when(first, F.col("opens"))).alias("opens"),
        F.max(F.when(first, F.col("opens_continued"))).alias("opens_continued"),
        F.max(F.when(first, F.col("stays"))).alias("stays"),
        F.max_by("fixed_here", "n").alias("fixed"),
        F.max_by("swapped_here", "n").alias("swapped"),
        F.max_by("continues", "n").alias("continues"),
        F.max("starts_outside").alias("outside"),
        F.max("starts_inside").alias("inside"),
    )
    here = Window.partitionBy("file").orderBy("block")
    to_here = here.rowsBetween(Window.unboundedPreceding, 0)
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("begins_continued", F.coalesce(F.lag("continues").over(here), F.lit(False)))
    if_outside = F.when(F.col("begins_continued"), F.col("opens_continued")).otherwise(F.col("opens"))
    ranges = ranges.withColumn("out", F.coalesce("fixed", if_outside) != F.col("swapped")).withColumn(
        "out_inside", F.coalesce("fixed", "stays") != F.col("swapped")
    )
    swap = (F.col("out") & ~F.col("out_inside")).cast("int")
    ranges = ranges.withColumn("set", F.when(F.col("out") == F.col("out_inside"), F.col("out"))).withColumn(
        "swaps", F.sum(swap).over(to_here)
    )
    ranges = ranges.withColumn("at_set", F.when(F.col("set").isNotNull(), F.col("swaps")))
    begins = F.coalesce(F.last("set", True).over(before), F.lit(OUTSIDE)) != odd(
        F.col("swaps") - swap, F.last("at_set", True).over(before)
    )
    ranges = ranges.withColumn("begins", begins).withColumn(
        "then", F.when(F.col("begins"), F.col("stays")).otherwise(if_outside)
    )
    ranges = ranges.withColumn("starts", F.when(F.col("then"), F.col("inside")).otherwise(F.col("outside")))
    has_start = (~F.col("begins") & ~F.col("begins_continued")) | (F.col("starts") > 0)
    zero = F.lit(0).cast("long")
    return (
        ranges.withColumn("before", F.coalesce(F.sum("lines").over(before), zero))
        .withColumn("owner", F.coalesce(F.last(F.when(has_start, F.col("block")), True).over(before), zero))
        .select(
            "file", "block", short_path(decoded("file")).alias("path"),
            F.element_at(F.split(decoded("file"), "/"), -1).alias("file_name"),
            "begins", "then", "begins_continued", "before", "owner", "starts",
        )
    )
