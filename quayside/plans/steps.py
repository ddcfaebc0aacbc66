"""A job as a list of steps: one read, then transforms and writes in order."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from quayside.batch import Batch, LandingError, from_frame
from quayside.functions.names import Destination
from quayside.operators.flatten import COLUMN_LIMIT, flatten
from quayside.operators.latest import latest
from quayside.operators.metadata import (
    constant_metadata,
    derived_metadata,
    file_name_metadata,
    inject_metadata,
    read_lookup,
    token_metadata,
)
from quayside.operators.stage import stage
from quayside.operators.standardise import standardise
from quayside.sinks.files import FileSink, land_files
from quayside.sinks.tables import TableSink, land_tables
from quayside.sources.databases import read_jdbc
from quayside.sources.delimited import read_delimited
from quayside.sources.dialects import dialect
from quayside.sources.files import file_patterns
from quayside.sources.json_lines import read_documents, read_json_lines
from quayside.sources.messages import read_messages
from quayside.sources.tables import read_staged, read_table
from quayside.sources.xml_files import read_xml
from quayside.streaming.landing import EXACTLY_ONCE, FILE_LOADS, STORAGE_METHODS, TRIGGER, each_batch

Step = dict[str, Any]


@dataclass(frozen=True)
class JobOptions:
    """What is given per run rather than per job."""

    input_file_pattern: str | None = None
    patterns_from_file: str | None = None
    land_project: str | None = None
    land_dataset: str | None = None
    checkpoint: str | None = None
    available_now: bool = False
    views: dict[str, DataFrame] = field(default_factory=dict)


def run_steps(spark: SparkSession, steps: list[Step], options: JobOptions | None = None):
    """Run the steps; gives the last batch, or the running query of a streaming read.

    A step is a dictionary with a ``type`` (in any case) and that type's settings. A
    callable as ``implementation`` takes the place of a built-in: a reader gets the
    session and the step, a transform the batch, a writer the frame and whether it holds
    rejects.
    """
    options = options or JobOptions()
    batch, streamed, waiting = None, None, []
    kinds = [str(step["type"]).lower() for step in steps]
    for i, (kind, step) in enumerate(zip(kinds, steps, strict=True)):
        if kind in READERS:
            streamed, waiting = None, []
            if kind == "readpubsub" and step["source"].isStreaming:
                streamed = step
            else:
                batch = read_with(spark, step, options)
            continue
        if batch is None and streamed is None:
            raise LandingError(f"step {step['type']} comes before any read")
        if kind not in TRANSFORMS and kind not in WRITERS:
            raise LandingError(f"unknown step type {step['type']!r}")
        if streamed is not None:
            waiting.append((kind, step))
        elif kind in TRANSFORMS:
            batch = transform_with(spark, batch, step)
        else:
            if kinds[i + 1 : i + 2] and kinds[i + 1] in WRITERS and kinds[i - 1] not in WRITERS:
                # Several writes follow one read: parse once for all of them.
                batch = stage(batch)
            write_with(batch, step, options, None)
    if streamed is not None:
        return start_stream(spark, streamed, waiting, options)
    return batch


def start_stream(spark, source: Step, waiting: list[tuple[str, Step]], options: JobOptions):
    def read(micro: DataFrame) -> Batch:
        return read_messages(micro, replacement=replacement_of(source))

    def write(batch: Batch, batch_id: str) -> None:
        stream, _, number = batch_id.rpartition("-")
        for i, (kind, step) in enumerate(waiting):
            if kind in TRANSFORMS:
                batch = transform_with(spark, batch, step)
            else:
                # two writes of a batch are two commits, also where they reach one table
                write_with(batch, step, options, f"{stream}.{i}-{number}")

    if options.checkpoint is None:
        raise LandingError("a streaming read needs a checkpoint folder")
    return each_batch(
        source["source"], read, (), write, options.checkpoint, TRIGGER, options.available_now
    )


def replacement_of(step: Step) -> str:
    return step.get("replaceHeaderSpecialCharactersWith", "")


def read_with(spark: SparkSession, step: Step, options: JobOptions) -> Batch:
    custom = step.get("implementation")
    if custom is not None:
        made = custom(spark, step)
        return made if isinstance(made, Batch) else from_frame(made)
    return READERS[str(step["type"]).lower()](spark, step, options)


def transform_with(spark: SparkSession, batch: Batch, step: Step) -> Batch:
    custom = step.get("implementation")
    if custom is not None:
        return apply_custom(batch, custom)
    return TRANSFORMS[str(step["type"]).lower()](spark, batch, step)


def apply_custom(batch: Batch, custom: Callable) -> Batch:
    """A user's transform: of frames (then applied to both sides) or marked for batches."""
    if getattr(custom, "takes_batch", False):
        return custom(batch)
    return batch.map(custom)


def write_with(batch: Batch, step: Step, options: JobOptions, batch_id: str | None) -> None:
    custom = step.get("implementation")
    if custom is not None:
        custom(batch.good, False)
        custom(batch.bad, True)
        return
    WRITERS[str(step["type"]).lower()](batch, step, options, batch_id)


# --- readers --------------------------------------------------------------------------


def file_settings(spark: SparkSession, step: Step, options: JobOptions) -> dict[str, Any]:
    settings: dict[str, Any] = {
        "patterns": file_patterns(spark, options.input_file_pattern, options.patterns_from_file),
        "replacement": replacement_of(step),
        "compression": step.get("compressionFormat", "NONE"),
        "skip": step.get("skipFilesWithPattern", ()),
    }
    named = step.get("dynamicDestinationConfig")
    if named is not None:
        settings["destination"] = Destination(
            pattern=named.get("filenameParserRegex", ".*"),
            group=named.get("patternMatchIndex", 0),
            prefix=named.get("tablePrefix", ""),
            suffix=named.get("tableSuffix", ""),
        )
    return settings


def csv_dialect(step: Step):
    return dialect(
        step.get("delimiterFormat", "DEFAULT"),
        delimiter=step.get("delimiterChar"),
        escape=step.get("escapeChar"),
        quote=step.get("quoteChar"),
        null_string=step.get("nullString", ""),
        comment=step.get("commentMarker"),
        ignore_empty_lines=step.get("ignoreEmptyLines", True),
        ignore_surrounding_spaces=step.get("ignoreSurroundingSpaces", False),
    )


def csv_step(spark: SparkSession, step: Step, options: JobOptions) -> Batch:
    header = [(h.get("filePattern", ".*"), h["columns"]) for h in step.get("header", ())]
    return read_delimited(
        spark,
        format=csv_dialect(step),
        has_header=step.get("hasHeader", False),
        header=header,
        allow_extra_columns=step.get("allowExtraColumns", False),
        **file_settings(spark, step, options),
    )


def json_step(spark: SparkSession, step: Step, options: JobOptions) -> Batch:
    return read_json_lines(
        spark, json_fields=step.get("jsonFields"), **file_settings(spark, step, options)
    )


def xml_step(spark: SparkSession, step: Step, options: JobOptions) -> Batch:
    return read_xml(spark, row_tag=step.get("rowTag"), **file_settings(spark, step, options))


def jdbc_step(spark: SparkSession, step: Step, options: JobOptions) -> Batch:
    return read_jdbc(
        spark,
        step["connectionURL"],
        step["query"],
        driver=step.get("driverClassName"),
        user=step.get("username"),
        password=step.get("password"),
        properties=step.get("connectionProperties"),
        partition_column=step.get("partitionColumn"),
        lower_bound=step.get("lowerBound"),
        upper_bound=step.get("upperBound"),
        num_partitions=step.get("numPartitions", 5),
        fetch_size=step.get("fetchSize", 1000),
        replacement=replacement_of(step),
        redistribute=step.get("redistribute"),
    )


def table_step(spark: SparkSession, step: Step, options: JobOptions) -> Batch:
    return read_table(
        spark,
        query=step.get("query"),
        project=step.get("projectId"),
        dataset=step.get("datasetId"),
        table=step.get("tableId"),
    )


def staged_step(spark: SparkSession, step: Step, options: JobOptions) -> Batch:
    patterns = file_patterns(spark, options.input_file_pattern, options.patterns_from_file)
    return read_staged(
        spark, patterns, format=csv_dialect(step), replacement=replacement_of(step)
    )


def documents_step(spark: SparkSession, step: Step, options: JobOptions) -> Batch:
    return read_documents(
        step["source"], step.get("column", "value"), replacement=replacement_of(step)
    )


def messages_step(spark: SparkSession, step: Step, options: JobOptions) -> Batch:
    return read_messages(step["source"], replacement=replacement_of(step))


# --- transforms and writers -----------------------------------------------------------


def metadata_step(spark: SparkSession, batch: Batch, step: Step) -> Batch:
    settings = {}
    if "loadTimestampFieldName" in step:
        settings["load_timestamp_name"] = step["loadTimestampFieldName"]
    rename = {f["fromField"]: f["toField"] for f in step.get("fieldsToRename", ())}
    return inject_metadata(batch, rename=rename, **settings)


def lookup_step(spark: SparkSession, batch: Batch, step: Step) -> Batch:
    return file_name_metadata(batch, read_lookup(spark, step["ministryLookupPath"]))


def table_sink(step: Step, options: JobOptions) -> TableSink:
    partition = step.get("partitionBy")
    dataset = step.get("bqLandDataset", options.land_dataset)
    if dataset is None:
        raise LandingError("no dataset is configured to land in")
    return TableSink(
        dataset=dataset,
        project=step.get("bqLandProject", options.land_project),
        table=step.get("bqLandTable"),
        create=step.get("createDisposition", "CREATE_IF_NEEDED"),
        write=step.get("writeDisposition", "WRITE_APPEND"),
        partition_by=partition and (partition["columnName"], partition["dataType"]),
        error_suffix=step.get("bqErrorTableSuffix", "_error"),
    )


def table_writer(batch: Batch, step: Step, options: JobOptions, batch_id: str | None) -> None:
    method, sink = step.get("writeMethod", FILE_LOADS), table_sink(step, options)
    if method in STORAGE_METHODS:
        sink = replace(sink, unknown_columns="ignore")
    land_tables(batch, sink, batch_id if method in (EXACTLY_ONCE, FILE_LOADS) else None)


def file_writer(batch: Batch, step: Step, options: JobOptions, batch_id: str | None) -> None:
    land_files(
        batch,
        FileSink(
            root=step["outputRoot"],
            directory=step.get("outputDirectory", "default"),
            error_suffix=step.get("errorDirectorySuffix", "_error"),
            suffix=step.get("filenameSuffix", ".avro"),
            shards=step.get("numShards"),
            format=step.get("format", "avro"),
        ),
    )


def added_metadata_step(spark: SparkSession, batch: Batch, step: Step) -> Batch:
    """Fields with a constant ``fieldValue``, or made from the file name by ``fieldMapping``.

    ``methodName`` is a callable of the file name's column and the ``args``, one of the step's
    ``methods``, or absent: then the only argument is the number of a token of the file name.
    """
    for own in step.get("fields", ()):
        mapping = own.get("fieldMapping")
        if mapping is None:
            batch = constant_metadata(batch, own["fieldName"], own.get("fieldValue"))
            continue
        method, args = mapping.get("methodName"), mapping.get("args", [])
        method = step.get("methods", {}).get(method, method)
        if callable(method):
            batch = derived_metadata(batch, own["fieldName"], lambda file, m=method, a=args: m(file, *a))
        elif method is None and len(args) == 1:
            batch = token_metadata(batch, own["fieldName"], int(args[0]))
        else:
            raise LandingError(f"unknown method {method!r} for {own['fieldName']}")
    return batch


def latest_step(spark: SparkSession, batch: Batch, step: Step) -> Batch:
    return replace(batch, good=latest(batch.good, step["keys"], step["orderBy"]))


def standardise_step(spark: SparkSession, batch: Batch, step: Step) -> Batch:
    return standardise(batch, step["types"])


# The names of the step types.
READERS = {
    "readcsv": csv_step,
    "readjson": json_step,
    "readxml": xml_step,
    "readjdbc": jdbc_step,
    "readbigquery": table_step,
    "readsnowflake": staged_step,
    "readmongodb": documents_step,
    "readpubsub": messages_step,
}
TRANSFORMS = {
    "flatten": lambda spark, batch, step: flatten(batch, step.get("maxColumns", COLUMN_LIMIT)),
    "injectmetadata": metadata_step,
    "injectathenametadata": lookup_step,
    "addmetadata": added_metadata_step,
    "latest": latest_step,
    "standardise": standardise_step,
    "custom": transform_with,
}
WRITERS = {"writebigquery": table_writer, "writeavro": file_writer, "write": table_writer}
READERS["read"] = read_with
