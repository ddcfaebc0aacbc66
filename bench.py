"""Time the headline operators on lineitem: prints one JSON line.

The raw inputs are written before the clock starts. Every operator runs to the end of its
job (all columns of all rows are computed), once to warm up and then three times; the
median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.batch import from_frame
from quayside.operators.flatten import flatten
from quayside.operators.latest import latest
from quayside.operators.metadata import inject_metadata
from quayside.operators.routing import route
from quayside.plans.fixtures import archives, csv_line, new_dataset, one_file_per_row, table, text_files
from quayside.scratch import scratch
from quayside.sinks.files import FileSink, land_files
from quayside.sinks.tables import TableSink, land_tables
from quayside.sources.delimited import read_delimited
from quayside.sources.dialects import dialect
from quayside.sources.json_lines import read_json_lines
from quayside.sources.xml_files import read_xml

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def cases(spark: SparkSession) -> dict:
    lineitem = table(spark, SF_DIR, "lineitem").withColumn(
        "l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd")
    )
    columns = lineitem.columns
    csv = scratch(spark, "bench_csv")
    lineitem.write.csv(csv, header=True)
    tsv = text_files(
        spark, lineitem.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in columns])), "bench_tsv"
    )
    flat_json = text_files(spark, lineitem.select(F.to_json(F.struct(*columns))), "bench_json")
    nested = F.to_json(
        F.struct(
            "l_orderkey",
            F.struct("l_quantity", "l_tax", F.struct("l_discount").alias("more")).alias("price"),
            F.array("l_returnflag", "l_linestatus").alias("flags"),
        )
    )
    nested_json = text_files(spark, lineitem.select(nested), "bench_nested")
    key = F.floor(F.col("l_orderkey") / 2000)
    line = csv_line(*[F.col(c) for c in columns])
    packs = (
        lineitem.groupBy(key.alias("pack"))
        .agg(F.array_join(F.collect_list(line), "\n").alias("text"))
        .select(
            F.concat(F.lit("p_"), F.col("pack").cast("string"), F.lit(".tar.gz")).alias("name"),
            F.array(
                F.struct(
                    F.lit("rows.csv").alias("name"),
                    F.concat(F.lit(",".join(columns) + "\n"), "text").alias("text"),
                )
            ).alias("files"),
        )
    )
    tars = archives(spark, packs, "bench_tar", "tar", extras=False)
    element = F.concat(
        F.lit("<r>"), *[F.concat(F.lit(f"<{c}>"), F.col(c).cast("string"), F.lit(f"</{c}>")) for c in columns],
        F.lit("</r>"),
    )
    xml = one_file_per_row(
        spark,
        lineitem.groupBy(key.alias("pack")).agg(
            F.concat(F.lit("<root>"), F.array_join(F.collect_list(element), ""), F.lit("</root>")).alias("x")
        ).select("x"),
        "bench_xml",
    )
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = from_frame(lineitem)

    def land(batch, sink: TableSink) -> None:
        land_tables(batch, sink)

    return {
        "s1_csv_header": lambda: drain(read_delimited(spark, [csv], has_header=True, replacement="_").rows()),
        "s6_csv_generic_header": lambda: drain(read_delimited(spark, [csv]).rows()),
        "s1_csv_landed": lambda: land(
            read_delimited(spark, [csv], has_header=True), TableSink(new_dataset(spark, "bench"), "t")
        ),
        "s2_mysql_dialect": lambda: drain(
            read_delimited(spark, [tsv], format=dialect("MYSQL"), header=[(".*", columns)]).rows()
        ),
        "s7_json_discovery": lambda: drain(read_json_lines(spark, [flat_json]).rows()),
        "s7_json_schema": lambda: drain(read_json_lines(spark, [flat_json], schema=schema).rows()),
        "t3_flatten": lambda: drain(flatten(read_json_lines(spark, [nested_json])).rows()),
        "t4_metadata": lambda: drain(
            inject_metadata(read_json_lines(spark, [flat_json], schema=schema)).rows()
        ),
        "t12_routing": lambda: land(route(rows, F.col("l_returnflag")), TableSink(new_dataset(spark, "bench"))),
        "s11_tar": lambda: drain(read_delimited(spark, [tars], has_header=True, compression="TAR").rows()),
        "s8_xml": lambda: drain(read_xml(spark, [xml]).rows()),
        "d1_latest": lambda: drain(latest(lineitem, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"])),
        "w4_partition": lambda: land(
            rows, TableSink(new_dataset(spark, "bench"), "t", partition_by=("l_shipdate", "MONTH"))
        ),
        "w10_file_layout": lambda: land_files(rows, FileSink(scratch(spark, "bench_avro"), format="parquet")) and None,
    }


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:]
    n = table(spark, SF_DIR, "lineitem").count()
    seconds = {}
    for name, run in cases(spark).items():
        if wanted and name not in wanted:
            continue
        times = []
        for _ in range(RUNS + 1):
            started = time.time()
            run()
            times.append(time.time() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "ingestion operators, sum of median seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_second": {k: round(n / s) for k, s in seconds.items()},
                "rows": n,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
