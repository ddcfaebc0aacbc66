"""Queries on databases through JDBC, over one connection or several."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.batch import Batch, from_frame
from quayside.functions.names import clean_header

# The defaults of a partitioned read and of one round trip.
PARTITIONS = 5
FETCH_SIZE = 1000
ANY_ROW = "1=1"


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    *,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    properties: str | dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int = PARTITIONS,
    fetch_size: int = FETCH_SIZE,
    replacement: str = "",
    redistribute: int | None = None,
) -> Batch:
    """Rows of a query with cleaned column names.

    ``partition_column`` reads ranges of that column over ``num_partitions`` connections;
    bounds that are not given are asked from the database. Without it one connection reads
    everything, and the rows are spread over ``redistribute`` tasks afterwards, by default
    over ``spark.sql.shuffle.partitions``; 1 leaves them where they are.
    """
    connection = connect_options(url, driver, user, password, properties, fetch_size)
    query = query.replace("$CONDITIONS", ANY_ROW)
    reader = spark.read.format("jdbc").options(**connection)
    if partition_column is None:
        rows = reader.option("query", query).load()
        tasks = redistribute or int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartition(tasks) if tasks > 1 else rows
        return from_frame(clean_columns(rows, replacement))
    if lower_bound is None or upper_bound is None:
        ends = reader.option("query", bounds_query(query, partition_column)).load().first()
        lower_bound = ends[0] if lower_bound is None else lower_bound
        upper_bound = ends[1] if upper_bound is None else upper_bound
    ranges = range_options(query, partition_column, lower_bound, upper_bound, num_partitions)
    rows = spark.read.format("jdbc").options(**connection, **ranges).load()
    return from_frame(clean_columns(rows, replacement))


def connect_options(url, driver, user, password, properties, fetch_size) -> dict[str, str]:
    if isinstance(properties, str):
        pairs = (p.split("=", 1) for p in properties.split(";") if p.strip())
        properties = {k.strip(): v.strip() for k, v in pairs}
    named = {"url": url, "driver": driver, "user": user, "password": password}
    options = {k: v for k, v in named.items() if v is not None}
    return {**(properties or {}), **options, "fetchsize": str(fetch_size)}


def bounds_query(query: str, column: str) -> str:
    return f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM ({query}) sq"


def range_options(query, column, lower, upper, partitions) -> dict[str, str]:
    if lower is None or upper is None:  # the query has no rows, or no key
        return {"dbtable": f"({query}) sq"}
    return {
        "dbtable": f"({query}) sq",
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def clean_columns(df: DataFrame, replacement: str = "") -> DataFrame:
    """Clean all column names; types and order stay."""
    return df.toDF(*clean_header(df.columns, replacement))
