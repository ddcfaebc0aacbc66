"""The value every reader returns and every transform and sink takes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Hidden columns: the destination a row asks for (NULL = the sink's default) and the
# facts about its origin that InjectMetadata can promote to real columns.
TABLE = "_table"
META = "_meta"
HIDDEN = (TABLE, META)

# The two columns of an error record.
ERROR_MESSAGE = "errorMessage"
RAW_DATA = "rawData"

ERROR_SUFFIX = "_error"


class LandingError(ValueError):
    """A job is configured in a way that cannot give a correct result."""


@dataclass(frozen=True)
class Batch:
    """Good rows, rejected rows and what is known about their destinations.

    ``layout`` gives the columns of every destination; ``None`` means that all rows
    share the columns of ``good``. ``bad_tables`` lists the destinations that do hold
    rejected rows: ``[]`` says there are none (so no sink has to look), ``None`` says
    that nobody has counted yet. ``routed`` tells whether ``_table`` is set on rows.

    Two destinations may have a column of one name and different types. Such a column is
    there once per type; ``names`` gives the name that sinks have to write for it.
    """

    good: DataFrame
    bad: DataFrame
    layout: dict[str | None, list[str]] | None = None
    bad_tables: list[str | None] | None = None
    routed: bool = False
    names: dict[str, str] = field(default_factory=dict)

    def name(self, column: str) -> str:
        return self.names.get(column, column)

    @property
    def columns(self) -> list[str]:
        return visible(self.good)

    def rows(self) -> DataFrame:
        return self.good.select(*[quoted(c) for c in visible(self.good)])

    def rejects(self) -> DataFrame:
        return self.bad.select(*[quoted(c) for c in visible(self.bad)])

    def map(self, step: Callable[[DataFrame], DataFrame]) -> Batch:
        """Apply a step to good and rejected rows alike."""
        good, bad = step(self.good), step(self.bad)
        layout = None
        if self.layout is not None and visible(good) == visible(self.good):
            layout = self.layout
        return replace(self, good=with_hidden(good), bad=with_hidden(bad), layout=layout)

    def persist(self) -> Batch:
        return replace(self, good=self.good.persist(), bad=self.bad.persist())


def visible(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in HIDDEN]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def meta_fields(df: DataFrame) -> list[str]:
    return df.schema[META].dataType.names if META in df.columns else []


def with_hidden(df: DataFrame) -> DataFrame:
    """Add the hidden columns a hand-made frame does not have."""
    if TABLE not in df.columns:
        df = df.withColumn(TABLE, F.lit(None).cast("string"))
    if META not in df.columns:
        df = df.withColumn(META, empty_meta())
    return df


def empty_meta() -> Column:
    return F.lit(None).cast(T.StructType([]))


def no_rejects(like: DataFrame) -> DataFrame:
    """An empty frame of error records with the hidden columns of ``like``."""
    fields = [T.StructField(ERROR_MESSAGE, T.StringType()), T.StructField(RAW_DATA, T.StringType())]
    fields += [like.schema[c] for c in HIDDEN]
    return session(like).createDataFrame([], T.StructType(fields))


def session(df: DataFrame) -> SparkSession:
    return df.sparkSession


def keep(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on computed columns without computing them a second time.

    Spark would move the filter, and a copy of what it looks at, below the projection; a
    column that is not deterministic holds it where it is.
    """
    row = "_row"
    held = df.withColumn(row, F.monotonically_increasing_id())
    return held.filter(condition & (F.col(row) >= 0)).drop(row)


def from_frame(df: DataFrame) -> Batch:
    """Wrap rows that need no parsing."""
    good = with_hidden(df)
    return Batch(good=good, bad=no_rejects(good), bad_tables=[])


def error_record(message: Column, raw: Column, table: Column, routed: bool) -> list[Column]:
    """The columns of a rejected row; routed rows go to ``<table>_error``."""
    target = F.concat(table, F.lit(ERROR_SUFFIX)) if routed else table
    return [message.alias(ERROR_MESSAGE), raw.alias(RAW_DATA), target.alias(TABLE), F.col(META)]
