"""Spread maps and arrays over columns."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.batch import HIDDEN, TABLE, Batch, LandingError, quoted, visible
from quayside.scratch import Workspace

COLUMN_LIMIT = 10_000
# A leaf below a container: its steps (map keys and 1-based indexes), and how many columns
# it takes: -1 is one, n is an array of n.
STEPS = "array<string>"
LEAF = f"struct<steps:{STEPS},n:int>"
SET = -2


@dataclass(frozen=True)
class Leaf:
    column: str
    steps: tuple[str, ...]
    place: tuple[int, int]

    @property
    def name(self) -> str:
        return "_".join((self.column, *self.steps))


def flatten(batch: Batch, max_columns: int = COLUMN_LIMIT) -> Batch:
    """``<field>_<key>`` and ``<field>_<index>`` columns at every depth.

    One aggregation finds the keys and the array lengths that occur, then one select makes
    the columns. Containers that are empty wherever they occur vanish; a container that is
    NULL in every row stays.
    """
    good = batch.good
    kinds = {f.name: f.dataType for f in good.schema.fields if f.name not in HIDDEN}
    nested = [c for c, kind in kinds.items() if is_container(kind)]
    if not nested:
        return batch
    found, never_set = find_leaves(good, nested, kinds, max_columns)

    columns: list[tuple[str, Column]] = []
    names: dict[str, str] = {}
    by_column: dict[str, list[Leaf]] = {}
    for leaf in sorted({x for leaves in found.values() for x in leaves}, key=order):
        by_column.setdefault(leaf.column, []).append(leaf)
    made: dict[str, list[str]] = {}
    for column, kind in kinds.items():
        if column not in nested or column in never_set:
            columns.append((column, quoted(column)))
            continue
        for steps in dict.fromkeys(x.steps for x in by_column.get(column, [])):
            name = "_".join((column, *steps))
            columns.append((name, cell(quoted(column), kind, steps)))
            made.setdefault(column, []).append(name)
            if column in batch.names:
                names[name] = "_".join((batch.names[column], *steps))
    made_names = [name for name, _ in columns]
    twice = sorted(n for n, times in Counter(made_names).items() if times > 1)
    if twice:
        raise LandingError(f"flattened columns collide: {twice}")
    flat = good.select(*[c.alias(n) for n, c in columns], *HIDDEN)

    layout = None
    if batch.layout is not None:
        layout = {}
        for table, known in batch.layout.items():
            own = {x.name for x in found.get(table, ())}
            layout[table] = [
                name
                for column in known
                for name in (made.get(column, []) if is_spread(column, nested, never_set) else [column])
                if name in own or not is_spread(column, nested, never_set)
            ]
    return replace(batch, good=flat, layout=layout, names={**batch.names, **names})


def is_spread(column: str, nested: list[str], never_set: set[str]) -> bool:
    return column in nested and column not in never_set


def order(leaf: Leaf) -> tuple:
    return leaf.column, leaf.place, leaf.steps


def is_container(kind: T.DataType) -> bool:
    return isinstance(kind, (T.MapType, T.ArrayType))


def find_leaves(
    good: DataFrame, nested: list[str], kinds: dict, max_columns: int
) -> tuple[dict[str | None, set[Leaf]], set[str]]:
    """The leaves of every destination, and the columns that are NULL in every row."""
    none = F.array().cast(f"array<{LEAF}>")
    per_column = []
    for column in nested:
        value = quoted(column)
        here = F.when(value.isNotNull(), F.coalesce(leaves(value, kinds[column]), none)).otherwise(none)
        # A marker per row in which the container is set, even if it is empty.
        marker = F.when(value.isNotNull(), F.array(leaf(NO_STEPS, F.lit(SET)))).otherwise(none)
        per_column.append(F.transform(F.concat(here, marker), labelled_as(column)))
    per_table = (
        good.select(TABLE, F.posexplode_outer(F.concat(*per_column)).alias("at", "e"))
        .filter(F.col("e").isNotNull())
        .groupBy(TABLE, "e.column", "e.leaf.steps")
        .agg(F.min("at").alias("at"), F.max("e.leaf.n").alias("n"))
    )
    work = Workspace(good.sparkSession, "leaves")
    try:
        per_table = work.table(per_table, "leaves")
        width = F.when(F.col("n") == -1, 1).otherwise(F.greatest("n", F.lit(0)))
        different = per_table.groupBy("column", "steps").agg(F.max("n").alias("n"))
        total = different.agg(F.sum(width)).first()[0] or 0
        if total > max_columns:
            raise LandingError(f"flattening would make more than {max_columns} columns: {total}")
        rows = per_table.collect()
    finally:
        work.close()
    found: dict[str | None, set[Leaf]] = {}
    seen = set()
    for row in rows:
        seen.add(row["column"])
        for steps, i in expand(tuple(row["steps"]), row["n"]):
            found.setdefault(row[TABLE], set()).add(Leaf(row["column"], steps, (row["at"], i)))
    return found, set(nested) - seen


def labelled_as(column: str) -> Callable[[Column], Column]:
    return lambda found: F.struct(F.lit(column).alias("column"), found.alias("leaf"))


def expand(steps: tuple[str, ...], n: int) -> Iterator[tuple[tuple[str, ...], int]]:
    if n == -1:
        yield steps, 0
    for i in range(1, n + 1):
        yield (*steps, str(i)), i


NO_STEPS: list[str] = []


def leaf(steps: Column | list, n: Column) -> Column:
    if steps is NO_STEPS:
        steps = F.array().cast(STEPS)
    return F.struct(steps.alias("steps"), n.cast("int").alias("n"))


def leaves(value: Column, kind: T.DataType) -> Column:
    """An array of the leaves below a value; lengths stand for arrays of plain values."""
    if isinstance(kind, T.ArrayType):
        if not is_container(kind.elementType):
            length = F.when(value.isNotNull(), F.size(value)).otherwise(F.lit(0))
            return F.array(leaf(NO_STEPS, length))
        return F.flatten(
            F.transform(value, lambda v, i: below((i + 1).cast("string"), v, kind.elementType))
        )
    entries = F.map_entries(value)
    return F.flatten(F.transform(entries, lambda e: below(e["key"], e["value"], kind.valueType)))


def below(step: Column, value: Column, kind: T.DataType) -> Column:
    if not is_container(kind):
        return F.array(leaf(F.array(step), F.lit(-1)))
    deeper = F.transform(
        leaves(value, kind), lambda x: leaf(F.concat(F.array(step), x["steps"]), x["n"])
    )
    return F.coalesce(deeper, F.array().cast(f"array<{LEAF}>"))


def cell(value: Column, kind: T.DataType, steps: tuple[str, ...]) -> Column:
    for step in steps:
        if isinstance(kind, T.ArrayType):
            value, kind = F.get(value, F.lit(int(step) - 1)), kind.elementType
        else:
            value, kind = F.try_element_at(value, F.lit(step)), kind.valueType
    return value
