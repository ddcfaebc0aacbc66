"""Turn JSON documents into typed columns discovered from the data.

Leaves are text, objects are maps and arrays are arrays, at every depth. The first pass
is one aggregation over (destination, key, shape of value); the second is a ``from_json``
with the schema it found. Both stay in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.batch import META, TABLE, Batch, LandingError, error_record, keep, no_rejects, quoted
from quayside.functions.names import clean_name, clean_name_column

# What discovery finds: destination -> key -> (first position, type).
Fields = dict[str | None, dict[str, tuple[int, T.DataType]]]
TEXT, UNSEEN = T.StringType(), T.NullType()
PARSE_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
BAD, DOCUMENT = "BAD", "DOCUMENT"
LONG_SCHEMA = 256


def parse_documents(
    docs: DataFrame,
    *,
    value: str = "value",
    replacement: str = "",
    routed: bool = False,
    schema: T.StructType | None = None,
    json_null: str = "null",
    known: tuple[Fields, list[str | None]] | None = None,
    singles: bool = False,
) -> Batch:
    """Parse the JSON text in ``value`` next to the hidden columns.

    A ``schema`` (top-level keys as they are spelt in the data, with string leaves, maps
    and arrays) skips the discovery pass. ``json_null="text"`` turns a JSON null leaf into
    the text ``null``. Blank texts are skipped; whatever is not a JSON object is rejected.
    ``known`` is what a reader has discovered by itself, with or without ``singles``.
    """
    docs = docs.filter(quoted(value).rlike(r"\S")).select(
        quoted(value).alias("value"), TABLE, META
    )
    bad_tables: list[str | None] | None = None
    if schema is None:
        fields, bad_tables = known or discover(docs)
    else:
        fields = {None: {f.name: (i, f.dataType) for i, f in enumerate(schema.fields)}}

    keys = union_keys(fields, singles)
    columns = plan_columns(keys, replacement)
    names = {key: name for name, spelt in columns.items() for key in spelt}
    groups = {}
    for name, spelt in columns.items():
        kind = merge_all((keys[k][1] for k in spelt), singles)
        groups[name] = by_kind({None: kind} if singles else kinds_of(fields, spelt))
        if len(groups[name]) > 1:
            # Destinations differ: parse the column as text, and that text once per type.
            keys.update({k: (keys[k][0], TEXT) for k in spelt})

    corrupt = "_corrupt"
    while corrupt in {k.lower() for k in keys}:
        corrupt += "_"
    spelt_once = [k for spelt in columns.values() if len(spelt) == 1 for k in spelt]
    wanted = T.StructType(
        [T.StructField(k, keys[k][1]) for k in spelt_once] + [T.StructField(corrupt, TEXT)]
    )
    options = {**PARSE_OPTIONS, "columnNameOfCorruptRecord": corrupt}
    parsed = docs.withColumn("_doc", F.from_json("value", wanted, options))
    ok = F.col("_doc").getField(corrupt).isNull()

    selected, physical = [], {}
    for name, spelt in columns.items():
        kind = merge_all((keys[k][1] for k in spelt), singles)
        if len(spelt) == 1:
            cell = F.col("_doc").getField(spelt[0])
            present = F.array_contains(F.json_object_keys("value"), F.lit(spelt[0]))
        else:
            cell, present = last_of(spelt, kind)
        for n, (own, tables) in enumerate(groups[name], start=1):
            column = name if n == 1 else f"{name}:{n}"
            physical[name, own.json()] = column
            typed = cell
            if own != kind:
                asked = F.coalesce(F.col(TABLE).isin(*[t for t in tables if t]), F.lit(False))
                if None in tables:
                    asked = asked | F.col(TABLE).isNull()
                typed = F.when(asked, F.from_json(cell, own, PARSE_OPTIONS))
            if json_null == "text":
                typed = null_as_text(typed, own, present)
            selected.append(clean_keys(typed, own, replacement).alias(column))
    good = keep(parsed, ok).select(*selected, TABLE, META)

    message = F.lit("not a valid JSON object")
    if bad_tables == []:
        bad = no_rejects(good)
    else:
        bad = parsed.filter(~ok).select(
            *error_record(message, F.col("value"), F.col(TABLE), routed)
        )
    if bad_tables is not None and routed:
        bad_tables = [f"{t}_error" for t in bad_tables]

    layout = None
    if schema is None:
        layout = {}
        for table, found in fields.items():
            own = ordered({names[k]: min_at(found, columns[names[k]]) for k in found})
            layout[table] = [
                column_for(name, table, fields, columns[name], physical) for name in own
            ]
    spread = {column: name for (name, _), column in physical.items() if column != name}
    return Batch(good, bad, layout, bad_tables, routed, spread)


def kinds_of(fields: Fields, spelt: list[str]) -> dict[str | None, T.DataType]:
    """The type each destination has for a column."""
    kinds = {}
    for table, found in fields.items():
        own = [found[k][1] for k in spelt if k in found]
        if own:
            kinds[table] = merge_all(own)
    return kinds


def by_kind(kinds: dict[str | None, T.DataType]) -> list[tuple[T.DataType, list[str | None]]]:
    """The different types of a column with the destinations that have them, text first."""
    groups: dict[str, tuple[T.DataType, list[str | None]]] = {}
    for table in sorted(kinds, key=lambda t: t or ""):
        groups.setdefault(kinds[table].json(), (kinds[table], []))[1].append(table)
    return sorted(groups.values(), key=lambda group: (group[0] != TEXT, group[0].json()))


def column_for(name, table, fields: Fields, spelt: list[str], physical: dict) -> str:
    own = kinds_of({table: fields[table]}, spelt)[table]
    return physical.get((name, own.json()), name)


def union_keys(fields: Fields, singles: bool = False) -> dict[str, tuple[int, T.DataType]]:
    """The keys of all destinations together."""
    keys: dict[str, tuple[int, T.DataType]] = {}
    for found in fields.values():
        for key, (at, kind) in found.items():
            first, seen = keys.get(key, (at, UNSEEN))
            keys[key] = (min(at, first), merge(seen, kind, singles))
    return keys


def min_at(found: dict, spelt: list[str]) -> int:
    return min(found[k][0] for k in spelt if k in found)


def ordered(positions: dict[str, int]) -> list[str]:
    return sorted(positions, key=lambda name: (positions[name], name))


def plan_columns(keys: dict, replacement: str) -> dict[str, list[str]]:
    """Cleaned column name -> the spellings that lead to it, columns in order."""
    columns: dict[str, list[str]] = {}
    for key in sorted(keys, key=lambda k: (keys[k][0], k)):
        columns.setdefault(clean_name(key, replacement), []).append(key)
    if "" in columns:
        raise LandingError(f"keys without any letter or digit: {columns['']}")
    return columns


# --- discovery ------------------------------------------------------------------------


def discover(docs: DataFrame) -> tuple[Fields, list]:
    """The keys of every destination, and the destinations that have rejects."""
    keyed = F.from_json("value", "map<string,variant>", PARSE_OPTIONS)
    schemas = F.transform(
        F.map_entries(keyed),
        lambda e: entry(e["key"], F.call_function("schema_of_variant", e["value"])),
    )
    no_key = F.lit(None).cast("string")
    document = F.array(entry(no_key, F.lit(DOCUMENT)))
    entries = F.coalesce(F.concat(schemas, document), F.array(entry(no_key, F.lit(BAD))))
    # The outer form: for the other one Spark would add a filter that parses once more.
    exploded = docs.select(TABLE, F.posexplode_outer(entries).alias("at", "e"))
    # Equal schemas are reduced to one row each before their shape is worked out; long
    # ones, which are seldom equal, the other way round.
    text = F.col("e.shape")
    text = F.when(F.length(text) > LONG_SCHEMA, shape(text)).otherwise(text)
    schemas = exploded.groupBy(TABLE, "e.key", text.alias("text")).agg(F.min("at").alias("at"))
    shapes = schemas.select(TABLE, "at", "key", shape(F.col("text")).alias("shape"))
    # The parse that makes the cells takes documents with repeated keys, so this one has to.
    with setting(docs.sparkSession, "spark.sql.variant.allowDuplicateKeys", "true"):
        return fold_keys(shapes)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting that holds for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def entry(key: Column, shape_text: Column) -> Column:
    return F.struct(key.alias("key"), shape_text.alias("shape"))


def fold_keys(found: DataFrame, singles: bool = False) -> tuple[Fields, list]:
    """Reduce ``(table, at, key, shape)`` rows to the types of the keys.

    The aggregation leaves one row per key and shape, few enough for the driver. With
    ``singles`` a value next to arrays of such values counts as an array of one.
    """
    rows = found.groupBy(TABLE, "key", "shape").agg(F.min("at").alias("at")).collect()
    tables: Fields = {}
    bad_tables = []
    for row in sorted(rows, key=lambda r: (r[TABLE] or "", r["key"] or "")):
        if row["shape"] == BAD:
            bad_tables.append(row[TABLE])
            continue
        keys = tables.setdefault(row[TABLE], {})
        if row["key"] is not None:
            at, kind = keys.get(row["key"], (row["at"], UNSEEN))
            kind = merge(kind, shape_type(row["shape"], singles), singles)
            keys[row["key"]] = (min(at, row["at"]), kind)
    for keys in tables.values():
        for key, (at, kind) in keys.items():
            keys[key] = (at, settle(kind))
    return tables, bad_tables


def shape(text: Column) -> Column:
    """A variant's schema with field names and scalar types blanked out.

    ``{"x": 1, "y": ["a"]}`` gives ``OBJECT<k: STRING, k: ARRAY<STRING>>``, so the number
    of different shapes depends on the nesting and not on the keys.
    """
    nested = F.regexp_replace(text, r"(?:`(?:[^`]|``)*`|[A-Za-z0-9_]+): ", "k: ")
    scalar = r"\b(?!OBJECT\b|ARRAY\b|VOID\b)[A-Z_]+(?:\([0-9, ]*\))?"
    nested = F.regexp_replace(nested, scalar, "STRING")
    repeat = r"(k: [A-Z]+(?:<[^<>]*(?:<[^<>]*>[^<>]*)*>)?)(?:, \1)+(?=[,>])"
    for _ in range(2):
        nested = F.regexp_replace(nested, repeat, "$1")
    return (
        F.when(text.startswith("OBJECT") | text.startswith("ARRAY"), nested)
        .when(text.isin("VOID", BAD, DOCUMENT), text)
        .otherwise(F.lit("STRING"))
    )


@lru_cache(maxsize=4096)
def shape_type(text: str, singles: bool = False) -> T.DataType:
    """The type a shape stands for; the null type where only nulls were seen."""
    parsed = T.StructType.fromDDL("x " + text.replace("OBJECT<", "STRUCT<"))
    return collapse(parsed.fields[0].dataType, singles)


def collapse(kind: T.DataType, singles: bool) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.MapType(TEXT, merge_all((collapse(f.dataType, singles) for f in kind.fields), singles))
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(collapse(kind.elementType, singles))
    return UNSEEN if isinstance(kind, T.NullType) else TEXT


def merge(a: T.DataType, b: T.DataType, singles: bool = False) -> T.DataType:
    """The type that holds both; different kinds meet as text."""
    if a == UNSEEN or b == UNSEEN:
        return b if a == UNSEEN else a
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(TEXT, merge(a.valueType, b.valueType, singles))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge(a.elementType, b.elementType, singles))
    if singles and isinstance(a, T.ArrayType):
        return T.ArrayType(merge(a.elementType, b, singles))
    if singles and isinstance(b, T.ArrayType):
        return T.ArrayType(merge(a, b.elementType, singles))
    return TEXT


def merge_all(kinds: Iterable[T.DataType], singles: bool = False) -> T.DataType:
    return reduce(lambda a, b: merge(a, b, singles), kinds, UNSEEN)


def settle(kind: T.DataType) -> T.DataType:
    """Replace what was never seen (null, ``{}``, ``[]``) by text."""
    if isinstance(kind, T.MapType):
        return T.MapType(TEXT, settle(kind.valueType))
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(settle(kind.elementType))
    return TEXT


# --- cells ----------------------------------------------------------------------------


def last_of(spelt: list[str], kind: T.DataType) -> tuple[Column, Column]:
    """One column for several spellings of a key: the last one in the document wins."""
    own = F.filter(F.json_object_keys("value"), lambda k: k.isin(*spelt))
    winner = F.try_element_at(own, F.lit(-1))
    cell = F.lit(None).cast(kind)
    for key in spelt:
        alone = F.from_json("value", T.StructType([T.StructField(key, kind)]), PARSE_OPTIONS)
        cell = F.when(winner == F.lit(key), alone.getField(key)).otherwise(cell)
    return cell, F.size(own) > 0


def null_as_text(cell: Column, kind: T.DataType, present: Column | None) -> Column:
    if isinstance(kind, T.MapType):
        return F.transform_values(cell, lambda _, v: null_as_text(v, kind.valueType, None))
    if isinstance(kind, T.ArrayType):
        return F.transform(cell, lambda v: null_as_text(v, kind.elementType, None))
    if present is None:
        return F.coalesce(cell, F.lit("null"))
    return F.coalesce(cell, F.when(present, F.lit("null")))


def clean_keys(cell: Column, kind: T.DataType, replacement: str) -> Column:
    """Clean the keys of nested maps; of keys that become equal the last one wins."""
    if isinstance(kind, T.ArrayType) and has_map(kind):
        return F.transform(cell, lambda v: clean_keys(v, kind.elementType, replacement))
    if not isinstance(kind, T.MapType):
        return cell
    pairs = F.transform(
        F.map_entries(cell),
        lambda e: F.struct(
            clean_name_column(e["key"], replacement).alias("k"),
            clean_keys(e["value"], kind.valueType, replacement).alias("v"),
        ),
    )
    return let(pairs, unique_map)


def unique_map(pairs: Column) -> Column:
    names = pairs.getField("k")
    last = F.filter(
        pairs,
        lambda p, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), p["k"]),
    )
    distinct = F.size(F.array_distinct(names)) == F.size(names)
    return F.when(distinct, F.map_from_entries(pairs)).otherwise(F.map_from_entries(last))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return has_map(kind.elementType)
    return isinstance(kind, T.MapType)
