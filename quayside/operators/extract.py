"""Columns from JSON paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.batch import META, TABLE, Batch, error_record
from quayside.functions.names import clean_header
from quayside.operators.documents import PARSE_OPTIONS


def extract_paths(
    docs: DataFrame, fields: dict[str, str | None], replacement: str = "", routed: bool = False
) -> Batch:
    """Map column names to JSON paths; an empty path gives a NULL column.

    A path without ``$`` is the name of a top-level key.
    """
    docs = docs.filter(F.col("value").rlike(r"\S"))
    names = clean_header(fields, replacement)
    keys = F.from_json("value", "map<string,string>", PARSE_OPTIONS)
    cells = []
    for name, path in zip(names, fields.values(), strict=True):
        if not path:
            cell = F.lit(None).cast("string")
        else:
            cell = F.get_json_object("value", path if path.startswith("$") else f"$['{path}']")
        cells.append(cell.alias(name))
    good = docs.filter(keys.isNotNull()).select(*cells, TABLE, META)
    bad = docs.filter(keys.isNull()).select(
        *error_record(F.lit("not a valid JSON object"), F.col("value"), F.col(TABLE), routed)
    )
    return Batch(good, bad, routed=routed)
