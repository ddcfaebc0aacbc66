"""Give text columns a target schema; what does not fit is rejected."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.batch import HIDDEN, META, TABLE, Batch, error_record, keep, quoted


def standardise(batch: Batch, target: dict[str, str]) -> Batch:
    """Trim text, make empty text NULL and cast columns to the types of ``target``.

    A row with a value that cannot be cast goes to the rejects, as JSON of its columns and
    with the names of those that failed. Columns without a target type are only trimmed.
    """
    df, columns = batch.good, batch.columns
    kinds = {f.name: f.dataType for f in df.schema.fields}
    trimmed = {
        c: F.nullif(F.trim(quoted(c)), F.lit("")) if kinds[c] == T.StringType() else quoted(c)
        for c in columns
    }
    fit = {
        c: trimmed[c].try_cast(target[c]) if c in target else trimmed[c] for c in columns
    }
    failed = [
        F.when(trimmed[c].isNotNull() & fit[c].isNull(), F.lit(c)) for c in columns if c in target
    ]
    marked = df.withColumn("_failed", F.array_compact(F.array(*failed).cast("array<string>")))
    ok = F.size("_failed") == 0
    good = keep(marked, ok).select(*[fit[c].alias(c) for c in columns], *HIDDEN)
    bad = marked.filter(~ok).select(
        *error_record(
            F.concat(F.lit("cannot cast "), F.array_join("_failed", ", ")),
            F.to_json(F.struct(*[quoted(c) for c in columns]), {"ignoreNullFields": "false"}),
            F.col(TABLE),
            batch.routed,
        )
    )
    own = [c for c in batch.bad.columns if c not in (*bad.columns, META)]
    if not own:
        bad = batch.bad.unionByName(bad)
    else:
        bad = batch.bad.unionByName(bad, allowMissingColumns=True)
    return replace(batch, good=good, bad=bad, bad_tables=None)
