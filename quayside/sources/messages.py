"""Messages of a queue: a payload of JSON, an id and attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.batch import META, TABLE, Batch
from quayside.functions.names import attribute_text
from quayside.operators.documents import parse_documents


def read_messages(
    messages: DataFrame,
    *,
    payload: str = "payload",
    message_id: str = "message_id",
    attributes: str = "attributes",
    replacement: str = "",
    schema: T.StructType | None = None,
) -> Batch:
    """Parse a (micro-)batch of messages; broken payloads are rejected, not lost."""
    texts = messages.select(
        F.col(payload).cast("string").alias("value"),
        F.lit(None).cast("string").alias(TABLE),
        F.struct(
            F.col(message_id).cast("string").alias("meta_pubsub_message_id"),
            attribute_text(F.col(attributes)).alias("meta_pubsub_attributes"),
        ).alias(META),
    )
    return parse_documents(texts, replacement=replacement, schema=schema)
