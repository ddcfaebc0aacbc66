"""Column, table and file names."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.batch import LandingError

log = logging.getLogger(__name__)

# What counts as a special character, and what a good name looks like.
SPECIAL = r"[^A-Za-z0-9]"
IDENTIFIER = r"[A-Za-z_]+[A-Za-z0-9_]*"


def clean_name(name: str, replacement: str = "") -> str:
    """Replace special characters, trim the replacement off both ends, lower-case."""
    text = re.sub(SPECIAL, lambda _: replacement, name)
    if replacement:
        edge = re.escape(replacement)
        text = re.sub(rf"\A(?:{edge})+|(?:{edge})+\Z", "", text)
    if not re.fullmatch(IDENTIFIER, text):
        log.warning("column name %r does not clean up to an identifier", name)
    return text.lower()


def clean_name_column(name: Column, replacement: str = "") -> Column:
    """``clean_name`` for names that are data."""
    text = F.regexp_replace(name, SPECIAL, java_replacement(replacement))
    if replacement:
        edge = java_literal(replacement)
        text = F.regexp_replace(text, f"^(?:{edge})+|(?:{edge})+\\z", "")
    return F.lower(text)


def java_literal(text: str) -> str:
    """``text`` as a regular expression that matches just itself."""
    return re.sub(r"([^A-Za-z0-9_])", r"\\\1", text)


def java_replacement(text: str) -> str:
    """``text`` as a replacement without group references."""
    return re.sub(r"([\\$])", r"\\\1", text)


def clean_header(names: Iterable[str], replacement: str, fill_missing: bool = False) -> list[str]:
    """Clean a file's header; names that end up empty or equal cannot be told apart."""
    cleaned = []
    for i, name in enumerate(names, start=1):
        column = clean_name(name or "", replacement)
        if not column and fill_missing:
            column = clean_name(f"COLUMN_{i}", replacement)
        cleaned.append(column)
    twice = sorted({c for c in cleaned if cleaned.count(c) > 1 or not c})
    if twice:
        raise LandingError(f"header has empty or repeated column names after cleaning: {twice}")
    return cleaned


def generic_header(width: int, prefix: str = "COLUMN_") -> list[str]:
    return [f"{prefix}{i}" for i in range(1, width + 1)]


@dataclass(frozen=True)
class Destination:
    """Names a table after the file a row came from."""

    pattern: str = ".*"
    group: int = 0
    prefix: str = ""
    suffix: str = ""

    def column(self, file_name: Column) -> Column:
        found = F.when(
            file_name.rlike(self.pattern), F.regexp_extract(file_name, self.pattern, self.group)
        ).otherwise(file_name)
        table = F.concat(F.lit(self.prefix), F.lower(found), F.lit(self.suffix))
        table = F.regexp_replace(table, r"\W", "_")
        table = F.regexp_replace(table, r"^_+|_+\z", "")
        return F.lower(F.regexp_replace(table, "_{2,}", "_"))


def decoded(metadata_name: str) -> Column:
    """A file name of the ``_metadata`` column as the file system spells it."""
    return F.url_decode(F.replace(F.col(metadata_name), F.lit("+"), F.lit("%2B")))


def without_dot_slash(name: Column) -> Column:
    return F.regexp_replace(name, r"^\./", "")


def file_stem(file_name: Column) -> Column:
    return F.regexp_replace(file_name, r"\.[^./\\]*\z", "")


def trailing_digits(file_name: Column) -> Column:
    """The digits a file stem ends with, or NULL."""
    return F.nullif(F.regexp_extract(file_stem(file_name), r"\d+\z", 0), F.lit(""))


def underscored_digits(file_name: Column) -> Column:
    """The first run of digits between underscores in a file stem, or NULL."""
    return F.nullif(F.regexp_extract(file_stem(file_name), r"_(\d+)_", 1), F.lit(""))


def name_token(file_name: Column, position: int, separator: str = "_") -> Column:
    """The n-th token of a file stem, counted from 1; NULL past the end."""
    parts = F.split(file_stem(file_name), java_literal(separator))
    return F.get(parts, F.lit(position - 1))


def attribute_text(attributes: Column) -> Column:
    """A map as ``k=v,k=v``."""
    pairs = F.transform(
        F.map_entries(attributes),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))),
    )
    return F.coalesce(F.array_join(pairs, ","), F.lit(""))
