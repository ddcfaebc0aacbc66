"""Delimited text: dialects, and a record splitter for what Spark's CSV cannot read."""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.batch import LandingError

# What each preset sets. Quotes inside a quoted cell are doubled; with an
# escape character they may be escaped instead. Presets whose writers quote every
# non-null value keep a quoted empty cell as '' even where '' means null.
PRESETS = {
    "DEFAULT": {"sep": ",", "quote": '"'},
    "RFC4180": {"sep": ",", "quote": '"'},
    "EXCEL": {"sep": ",", "quote": '"'},
    "MYSQL": {"sep": "\t", "quote": None, "escape": "\\"},
    "TDF": {"sep": "\t", "quote": '"'},
    "POSTGRES_CSV": {"sep": ",", "quote": '"', "keep_quoted_empty": True},
    "POSTGRES_TEXT": {"sep": "\t", "quote": '"', "escape": "\\", "keep_quoted_empty": True},
}
ESCAPES = {"r": "\r", "n": "\n", "t": "\t", "b": "\b", "f": "\f"}


@dataclass(frozen=True)
class Dialect:
    sep: str = ","
    quote: str | None = '"'
    escape: str | None = None
    comment: str | None = None
    null: str | None = ""
    skip_blank: bool = True
    trim: bool = False
    keep_quoted_empty: bool = False

    @property
    def spark_reads_it(self) -> bool:
        """Whether Spark's CSV source gives the same cells as ``records``."""
        return self.skip_blank and self.escape is None

    def spark_options(self) -> dict[str, str]:
        options = {"sep": self.sep, "quote": self.quote or "", "nullValue": ""}
        if self.quote:
            options["escape"] = self.quote
        for side in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
            options[side] = str(self.trim).lower()
        if self.comment:
            options["comment"] = self.comment
        if self.keep_quoted_empty:
            options["emptyValue"] = QUOTED_EMPTY
        return options

    def spark_cell(self, cell: Column) -> Column:
        """Undo what Spark's nullValue="" cannot express."""
        if self.keep_quoted_empty:
            cell = F.when(cell == F.lit(QUOTED_EMPTY), F.lit("")).otherwise(cell)
        if self.null != "":
            cell = F.coalesce(cell, F.lit(""))
            if self.null is not None:
                cell = F.nullif(cell, F.lit(self.null))
        return cell

    def closed_line(self) -> str:
        """A pattern for lines that no cell continues past and that no reader skips.

        When every line of a file matches, the file can be cut at any line end.
        """
        blank_or_text = r"(?:|.*\S.*)"
        if not self.quote:
            return rf"^{blank_or_text}$"
        q, sep = java_char(self.quote), "".join(java_char(c) for c in self.sep)
        cell = rf"(?:{q}(?:[^{q}]|{q}{q})*+{q}(?={sep}|$)|(?!{q})(?:(?!{sep}).)*+)"
        return rf"^(?={blank_or_text}$){cell}(?:{sep}{cell})*+$"


QUOTED_EMPTY = "\u0001"


def java_char(char: str) -> str:
    return "\\x{%x}" % ord(char)


def dialect(
    preset: str = "DEFAULT",
    *,
    delimiter: str | None = None,
    escape: str | None = None,
    quote: str | None = None,
    null_string: str | None = "",
    comment: str | None = None,
    ignore_empty_lines: bool = True,
    ignore_surrounding_spaces: bool = False,
) -> Dialect:
    """A preset with overrides; an empty escape, quote or comment unsets the character.

    The last three settings always override the preset, and an empty cell is NULL unless
    ``null_string`` says otherwise. Records end at any of the usual line ends.
    """
    if preset not in PRESETS:
        raise LandingError(f"unknown delimiter format {preset!r}; known: {sorted(PRESETS)}")
    made = Dialect(**PRESETS[preset])
    if delimiter is not None:
        made = replace(made, sep=delimiter)
    for field, given in (("escape", escape), ("quote", quote), ("comment", comment)):
        if given is not None:
            made = replace(made, **{field: given[:1] or None})
    if made.escape and made.escape == made.quote:
        made = replace(made, escape=None)
    return replace(
        made,
        null=null_string,
        skip_blank=ignore_empty_lines,
        trim=ignore_surrounding_spaces,
    )


def text_lines(stream) -> Iterable[str]:
    """The lines of a byte stream with their ends, as ``records`` wants them."""
    return io.TextIOWrapper(stream, encoding="utf-8", errors="replace", newline="")


def records(lines: Iterable[str], d: Dialect) -> Iterator[tuple[list[str | None], str]]:
    """``(cells, text with its line end)`` of every record."""
    taken: list[str] = []

    def remember() -> Iterator[str]:
        for line in lines:
            taken.append(line)
            yield line

    plain = len(d.sep) == 1 and not (d.escape or d.comment or d.trim or d.keep_quoted_empty)
    if plain:
        csv.field_size_limit(sys.maxsize)
        rows = csv.reader(
            remember(),
            delimiter=d.sep,
            quotechar=d.quote,
            quoting=csv.QUOTE_MINIMAL if d.quote else csv.QUOTE_NONE,
        )
    else:
        rows = split_records(remember(), d)
    for cells in rows:
        text = "".join(taken)
        taken.clear()
        if cells is None or (d.skip_blank and not text.rstrip("\r\n")):
            continue
        yield [cell_value(c, d) for c in cells or [""]], text


def cell_value(cell: str, d: Dialect) -> str | None:
    if cell == QUOTED_EMPTY and d.keep_quoted_empty:
        return ""
    return None if cell == d.null else cell


def split_records(lines: Iterator[str], d: Dialect) -> Iterator[list[str] | None]:
    """Split records of any dialect; a cell may run over several lines, a comment is None."""
    special = [re.escape(c) for c in (d.sep, d.quote, d.escape, "\r\n", "\r", "\n") if c]
    token = re.compile("|".join(special))
    marks = [c for c in (d.quote, d.escape) if c]
    for line in lines:
        if d.comment and line.startswith(d.comment):
            yield None
            continue
        if not any(mark in line for mark in marks):
            parts = line.rstrip("\r\n").split(d.sep)
            yield [part.strip() for part in parts] if d.trim else parts
            continue
        cells, cell, inside, was_quoted, at = [], "", False, False, 0

        def finish() -> str:
            if was_quoted:
                return cell if cell or not d.keep_quoted_empty else QUOTED_EMPTY
            return cell.strip() if d.trim else cell

        while True:
            hit = token.search(line, at)
            piece = line[at : hit.start() if hit else len(line)]
            if piece.strip() or not (d.trim and was_quoted and not inside):
                cell += piece
            if hit is None:
                following = next(lines, None) if inside else None
                if following is None:
                    break
                line, at = following, 0
                continue
            at, mark = hit.end(), hit.group()
            if d.escape and mark == d.escape:
                if at == len(line):
                    cell += mark
                    continue
                char = "\r\n" if line.startswith("\r\n", at) else line[at]
                at += len(char)
                if char in ESCAPES:
                    cell += ESCAPES[char]
                elif char in "\r\n\t\b\f" or char in (d.sep, d.escape, d.quote, d.comment):
                    cell += char
                    if at == len(line) and char in "\r\n":
                        line, at = next(lines, ""), 0
                elif d.sep.startswith(char) and line.startswith(d.sep, at - 1):
                    cell += d.sep
                    at += len(d.sep) - 1
                else:
                    cell += mark + char
            elif inside:
                if mark != d.quote:
                    cell += mark
                elif line.startswith(d.quote, at):
                    cell += mark
                    at += 1
                else:
                    inside = False
            elif mark == d.quote:
                if was_quoted or (cell.strip() if d.trim else cell):
                    cell += mark
                else:
                    cell, inside, was_quoted = "", True, True
            elif mark == d.sep:
                cells.append(finish())
                cell, was_quoted = "", False
            else:
                break
        cells.append(finish())
        yield cells
