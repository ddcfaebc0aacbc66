"""What several test modules use."""

from __future__ import annotations


def tuples(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
