"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Collection

from tenurelens.sources.tables import cut_lineage as cut
from tenurelens.sources.tables import shared_folder

__all__ = ["aside", "cut", "shared_folder", "unused"]


def unused(columns: Collection[str], stem: str) -> str:
    """A column name that a table does not have, in any case."""
    taken = {c.lower() for c in columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def aside(columns: Collection[str], names: Collection[str]) -> dict[str, str]:
    """Other names for the columns that an operator would take for its own: old to new."""
    out: dict[str, str] = {}
    for c in columns:
        if c.lower() in {n.lower() for n in names}:
            out[c] = unused([*columns, *out.values()], c)
    return out
