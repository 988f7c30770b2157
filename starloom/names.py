"""Column-name helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Reference a column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(name: str, *taken: Iterable[str]) -> str:
    """``name``, or a variant of it that no column of ``taken`` has."""
    used = {c.lower() for columns in taken for c in columns}
    while name.lower() in used:
        name += "_"
    return name


def as_list(names: str | Iterable[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def as_pairs(on: str | Iterable[str] | Mapping[str, str]) -> dict[str, str]:
    """Normalise a join key to ``{left column: right column}``."""
    if isinstance(on, Mapping):
        return dict(on)
    return {name: name for name in as_list(on)}
