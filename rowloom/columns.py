"""Argument checks and column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """Reference a top-level column whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(stem: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, whatever its case."""
    taken = {name.lower() for frame in frames for name in frame.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def any_null(names: Iterable[str]) -> Column:
    """True when at least one of the columns is NULL."""
    return reduce(lambda a, b: a | b, [column(name).isNull() for name in names])


def expression(value: str | Column) -> Column:
    """Accept SQL text or a ready ``Column``."""
    return F.expr(value) if isinstance(value, str) else value


def name_list(value: str | Iterable[str] | None) -> list[str]:
    """One name, several names or none, as a list."""
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


def require(value, message: str) -> None:
    """Raise ``ValueError`` when a mandatory argument is missing or empty."""
    if value is None or (hasattr(value, "__len__") and len(value) == 0):
        raise ValueError(message)


def require_columns(df: DataFrame, names: Iterable[str], operator: str) -> None:
    """Raise ``ValueError`` naming every column that ``df`` does not have."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{operator}: no such column {missing}; the input has {df.columns}")


def require_unique_names(names: Iterable[str], operator: str) -> None:
    """Raise ``ValueError`` when an operator would produce two columns of one name.

    Case does not tell names apart, as in Spark's default settings.
    """
    seen: set[str] = set()
    for name in names:
        if name.lower() in seen:
            raise ValueError(f"{operator}: output would hold two columns named {name!r}")
        seen.add(name.lower())


def require_batch(df: DataFrame, operator: str, instead: str) -> None:
    """Raise ``ValueError`` when an operator cannot run on a stream."""
    if df.isStreaming:
        raise ValueError(f"{operator} does not run on a streaming DataFrame; {instead}")
