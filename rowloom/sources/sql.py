"""SQL text as a source, with run variables."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from rowloom.columns import require

_PLACEHOLDER = re.compile(r"\{\{\s*([\w.]+)\s*\}\}")

# Comments, quoted names, text literals in either quotes (with the type word before
# them) and bare placeholders.
_SQL_TOKEN = re.compile(
    r"--[^\n]*|/\*.*?\*/"
    r"|`(?:[^`]|``)*`"
    r"|(?:\b(?P<type>date|timestamp|timestamp_ntz)\s+)?(?P<raw>\br)?"
    r"(?:'(?P<text>(?:[^'\\]|\\.|'')*)'|\"(?P<double>(?:[^\"\\]|\\.|\"\")*)\")"
    r"|\{\{\s*(?P<bare>[\w.]+)\s*\}\}",
    re.DOTALL | re.IGNORECASE,
)


_SQL_COMMENT = re.compile(r"--[^\n]*|/\*.*?\*/", re.DOTALL)


def run_variables(
    ds: date | str | None = None,
    next_ds: date | str | None = None,
    ts: datetime | str | None = None,
    variables: Mapping[str, object] | None = None,
    params: Mapping[str, object] | None = None,
) -> dict[str, object]:
    """The values of one run, by the names templates use.

    ``ds`` (a date), ``next_ds`` (the day after, unless given), ``ts`` (an ISO
    timestamp; midnight of ``ds`` unless given), ``var.<key>`` and
    ``param.<key>``.
    """
    values: dict[str, object] = {}
    if ds is not None:
        day = date.fromisoformat(ds) if isinstance(ds, str) else ds
        values["ds"] = day
        values["next_ds"] = day + timedelta(days=1)
        values["ts"] = datetime(day.year, day.month, day.day).isoformat()
    if next_ds is not None:
        values["next_ds"] = date.fromisoformat(next_ds) if isinstance(next_ds, str) else next_ds
    if ts is not None:
        values["ts"] = ts.isoformat() if isinstance(ts, datetime) else ts
    values.update({f"var.{key}": value for key, value in (variables or {}).items()})
    values.update({f"param.{key}": value for key, value in (params or {}).items()})
    return values


def _lookup(values: Mapping[str, object], name: str) -> object:
    if name not in values:
        raise ValueError(f"unknown template variable {name!r}; known: {sorted(values)}")
    return values[name]


def render_text(template: str, values: Mapping[str, object]) -> str:
    """Fill ``{{ name }}`` in a path or url; dates as ``YYYY-MM-DD``."""
    return _PLACEHOLDER.sub(lambda found: str(_lookup(values, found.group(1))), template)


def run_query(
    spark: SparkSession,
    query: str,
    values: Mapping[str, object] | None = None,
    args: Mapping[str, object] | None = None,
    **frames: DataFrame,
) -> DataFrame:
    """A full SQL query over Spark tables, views and given DataFrames.

    ``{name}`` in the text stands for the DataFrame passed as ``name=``; other
    braces, as in patterns, are plain text.
    ``{{ name }}`` stands for a run variable (see ``run_variables``).  It
    becomes a typed parameter, never part of the SQL text, so partition pruning
    sees a literal and a value cannot change the statement.  Quotes around it
    are optional; inside a longer text literal, in single or double quotes, its
    text is spliced in.  In a quoted name or where quotes are not closed it is a
    ``ValueError``.
    ``args`` are further named parameters (``:name``).
    """
    require(query.strip(), "run_query: needs a query")
    bound = dict(args or {})

    def marker(name: str) -> str:
        key = "run_" + name.replace(".", "_")
        bound[key] = _lookup(values or {}, name)
        return f":{key}"

    def rewrite(found: re.Match) -> str:
        if found["bare"]:
            return marker(found["bare"])
        quote = "'" if found["double"] is None else '"'
        text = found["text"] if found["double"] is None else found["double"]
        if text is None or not _PLACEHOLDER.search(text):
            if text is None and _PLACEHOLDER.search(found[0]) and found[0].startswith("`"):
                raise ValueError(f"run variables cannot name columns: {found[0]}")
            return found[0]
        if found["raw"]:
            raise ValueError(f"run variables cannot stand in a raw text literal: {found[0]}")
        whole = _PLACEHOLDER.fullmatch(text.strip())
        if whole:
            value = marker(whole[1])
        else:
            # Odd pieces are variable names, even ones the text between them.
            pieces = _PLACEHOLDER.split(text)
            value = " || ".join(
                f"CAST({marker(piece)} AS STRING)" if index % 2 else f"{quote}{piece}{quote}"
                for index, piece in enumerate(pieces)
            )
            value = f"({value})"
        return f"CAST({value} AS {found['type']})" if found["type"] else value

    statement = _SQL_TOKEN.sub(rewrite, query)
    left = _SQL_COMMENT.sub("", statement)
    if any(f":{key}" not in statement for key in bound if key not in (args or {})) or _PLACEHOLDER.search(left):
        raise ValueError("run_query: a run variable stands where it cannot be read")
    if frames:
        # Spark formats the text; only the names of frames may be braces to it.
        names = "|".join(re.escape(name) for name in frames)
        pieces = re.split(r"(\{(?:" + names + r")\})", statement)
        pieces[::2] = [text.replace("{", "{{").replace("}", "}}") for text in pieces[::2]]
        statement = "".join(pieces)
    return spark.sql(statement, args=bound or None, **frames)
