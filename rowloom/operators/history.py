"""Backfill dates and row history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.columns import column, name_list, require, require_columns


def missing_run_dates(
    target: DataFrame,
    date_column: str,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """The dates between ``start`` and ``end`` (inclusive) without rows.

    Bounds that are not given are the first and last date present.  Only the
    date column of the target is read, and reduced to its distinct dates before
    the shuffle.  Output: ``run_date``.
    """
    require_columns(target, [date_column], "missing_run_dates")
    day = column(date_column).cast("date")
    first = F.min(day) if start is None else F.lit(str(start)).cast("date")
    last = F.max(day) if end is None else F.lit(str(end)).cast("date")
    if start is None or end is None:
        bounds = target.agg(first.alias("first"), last.alias("last"))
    else:
        bounds = target.sparkSession.range(1).select(first.alias("first"), last.alias("last"))
    ordered = bounds.filter("first <= last")
    expected = ordered.select(F.explode(F.sequence("first", "last")).alias("run_date"))
    present = target.select(day.alias("run_date")).distinct()
    return expected.join(present, "run_date", "left_anti")


def snapshot(
    history: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    as_of: datetime | date | str,
) -> DataFrame:
    """The row history after comparing it with the current ``source``.

    ``history`` has the columns of ``source`` plus ``valid_from`` and
    ``valid_to``; its open rows (``valid_to`` is NULL) hold each key once.  A
    key whose values changed is closed at ``as_of`` and opened anew; a new key
    is opened; a key missing from the source stays open.  Values are compared
    NULL-safely.  Other columns of ``history`` stay, NULL in rows opened now; an
    ``as_of`` before the start of an open row that it would close fails the
    job.  Repeated keys in the source are an error of the caller; one
    of the rows is used.

    Old and new rows meet by grouping, not by a join: one shuffle, rows of a
    key already brought together before it, and a NULL in a key equals NULL.
    """
    names = name_list(keys)
    require(names, "snapshot: needs keys")
    require_columns(source, names, "snapshot (source)")
    require_columns(history, [*source.columns, "valid_from", "valid_to"], "snapshot (history)")
    values = [name for name in source.columns if name not in names]
    moment_type = history.schema["valid_from"].dataType
    moment = F.lit(str(as_of)).cast(moment_type)
    layout = history.columns

    history = history.select(*[column(name) for name in layout])
    closed = history.filter(F.col("valid_to").isNotNull())
    state = T.StructType([history.schema[name] for name in layout])
    old_rows = history.filter(F.col("valid_to").isNull()).select(
        *[column(name) for name in names],
        F.struct(*[column(name) for name in layout]).alias("old"),
        F.lit(None).cast(state).alias("new"),
    )
    fields = [column(name).cast(history.schema[name].dataType).alias(name) for name in source.columns]
    made = {field.name: F.lit(None).cast(field.dataType) for field in history.schema}
    made |= {name: column(name) for name in source.columns}
    made |= {"valid_from": moment, "valid_to": F.lit(None).cast(moment_type)}
    new_rows = source.select(*fields).select(
        *[column(name) for name in names],
        F.lit(None).cast(state).alias("old"),
        F.struct(*[made[name].alias(name) for name in layout]).alias("new"),
    )
    pairs = (
        old_rows.unionByName(new_rows)
        .groupBy(*[column(name) for name in names])
        .agg(
            F.first("old", ignorenulls=True).alias("old"),
            F.first("new", ignorenulls=True).alias("new"),
        )
    )
    changed = F.lit(False)
    for name in values:
        changed = changed | ~F.col("old")[name].eqNullSafe(F.col("new")[name])
    early = F.raise_error(F.lit(f"snapshot: as_of {as_of} lies before the start of an open row"))
    end = F.when(F.col("old")["valid_from"] <= moment, moment).otherwise(early.cast(moment_type))
    ended = F.struct(
        *[(end if name == "valid_to" else F.col("old")[name]).alias(name) for name in layout]
    )
    outcome = (
        F.when(F.col("old").isNull(), F.array("new"))
        .when(F.col("new").isNull() | ~changed, F.array("old"))
        .otherwise(F.array(ended, F.col("new")))
    )
    return closed.unionByName(pairs.select(F.inline(outcome)))
