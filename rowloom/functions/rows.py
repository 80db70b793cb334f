"""Python functions over rows, batches and groups, moved as Arrow batches.

Use these where built-in expressions cannot say it; the operators in
``rowloom.operators`` stay inside the JVM.  Functions are shipped with their
closures and must be pure: Spark may run them again after a lost task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rowloom.columns import column, free_name, name_list, require, require_columns
from rowloom.functions.outcome import Reporter, TaskOutcome

# Rows turned into Python objects at a time.  Bounds the memory of a worker
# when the texts in a batch are long; Arrow batches themselves are bounded by
# spark.sql.execution.arrow.maxRecordsPerBatch.
SLICE_ROWS = 2048

# Pieces of one group that are merged at a time, and groups a task holds.
MERGE_PIECES = 16
HELD_PIECES = 10_000


def as_struct_type(schema: str | T.StructType) -> T.StructType:
    """Accept a DDL string or a ``StructType``."""
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def plain_values(values: pa.Array) -> list:
    """A column as Python values; NULL becomes ``None``, a map a dict.

    Numbers without NULLs and texts go through NumPy, which is several times
    faster than converting value by value.
    """
    kind = values.type
    number = pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_boolean(kind)
    text = pa.types.is_string(kind) or pa.types.is_large_string(kind)
    if text or (number and values.null_count == 0):
        return values.to_numpy(zero_copy_only=False).tolist()
    return values.to_pylist(maps_as_pydicts="strict")


def to_dicts(names: Sequence[str], columns: Sequence[pa.Array]) -> Iterator[list[dict]]:
    """Cut Arrow columns of one length into bounded lists of row dicts."""
    for start in range(0, len(columns[0]) if columns else 0, SLICE_ROWS):
        values = [plain_values(part.slice(start, SLICE_ROWS)) for part in columns]
        yield [dict(zip(names, row)) for row in zip(*values)]


def from_dicts(rows: Sequence[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Build Arrow batches; a missing key is NULL, an unknown key an error."""
    known = set(schema.names)
    for row in rows:
        unknown = row.keys() - known
        if unknown:
            raise ValueError(f"result has columns outside its schema: {sorted(unknown)}")
    arrays = [
        pa.array([_entries(row.get(field.name), field.type) for row in rows], field.type)
        for field in schema
    ]
    if rows:
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def from_frame(frame: pd.DataFrame, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Build Arrow batches from a pandas frame, columns as in ``from_dicts``.

    NaN stays NaN in a float column of the frame that goes to a float column;
    elsewhere what pandas takes as missing is NULL.
    """
    unknown = set(frame.columns) - set(schema.names)
    if unknown:
        raise ValueError(f"result has columns outside its schema: {sorted(unknown)}")
    arrays = [
        _from_series(frame[field.name], field.type)
        if field.name in frame
        else pa.nulls(len(frame), field.type)
        for field in schema
    ]
    if len(frame):
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _from_series(values: pd.Series, kind: pa.DataType) -> pa.Array:
    keeps_nan = pa.types.is_floating(kind) and isinstance(values.dtype, np.dtype) and values.dtype.kind == "f"
    if keeps_nan:
        return pa.array(values.to_numpy(), kind)
    if pa.types.is_floating(kind) and values.dtype == object:
        return pa.array(values.tolist(), kind)
    return pa.array(values, kind, from_pandas=True)


def to_frame(batch: pa.RecordBatch) -> pd.DataFrame:
    """An Arrow batch as pandas; a float column with NULLs holds objects, so NULL and NaN stay apart."""
    frame = batch.to_pandas(integer_object_nulls=True)
    for name, values in zip(batch.schema.names, batch.columns):
        if pa.types.is_floating(values.type) and values.null_count:
            frame[name] = pd.Series(values.to_pylist(), dtype=object, index=frame.index)
    return frame


def _entries(value, data_type: pa.DataType):
    # Arrow builds a map column from pairs, Python code returns dicts.
    return list(value.items()) if pa.types.is_map(data_type) and isinstance(value, dict) else value


def filter_py(
    df: DataFrame,
    keep: Callable[[dict], object] | Column,
    columns: str | Sequence[str] | None = None,
) -> DataFrame:
    """keep the rows for which ``keep(row_dict)`` is truthy.

    A ``Column`` in place of the function stays in the JVM (preferred).

    Only ``columns`` (all, if not given) travel to Python and only a boolean
    comes back, so naming what the function reads keeps the scan narrow.
    """
    if isinstance(keep, Column):
        return df.filter(keep)
    names = name_list(columns)
    require_columns(df, names, "filter_py")

    inputs = names or df.columns

    def decide(batch: pa.Array) -> pa.Array:
        flags: list[bool] = []
        for rows in to_dicts(inputs, batch.flatten()):
            flags.extend(bool(keep(row)) for row in rows)
        return pa.array(flags, pa.bool_())

    # Evaluated by Arrow type, not by annotations: this module postpones those.
    decide.__annotations__ = {"batch": pa.Array, "return": pa.Array}
    test = F.arrow_udf(decide, T.BooleanType())
    return df.filter(test(F.struct(*[column(name) for name in inputs])))


def map_rows(
    df: DataFrame,
    function: Callable[[dict], dict],
    schema: str | T.StructType,
    columns: str | Sequence[str] | None = None,
) -> DataFrame:
    """M1: replace every row dict by ``function(row_dict)``.

    The output has exactly the columns of ``schema``: a key the function leaves
    out is NULL, a key outside the schema is an error.  ``columns`` limits what
    is read and sent to Python.
    """
    return task_batches(df, lambda rows: [function(row) for row in rows], schema, columns)


def task_batches(
    df: DataFrame,
    function: Callable[[list[dict]], object] | Callable[[pd.DataFrame], object],
    schema: str | T.StructType | None = None,
    columns: str | Sequence[str] | None = None,
    *,
    frames: bool = False,
) -> DataFrame:
    """K2: apply a row-independent function to lists of row dicts.

    The function may return a list of dicts, a pandas DataFrame, or ``None``
    to leave the batch as it is.  With ``frames=True`` it gets a pandas
    DataFrame, which is much faster for vectorised code; NaN and NULL stay what
    they are.  How rows fall into batches is not defined, so the result must
    not depend on it; per-key logic is ``task_groups``, whole dataset logic is
    ``task``, and functions that warn go through ``reported_batches``.
    """
    source, output = _batch_input(df, columns, schema)
    arrow_schema = to_arrow_schema(output)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, untouched in _inputs(batch, frames):
                yield from _outputs(function(rows), rows, untouched, arrow_schema)

    return source.mapInArrow(run, output)


def reported_batches(
    df: DataFrame,
    function: Callable[[list[dict], Reporter], object],
    schema: str | T.StructType | None = None,
    columns: str | Sequence[str] | None = None,
    *,
    warnings: Sequence[str] = (),
    errors: Sequence[str] = (),
    sums: Sequence[str] = (),
    frames: bool = False,
) -> TaskOutcome:
    """K2, K4: ``task_batches`` with a function that reports.

    ``function(rows, reporter)`` may call ``reporter.warn``, ``error`` and
    ``add`` with the texts and names declared here.  What it says leaves the
    worker beside the rows and is summed up while the first action computes
    them; a task that is repeated counts once.  Read it from the outcome.
    """
    source, output = _batch_input(df, columns, schema)
    plain = to_arrow_schema(output)
    is_row, reports = free_name("is_row", source), free_name("reports", source)
    wide = T.StructType([*output.fields]).add(is_row, "boolean").add(
        reports, T.ArrayType(T.DoubleType())
    )
    wide_schema = to_arrow_schema(wide)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        said = Reporter(warnings, errors, sums)
        for batch in batches:
            for rows, untouched in _inputs(batch, frames):
                said.clear()
                for part in _outputs(function(rows, said), rows, untouched, plain):
                    flags = [pa.array([True] * part.num_rows), pa.nulls(part.num_rows, pa.list_(pa.float64()))]
                    yield pa.RecordBatch.from_arrays([*part.columns, *flags], schema=wide_schema)
                if any(said.values()):
                    # A row of its own, as the function may have returned none.
                    nothing = [pa.nulls(1, field.type) for field in plain]
                    note = [pa.array([False]), pa.array([said.values()], pa.list_(pa.float64()))]
                    yield pa.RecordBatch.from_arrays([*nothing, *note], schema=wide_schema)

    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in wide])
    made = source.mapInArrow(run, nullable)
    shown = [column(field.name) for field in output]
    return TaskOutcome.of_reports(
        made, column(reports), column(is_row), shown, list(warnings), list(errors), list(sums)
    )


def _batch_input(df: DataFrame, columns, schema) -> tuple[DataFrame, T.StructType]:
    names = name_list(columns)
    require_columns(df, names, "task_batches")
    source = df.select(*[column(name) for name in names]) if names else df
    return source, source.schema if schema is None else as_struct_type(schema)


def _inputs(batch: pa.RecordBatch, frames: bool) -> Iterator[tuple[object, pa.RecordBatch | None]]:
    """What a batch function gets, and the batch that stands for it if it is whole."""
    if frames:
        yield to_frame(batch), batch
    else:
        for rows in to_dicts(batch.schema.names, batch.columns):
            yield rows, None


def _outputs(result, rows, untouched: pa.RecordBatch | None, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """What a batch function returned, as Arrow batches."""
    if result is None and untouched is not None:
        yield untouched
        return
    result = rows if result is None else result
    if isinstance(result, pd.DataFrame):
        yield from from_frame(result, schema)
    elif isinstance(result, list):
        yield from from_dicts(result, schema)
    else:
        raise TypeError(f"a batch function returns dicts or a pandas frame, not {type(result).__name__}")


def task(df: DataFrame, function: Callable[[DataFrame], DataFrame | None]) -> DataFrame:
    """K1: apply a function to the whole dataset, lazily.

    The function receives the DataFrame and returns another one (``None``
    passes the input through), so whole-dataset logic is planned and
    distributed by Spark instead of being handed a list of all rows.
    """
    result = function(df)
    if result is None:
        return df
    if not isinstance(result, DataFrame):
        raise TypeError(f"task: the function must return a DataFrame, not {type(result).__name__}")
    return result


def task_groups(
    df: DataFrame,
    keys: str | Sequence[str],
    function: Callable[[pd.DataFrame], pd.DataFrame],
    merge: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str | T.StructType,
    *,
    columns: str | Sequence[str] | None = None,
    tasks: int = MERGE_PIECES**3,
) -> DataFrame:
    """K3: a pandas function per group, for groups of any size.

    ``function`` gets a piece of one group (the group's rows inside one Arrow
    batch) and condenses it to rows of ``schema``, which must hold the keys.
    ``merge`` gets such rows of one group, put together from several pieces,
    and condenses them again in the same form; it must not matter how pieces
    are put together.  Derive final columns from the result with ordinary
    expressions.

    ``merge`` never gets more than ``MERGE_PIECES`` pieces at a time.  A task
    merges the pieces of its batches as it goes and sends one per key (more
    only when it holds more than ``HELD_PIECES`` of them).  Those of
    ``MERGE_PIECES`` tasks meet in one frame, their results in the next round,
    and so on: there are as many rounds as ``tasks`` input tasks need, and no
    frame grows with their number.  A wider input still gives the same result,
    with more pieces in the frames of the last round.
    """
    key_names = name_list(keys)
    require(key_names, "task_groups: needs at least one key")
    require_columns(df, key_names, "task_groups")
    output = as_struct_type(schema)
    missing = [name for name in key_names if name not in output.names]
    if missing:
        raise ValueError(f"task_groups: the schema lacks the keys {missing}")
    names = name_list(columns)
    source = df
    if names:
        wanted = [*key_names, *[name for name in names if name not in key_names]]
        source = df.select(*[column(name) for name in wanted])
    arrow_schema = to_arrow_schema(output)

    def condense(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[pd.DataFrame]] = {}
        for batch in batches:
            for key, piece in to_frame(batch).groupby(key_names, dropna=False, sort=False):
                key = tuple(None if pd.isna(part) else part for part in key)
                pieces = held.setdefault(key, [])
                pieces.append(function(piece.reset_index(drop=True)))
                if len(pieces) == MERGE_PIECES:
                    held[key] = [merge_pieces(pieces)]
            if len(held) > HELD_PIECES:
                yield from sent(held)
        yield from sent(held)

    def sent(held: dict[tuple, list[pd.DataFrame]]) -> Iterator[pa.RecordBatch]:
        for pieces in held.values():
            yield from from_frame(merge_pieces(pieces), arrow_schema)
        held.clear()

    def merge_pieces(pieces: Sequence[pd.DataFrame]) -> pd.DataFrame:
        """Put pieces together, a bounded number at a time."""
        whole = pieces[0]
        for start in range(1, len(pieces), MERGE_PIECES - 1):
            some = [whole, *pieces[start : start + MERGE_PIECES - 1]]
            whole = merge(pd.concat([p[output.names] for p in some], ignore_index=True))[output.names]
        return whole

    def combine(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        pieces = [piece for _, piece in frame.groupby(piece_name, sort=True)]
        whole = merge_pieces([piece[output.names].reset_index(drop=True) for piece in pieces])
        return whole.assign(**{piece_name: key[-1]})

    piece_name, salt_name = free_name("piece", source), free_name("salt", source)
    while {piece_name, salt_name} & set(output.names):
        piece_name, salt_name = "_" + piece_name, "_" + salt_name
    carried = T.StructType([*output.fields, T.StructField(piece_name, T.LongType())])
    merged = source.mapInArrow(condense, output).withColumn(piece_name, F.spark_partition_id().cast("long"))
    left = max(tasks, 1)
    while True:
        left = -(-left // MERGE_PIECES)
        # In the last round all that is left of a key meets.
        group = F.floor(column(piece_name) / MERGE_PIECES) if left > 1 else F.lit(0).cast("long")
        salted = merged.withColumn(salt_name, group)
        merged = salted.groupBy(*[column(name) for name in key_names], column(salt_name)).applyInPandas(combine, carried)
        if left == 1:
            return merged.drop(piece_name)
