"""Sources written in Python."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rowloom.functions.rows import SLICE_ROWS, as_struct_type, from_dicts, to_dicts


def custom_source(
    spark: SparkSession,
    partitions: DataFrame | Sequence,
    read: Callable[[object], Iterable[dict]],
    schema: str | T.StructType,
    *,
    parallelism: int | None = None,
) -> DataFrame:
    """Rows produced by a Python function, one call per partition spec.

    ``partitions`` says how to cut the source: a list of specs (file names,
    date ranges, shards), or a DataFrame whose rows, as dicts, are the specs.
    They are spread over ``parallelism`` tasks (if not given, a task per spec
    of a list, ``spark.sql.shuffle.partitions`` for a DataFrame): a fixed number, because
    adaptive execution would see tiny specs and read them all in one task.
    ``read(spec)`` yields row dicts; they leave in bounded batches, so a spec
    may be larger than memory.  Unlike inference from the first row, the
    declared schema also holds for a source without rows.
    """
    output = as_struct_type(schema)
    arrow_schema = to_arrow_schema(output)

    def rows_of(spec) -> Iterator[pa.RecordBatch]:
        rows = iter(read(spec))
        while chunk := list(islice(rows, SLICE_ROWS)):
            yield from from_dicts(chunk, arrow_schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for specs in to_dicts(batch.schema.names, batch.columns):
                for spec in specs:
                    yield from rows_of(spec)

    def run_pickled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for spec in batch.column(0).to_pylist():
                yield from rows_of(pickle.loads(spec))

    if isinstance(partitions, DataFrame):
        tasks = parallelism or int(spark.conf.get("spark.sql.shuffle.partitions"))
        return partitions.repartition(tasks).mapInArrow(run, output)

    specs = list(partitions)
    if not specs:
        return spark.createDataFrame([], output)

    # Each task gets its own specs only, as data.
    tasks = min(parallelism or len(specs), len(specs))
    rows = [(number % tasks, pickle.dumps(spec)) for number, spec in enumerate(specs)]
    dealt = spark.createDataFrame(rows, "task int, spec binary").repartitionByRange(tasks, "task")
    return dealt.select("spec").mapInArrow(run_pickled, output)
