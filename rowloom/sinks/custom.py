"""Sinks written in Python."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from rowloom.functions.rows import to_dicts


def run_sink(df: DataFrame, function: Callable[[list[dict]], object]) -> None:
    """Call ``function`` with bounded lists of row dicts on the executors."""

    def consume(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in to_dicts(batch.schema.names, batch.columns):
                function(rows)
        return
        yield

    df.mapInArrow(consume, "done boolean").write.format("noop").mode("overwrite").save()


def custom_sink(df: DataFrame, function: Callable[[list[dict]], object]) -> DataFrame:
    """Give all rows to a Python function, in batches, and pass the data on.

    What the function returns is ignored; an exception fails the job.  It runs
    at least once per batch, so it should tolerate repeats.
    """
    run_sink(df, function)
    return df
