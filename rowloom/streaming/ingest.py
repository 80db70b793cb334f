"""Incremental file ingestion (R2)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rowloom.columns import require, require_columns
from rowloom.operators.transforms import deduplicate


def ingest_new_files(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    sink: str | Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    format: str = "csv",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    options: Mapping[str, object] | None = None,
    max_files: int = 10_000,
    watermark: tuple[str, str] | None = None,
    unique: str | Sequence[str] | None = None,
) -> StreamingQuery:
    """R2: process the files that arrived since the last run, then stop.

    Call it whenever a file may have arrived; the ``checkpoint`` folder
    remembers what was taken, so nothing is read twice and a call without new
    files does nothing.  A backlog is cut into batches of ``max_files``, so an
    interrupted run resumes near where it was.

    CSV files have a header line that must name the columns of ``schema`` in its
    order, and a record that does not fit fails the run; ``options`` may say
    otherwise.

    ``unique`` names key columns of which each value comes through once, also
    when it arrives again in a later file or run.  It needs a ``watermark``, a
    timestamp column and a delay such as ``("ts", "2 days")``: the keys of that
    long are kept in the checkpoint, a row older than the watermark is late and
    dropped, so state is bounded by the delay and not by the history.  A NULL
    key is a value like others.

    ``transform`` may be made of row-wise operators (rename, drop, add, filter,
    replace, Python row functions).  ``sink`` is a folder, written as Parquet
    exactly once, or a function ``(batch_df, batch_id)``, in which every
    operator works; after a failure it may see a batch again under the same
    id.
    """
    require(path, "ingest_new_files: needs a path")
    require(checkpoint, "ingest_new_files: needs a checkpoint folder")
    reader = spark.readStream.format(format).schema(schema)
    if format == "csv":
        reader = reader.option("header", True).option("escape", '"').option("enforceSchema", False)
    if format != "parquet":
        reader = reader.option("mode", "FAILFAST")
    stream = (
        reader.option("maxFilesPerTrigger", max_files).options(**(options or {})).load(path)
    )
    if transform is not None:
        stream = transform(stream)
    if unique and not watermark:
        raise ValueError("ingest_new_files: unique needs a watermark, or its state would grow for ever")
    if watermark:
        require_columns(stream, [watermark[0]], "ingest_new_files")
        stream = stream.withWatermark(*watermark)
    if unique:
        stream = deduplicate(stream, unique)
    writer = stream.writeStream
    writer = (
        writer.foreachBatch(sink)
        if callable(sink)
        else writer.format("parquet").option("path", sink)
    )
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
