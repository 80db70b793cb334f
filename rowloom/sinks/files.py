"""File sinks: CSV, JSON, Parquet and XML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.columns import any_null, column, free_name, name_list, require, require_columns
from rowloom.operators.combine import key_set
from rowloom.operators.transforms import deduplicate
from rowloom.session import materialize, stages

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
SINK_FORMATS = ("csv", "json", "parquet", "xml")
#: About how large a text file may get that Spark cannot split, before compression if it is compressed,
#: and the bytes that a text or another value in it is taken to have.
WHOLE_FILE_BYTES, COMPRESSED_FILE_BYTES = 32 << 20, 256 << 20
TEXT_BYTES, VALUE_BYTES = 400, 20
#: Codecs whose files Spark can split, or that are none.
SPLIT_CODECS = ("", "none", "uncompressed", "bzip2")


def _row_bytes(name: str, kind: T.DataType) -> int:
    """About the bytes of one value with its tags; lists and maps are taken to have one element."""
    if isinstance(kind, T.ArrayType):
        return _row_bytes(name, kind.elementType)
    if isinstance(kind, T.StructType):
        inner = sum(_row_bytes(field.name, field.dataType) for field in kind)
    elif isinstance(kind, T.MapType):
        inner = _row_bytes("key", kind.valueType)
    else:
        inner = TEXT_BYTES if isinstance(kind, (T.StringType, T.BinaryType, T.VariantType)) else VALUE_BYTES
    return 2 * len(name.encode()) + len("<></>") + inner


def _whole_file_rows(df: DataFrame, format: str, codec: str, row_tag: str | None) -> int | None:
    """Rows of a file that Spark reads in one task, at most as many as the session allows; None for other files."""
    compressed = codec.lower() not in SPLIT_CODECS
    if format == "parquet" or not (compressed or format == "xml"):
        return None
    size = COMPRESSED_FILE_BYTES if compressed else WHOLE_FILE_BYTES
    rows = max(1, size // _row_bytes(row_tag or "", df.schema))
    allowed = int(df.sparkSession.conf.get("spark.sql.files.maxRecordsPerFile"))
    return min(rows, allowed) if allowed > 0 else rows


def write_file(
    df: DataFrame,
    path: str,
    format: str = "csv",
    compress: str = "",
    *,
    mode: str = "error",
    partition_by: str | Sequence[str] | None = None,
    rebalance: bool = True,
    row_tag: str | None = None,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """Write a directory of files, one or more per task, and pass the data on.

    CSV gets a header line, doubles quotes inside fields and keeps white space at
    their ends; text formats keep microseconds.  Reading a CSV turns empty text into NULL, unless both sides
    name another marker, as in ``options={"nullValue": "\\N"}``.
    ``compress`` is a codec such as ``gzip`` or ``snappy``.  ``mode`` is Spark's
    (error, append, overwrite, ignore); overwriting together with
    ``partition_by`` replaces only the partitions that occur in ``df``, which
    makes a repeated run harmless.  Rows bound for partition folders are first
    rebalanced by them, so that not every task writes a small file into every
    folder; adaptive execution splits a folder that gets a large share of the
    rows over several tasks.  Otherwise rows are written where they lie.
    Spark reads XML and compressed CSV and JSON (but bzip2) one file a task, so
    a task of many rows writes several such files.  Their rows follow from the
    columns, with texts taken to be of ``TEXT_BYTES``; for much longer texts, and
    for CSV fields with line breaks, set ``maxRecordsPerFile`` in ``options``.
    """
    require(path, "write_file: needs a path")
    if format not in SINK_FORMATS:
        raise ValueError(f"write_file: format must be one of {SINK_FORMATS}, not {format!r}")
    names = name_list(partition_by)
    require_columns(df, names, "write_file")
    rows = df
    if names and rebalance:
        rows = df.hint("rebalance", *[column(name) for name in names])
    writer = rows.write.format(format).mode(mode)
    if format == "csv":
        writer = writer.option("header", True).option("escape", '"')
        writer = writer.option("ignoreLeadingWhiteSpace", False)
        writer = writer.option("ignoreTrailingWhiteSpace", False)
    if format == "json":
        writer = writer.option("ignoreNullFields", False)
    if format == "xml":
        require(row_tag, "write_file: XML needs row_tag")
        writer = writer.option("rowTag", row_tag)
    if format != "parquet":
        writer = writer.option("timestampFormat", TIMESTAMP_FORMAT + "XXX")
        writer = writer.option("timestampNTZFormat", TIMESTAMP_FORMAT)
    if compress:
        writer = writer.option("compression", compress)
    given = {key.lower(): str(value) for key, value in (options or {}).items()}
    file_rows = _whole_file_rows(df, format, given.get("compression", given.get("codec", compress)), row_tag)
    if file_rows:
        writer = writer.option("maxRecordsPerFile", file_rows)
    if names:
        writer = writer.partitionBy(*names).option("partitionOverwriteMode", "dynamic")
    writer.options(**(options or {})).save(path)
    return df


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    order_by=None,
    *,
    stage: bool = False,
) -> DataFrame:
    """The rows of ``target`` after ``source`` was merged in by key.

    A source row replaces the target rows with its key, or is added.  Both sides
    have the same columns, else it is a ``ValueError``.  Several
    source rows with one key are reduced to the first by ``order_by`` (any one
    without it).  A NULL key matches nothing: such rows are all kept on both
    sides.  The target side is an anti join, which Spark may split when one key
    fills a large share of it; the source is reduced before its shuffle.

    The source is read twice, for its keys and for its rows.  One that gives
    other keys each time (random or sampled rows), or is dear to compute, wants
    ``stage=True``: it is then written once to the shared folder, where the
    copy stays until the ``stages`` block around the call ends.
    """
    names = name_list(keys)
    require(names, "upsert: needs keys")
    require_columns(target, names, "upsert (target)")
    require_columns(source, names, "upsert (source)")
    if set(source.columns) != set(target.columns):
        odd = sorted(set(source.columns) ^ set(target.columns))
        raise ValueError(f"upsert: columns on one side only: {odd}")
    keyed, unkeyed = source.filter(~any_null(names)), source.filter(any_null(names))
    changes = deduplicate(keyed, names, order_by).unionByName(unkeyed)
    if stage:
        changes = materialize(changes, "upsert")
    kept = target.join(key_set(changes if stage else source, names), names, "left_anti")
    columns = [column(name) for name in target.columns]
    return kept.select(*columns).unionByName(changes.select(*columns))


def upsert_table(
    source: DataFrame,
    path: str,
    keys: str | Sequence[str],
    partition_by: str | Sequence[str],
    order_by=None,
) -> None:
    """Merge ``source`` into the partitioned Parquet table at ``path``.

    Only partitions that occur in ``source`` are rewritten, and only the range
    between its smallest and largest partition value is read.  Source and table
    have the same columns (``ValueError`` otherwise); the table's types count.
    A partition value of empty text is NULL, as Spark stores both in one
    folder.  Rows with one key must lie in one partition, therefore the
    partition columns are part of the key.  The rewrite is staged and moved
    into place when the job commits; a lost executor leaves the table as it
    was.
    """
    names, partitions = name_list(keys), name_list(partition_by)
    require(partitions, "upsert_table: needs partition columns")
    outside = [name for name in partitions if name not in names]
    if outside:
        raise ValueError(f"upsert_table: partition columns {outside} must be part of the key")
    spark = source.sparkSession
    stored = spark.read.parquet(path)
    if set(stored.columns) != set(source.columns):
        odd = sorted(set(stored.columns) ^ set(source.columns))
        raise ValueError(f"upsert_table: columns on one side only: {odd}")
    # Folder names do not tell the types of partition columns, the source does.
    layout = T.StructType(
        [source.schema[f.name] if f.name in partitions else f for f in stored.schema]
    )
    with stages():
        changes = source.select(*[_as_stored(f, f.name in partitions) for f in layout])
        changes = materialize(changes, "changes")
        target = spark.read.schema(layout).parquet(path)
        touched = changes.select(*[column(name) for name in partitions]).distinct()
        touched = materialize(touched, "partitions")
        edges = touched.agg(*[f(column(n)) for n in partitions for f in (F.min, F.max, _nulls)])
        limits = edges.first()
        for place, name in enumerate(partitions):
            low, high, nulls = limits[3 * place : 3 * place + 3]
            inside = column(name).between(low, high) if low is not None else F.lit(False)
            target = target.filter(inside | column(name).isNull() if nulls else inside)
        inside = {name: free_name(f"touched_{i}", target) for i, name in enumerate(partitions)}
        same = [column(name).eqNullSafe(column(other)) for name, other in inside.items()]
        affected = target.join(
            touched.withColumnsRenamed(inside), reduce(lambda a, b: a & b, same), "left_semi"
        )
        merged = upsert(affected, changes, names, order_by)
        write_file(merged, path, "parquet", mode="overwrite", partition_by=partitions)


def _nulls(value: Column) -> Column:
    return F.coalesce(F.bool_or(value.isNull()), F.lit(False))


def _as_stored(field: T.StructField, is_partition: bool) -> Column:
    value = column(field.name).cast(field.dataType)
    if is_partition and isinstance(field.dataType, T.StringType):
        value = F.nullif(value, F.lit(""))
    return value.alias(field.name)
