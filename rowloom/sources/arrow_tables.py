"""Folders of Arrow files as a Spark data source, for reading and writing.

``df.write.format("arrow_table").mode("append").save(path)`` after
``register_arrow_tables(spark)``, or ``write_arrow_table(df, path, keys)`` for
files of ranges, and ``read_arrow_table(spark, path, ...)``.

Writing has two phases.  Each task writes one file under a name of its own and
reports it with its row count and the bounds of its columns.  When all have
reported, the driver puts the list into one manifest, in a single move: a
reader sees what manifests list, so an append or an overwrite is visible whole
or not at all, and exactly once although tasks repeat.  What lost attempts
leave behind is removed then, or when the job is aborted; a task that is still
running at an abort may leave a file that no manifest lists, for ``tidy_arrow_table``.

Reading plans from the manifests alone.  A file whose bounds exclude a
condition is never opened, and only the columns asked for leave a file; files
go to partitions of about equal bytes.  Conditions are given to
``read_arrow_table`` and not taken from later filters: Spark 4.1 keeps what
``pushFilters`` stored with the loaded frame, so a second scan of the frame
would skip the files of the first one's filters and lose rows.
"""

from __future__ import annotations

import json
import math
import operator
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from rowloom.columns import column, free_name, name_list, require, require_columns

MANIFEST, DRAFT, ENDING = "_manifest-", "_draft-", ".arrow"
#: Bytes of files that one partition reads.
PARTITION_BYTES = 128 << 20
#: Rows of one record batch handed to Spark.
BATCH_ROWS = 65_536
#: Rows of about one file of a table written in ranges.
FILE_ROWS = 500_000
#: Bounds are kept for these types, and for texts up to this many characters.
BOUND_CHARS = 64


def open_folder(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of an address and the path in it."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return pyarrow.fs.LocalFileSystem(), parts.path
    return pyarrow.fs.FileSystem.from_uri(uri)


def column_bounds(batches: Sequence[pa.RecordBatch]) -> dict[str, list]:
    """[least, greatest] of the columns that conditions can use; both None for a column of NULLs."""
    table, bounds = pa.Table.from_batches(batches), {}
    for field in table.schema:
        kind, values = field.type, table.column(field.name)
        number = pa.types.is_integer(kind) or pa.types.is_boolean(kind)
        text = pa.types.is_string(kind) or pa.types.is_large_string(kind)
        if not (number or text):
            continue
        ends = pc.min_max(values)
        low, high = ends["min"].as_py(), ends["max"].as_py()
        # A long text is no bound, so that manifests stay small.
        if text and max(len(low or ""), len(high or "")) > BOUND_CHARS:
            continue
        bounds[field.name] = [low, high]
    return bounds


def joined_bounds(parts: Iterable[dict[str, list]]) -> dict[str, list]:
    """The bounds of several pieces; a column without bounds in one has none."""
    whole: dict[str, list] | None = None
    for bounds in parts:
        if whole is None:
            whole = dict(bounds)
            continue
        both = {}
        for name in whole.keys() & bounds.keys():
            lows, highs = ([v for v in ends if v is not None] for ends in zip(whole[name], bounds[name], strict=True))
            both[name] = [min(lows, default=None), max(highs, default=None)]
        whole = both
    return whole or {}


#: What a condition may say, and whether a file with bounds [low, high] can satisfy it.
CONDITIONS = {
    "=": lambda low, high, value: low <= value <= high,
    "<": lambda low, high, value: low < value,
    "<=": lambda low, high, value: low <= value,
    ">": lambda low, high, value: high > value,
    ">=": lambda low, high, value: high >= value,
    "in": lambda low, high, value: any(low <= v <= high for v in value),
}
TESTS = {"=": operator.eq, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
Condition = tuple[str, str, object]


def may_hold(bounds: dict[str, list], where: Sequence[Condition]) -> bool:
    """Whether a file with these bounds can have a row that meets all conditions."""
    for name, test, value in where:
        if name not in bounds:
            continue
        low, high = bounds[name]
        # A column of NULLs meets none.
        if low is None or not CONDITIONS[test](low, high, value):
            return False
    return True


def manifests(path: str) -> list[tuple[int, str]]:
    """Number and path of each manifest, in order."""
    system, folder = open_folder(path)
    found = system.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True))
    names = [(info.base_name, info.path) for info in found if info.base_name.startswith(MANIFEST)]
    return [(int(name.removeprefix(MANIFEST).split("-")[0]), where) for name, where in sorted(names)]


def listed_files(path: str) -> tuple[list[dict], str | None]:
    """The files of the table, and its schema as JSON."""
    system, _ = open_folder(path)
    files, schema = [], None
    for _, where in manifests(path):
        with system.open_input_stream(where) as stream:
            manifest = json.loads(stream.read())
        files = manifest["files"] if manifest["replaces"] else files + manifest["files"]
        schema = manifest["schema"]
    return files, schema


@dataclass
class FilesPartition(InputPartition):
    """Names of the files that one task reads."""

    names: list[str]


class ArrowTableReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, where: Sequence[Condition], limit: int):
        self.path, self.schema, self.where, self.limit = path, schema, where, limit

    def partitions(self) -> Sequence[InputPartition]:
        parts: list[list[str]] = []
        held = self.limit
        for file in listed_files(self.path)[0]:
            if not may_hold(file["bounds"], self.where):
                continue
            if held + file["bytes"] > self.limit:
                parts.append([])
                held = 0
            parts[-1].append(file["name"])
            held += file["bytes"]
        return [FilesPartition(names) for names in parts or [[]]]

    def read(self, partition: FilesPartition) -> Iterator[pa.RecordBatch]:
        system, folder = open_folder(self.path)
        wanted = to_arrow_schema(self.schema)
        for name in partition.names:
            with system.open_input_file(f"{folder}/{name}") as file:
                places = [pyarrow.ipc.open_file(file).schema.get_field_index(c) for c in self.schema.names]
                only = pyarrow.ipc.IpcReadOptions(included_fields=sorted(p for p in places if p >= 0))
                reader = pyarrow.ipc.open_file(file, options=only)
                for number in range(reader.num_record_batches):
                    batch = reader.get_batch(number)
                    columns = [
                        batch.column(f.name).cast(f.type) if f.name in batch.schema.names else pa.nulls(batch.num_rows, f.type)
                        for f in wanted
                    ]
                    whole = pa.RecordBatch.from_arrays(columns, schema=wanted)
                    for start in range(0, batch.num_rows, BATCH_ROWS):
                        yield whole.slice(start, BATCH_ROWS)


@dataclass
class FileWritten(WriterCommitMessage):
    """What a task says of its file; no file for a task without rows."""

    file: dict | None


class ArrowTableWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema, overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> FileWritten:
        context = TaskContext.get()
        system, folder = open_folder(self.path)
        system.create_dir(folder, recursive=True)
        name = f"part-{self.job}-{context.partitionId()}-{context.taskAttemptId()}{ENDING}"
        path, rows, bounds, writer, stream = f"{folder}/{name}", 0, [], None, None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    stream = system.open_output_stream(path)
                    writer = pyarrow.ipc.new_file(stream, batch.schema)
                writer.write_batch(batch)
                rows += batch.num_rows
                bounds.append(column_bounds([batch]))
                if len(bounds) > 100:
                    bounds = [joined_bounds(bounds)]
        finally:
            if writer is not None:
                writer.close()
                stream.close()
        if writer is None:
            return FileWritten(None)
        size = system.get_file_info(path).size
        return FileWritten({"name": name, "rows": rows, "bytes": size, "bounds": joined_bounds(bounds)})

    def _own_files(self, system, folder: str) -> list[str]:
        found = system.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True))
        return [info.path for info in found if info.base_name.startswith(f"part-{self.job}-")]

    def commit(self, messages: list[FileWritten | None]) -> None:
        system, folder = open_folder(self.path)
        system.create_dir(folder, recursive=True)
        files = [message.file for message in messages if message is not None and message.file]
        older, replaced = manifests(self.path), listed_files(self.path)[0]
        draft = f"{folder}/{DRAFT}{self.job}"
        manifest = {"schema": self.schema.json(), "replaces": self.overwrite, "files": files}
        with system.open_output_stream(draft) as stream:
            stream.write(json.dumps(manifest).encode())
        number = older[-1][0] + 1 if older else 0
        system.move(draft, f"{folder}/{MANIFEST}{number:08d}-{self.job}.json")
        # From here on the table is the new one; what nobody reads any more goes.
        gone = {*self._own_files(system, folder)} - {f"{folder}/{file['name']}" for file in files}
        if self.overwrite:
            gone |= {f"{folder}/{file['name']}" for file in replaced} | {where for _, where in older}
        for where in sorted(gone):
            system.delete_file(where)

    def abort(self, messages: list[FileWritten | None]) -> None:
        system, folder = open_folder(self.path)
        for path in self._own_files(system, folder):
            system.delete_file(path)


class ArrowTables(DataSource):
    """The format ``arrow_table`` with the options ``path``, ``columns``, ``where`` (JSON) and ``partition_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "arrow_table"

    def _path(self) -> str:
        path = self.options.get("path")
        if not path:
            raise ValueError("arrow_table: needs a path")
        return path.rstrip("/")

    def schema(self) -> T.StructType:
        _, text = listed_files(self._path())
        if text is None:
            raise ValueError(f"arrow_table: no table at {self._path()}")
        whole = T.StructType.fromJson(json.loads(text))
        wanted = json.loads(self.options.get("columns", "null"))
        if wanted is None:
            return whole
        missing = [name for name in wanted if name not in whole.names]
        if missing:
            raise ValueError(f"arrow_table: no such column {missing}; the table has {whole.names}")
        return T.StructType([whole[name] for name in wanted])

    def reader(self, schema: T.StructType) -> ArrowTableReader:
        limit = int(self.options.get("partition_bytes", PARTITION_BYTES))
        return ArrowTableReader(self._path(), schema, json.loads(self.options.get("where", "[]")), limit)

    def writer(self, schema: T.StructType, overwrite: bool) -> ArrowTableWriter:
        return ArrowTableWriter(self._path(), schema, overwrite)


def tidy_arrow_table(path: str, hours: float = 24) -> int:
    """Remove files that no manifest lists and that are older than any running write; return their number."""
    system, folder = open_folder(path.rstrip("/"))
    known = {file["name"] for file in listed_files(path.rstrip("/"))[0]}
    before = datetime.now(UTC) - timedelta(hours=hours)
    gone = [
        info.path
        for info in system.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True))
        if info.base_name.startswith(("part-", DRAFT)) and info.base_name not in known and info.mtime < before
    ]
    for where in gone:
        system.delete_file(where)
    return len(gone)


def register_arrow_tables(spark: SparkSession) -> None:
    """Make the format ``arrow_table`` known to a session."""
    spark.dataSource.register(ArrowTables)


def write_arrow_table(
    df: DataFrame,
    path: str,
    keys: str | Sequence[str],
    mode: str = "append",
    file_rows: int = FILE_ROWS,
    least_files: int = 1,
) -> None:
    """Write files of ranges of ``keys``, so that conditions on these leave most of them unopened.

    The rows are counted first, and there are as many ranges as they fill files
    of about ``file_rows`` (say fewer where rows are long), ``least_files`` at
    least: more rows make more tasks and files, not larger ones.  As in ``sort``,
    the input partition breaks ties, so a key with many rows is spread over
    several files.  ``df`` is evaluated for the count, for the sample that cuts
    the ranges and for the write; pass ``materialize(df)`` where it is expensive.
    """
    names = name_list(keys)
    require(names, "write_arrow_table: needs at least one key")
    require_columns(df, names, "write_arrow_table")
    register_arrow_tables(df.sparkSession)
    ranges = max(least_files, math.ceil(df.count() / file_rows))
    tie = free_name("tie", df)
    dealt = df.withColumn(tie, F.spark_partition_id()).repartitionByRange(ranges, *[column(name) for name in names], column(tie))
    dealt.drop(tie).write.format("arrow_table").mode(mode).save(path)


def read_arrow_table(
    spark: SparkSession,
    path: str,
    columns: str | Iterable[str] | None = None,
    where: Sequence[Condition] = (),
    partition_bytes: int = PARTITION_BYTES,
) -> DataFrame:
    """The rows of an Arrow table that meet all conditions.

    ``where`` holds (column, test, value) with the tests ``=``, ``<``, ``<=``,
    ``>``, ``>=`` and ``in``; NULL meets none.  Files that cannot have such a
    row are not opened.  Without ``columns`` all are read.
    """
    for _, test, value in where:
        if test not in CONDITIONS or value is None:
            raise ValueError(f"read_arrow_table: a condition is a column, one of {sorted(CONDITIONS)} and a value")
    wanted = name_list(columns)
    needed = list(dict.fromkeys([*wanted, *(name for name, _, _ in where)]))
    register_arrow_tables(spark)
    reader = spark.read.format("arrow_table").option("where", json.dumps([list(c) for c in where])).option("partition_bytes", partition_bytes)
    rows = (reader.option("columns", json.dumps(needed)) if wanted else reader).load(path)
    require_columns(rows, needed, "read_arrow_table")
    for name, test, value in where:
        met = column(name).isin(list(value)) if test == "in" else TESTS[test](column(name), F.lit(value))
        rows = rows.where(met)
    return rows.select(*[column(name) for name in wanted]) if wanted else rows
