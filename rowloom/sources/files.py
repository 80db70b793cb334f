"""File sources: CSV, JSON, XML and Parquet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rowloom.columns import column, require

SOURCE_FORMATS = ("csv", "json", "xml", "parquet")


def read_file(
    spark: SparkSession,
    path: str | list[str],
    format: str = "csv",
    schema: str | T.StructType | None = None,
    *,
    infer_schema: bool = False,
    row_tag: str | None = None,
    multi_line: bool = False,
    malformed: str = "fail",
    bad_records: str | None = None,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """Read files, directories or globs.

    CSV has a header line, and the columns of a ``schema`` are found by their
    names there, in any order; one that is missing is a ``ValueError``, others
    are left out.  All files must have the header of the first one.  White
    space at the ends of texts is kept.  A record that does not fit fails the
    job; with ``malformed="null"`` its values become NULL, and with
    ``bad_records`` its text is kept in that column beside them.  Pass a ``schema`` for anything large: without one a
    CSV yields text columns, ``infer_schema=True`` and JSON or XML cost an
    extra pass over the data, and types may change from day to day.
    ``multi_line`` is for a JSON array document (or CSV fields with line
    breaks); such files cannot be split.  XML needs ``row_tag``; one file is
    read by one task, so let large data come in several (``write_file`` does).
    """
    require(path, "read_file: needs a path")
    if format not in SOURCE_FORMATS:
        raise ValueError(f"read_file: format must be one of {SOURCE_FORMATS}, not {format!r}")
    if malformed not in ("fail", "null"):
        raise ValueError(f"read_file: malformed must be 'fail' or 'null', not {malformed!r}")
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if bad_records:
        require(wanted, "read_file: bad_records needs a schema")
        wanted = T.StructType([*wanted.fields, T.StructField(bad_records, T.StringType())])
    reader = spark.read.format(format)
    given = {key.lower(): value for key, value in (options or {}).items()}
    order = wanted
    if format == "csv":
        reader = reader.option("header", True).option("escape", '"')
        if wanted is None:
            reader = reader.option("inferSchema", infer_schema)
        elif str(given.get("header", True)).lower() == "true":
            header = reader.options(**(options or {})).load(path).columns
            if header:
                order = _in_header_order(wanted, header, bad_records)
                reader = reader.option("enforceSchema", False)
    if order is not None:
        reader = reader.schema(order)
    if format != "parquet":
        reader = reader.option("mode", "FAILFAST" if malformed == "fail" and not bad_records else "PERMISSIVE")
        if bad_records:
            reader = reader.option("columnNameOfCorruptRecord", bad_records)
    if format == "xml":
        require(row_tag, "read_file: XML needs row_tag")
        reader = reader.option("rowTag", row_tag).option("ignoreSurroundingSpaces", False)
    if multi_line:
        reader = reader.option("multiLine", True)
    found = reader.options(**(options or {})).load(path)
    return found if order is wanted else found.select(*[column(f.name) for f in wanted])


def _in_header_order(wanted: T.StructType, header: list[str], extra: str | None) -> T.StructType:
    """The fields as the files have them; columns that nobody asked for are text."""
    by_name = {field.name.lower(): field for field in wanted}
    missing = [f.name for f in wanted if f.name != extra and f.name.lower() not in map(str.lower, header)]
    if missing:
        raise ValueError(f"read_file: no such column {missing}; the header has {header}")
    fields = [by_name.get(name.lower(), T.StructField(name, T.StringType())) for name in header]
    return T.StructType([*fields, *[f for f in wanted if f.name == extra]])


def seed_table(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    target: str,
    mode: str = "overwrite",
) -> DataFrame:
    """Load a CSV with a declared schema into a Parquet table and return it."""
    require(target, "seed_table: needs a target path")
    read_file(spark, path, "csv", schema).write.mode(mode).parquet(target)
    return spark.read.schema(schema).parquet(target)
