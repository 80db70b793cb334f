"""JDBC sinks and database-to-database copies."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from rowloom.columns import name_list, require, require_columns
from rowloom.operators.transforms import deduplicate
from rowloom.sources.database import read_db

DB_MODES = ("append", "overwrite", "upsert")

# Statement families for update-or-insert.
UPSERT_DIALECTS = ("merge", "conflict", "duplicate")


def upsert_statement(
    table: str,
    staging: str,
    keys: Sequence[str],
    columns: Sequence[str],
    dialect: str = "merge",
) -> str:
    """Write the statement that merges a staging table into its target.

    ``merge`` is standard SQL, ``conflict`` the form of PostgreSQL and SQLite,
    ``duplicate`` that of MySQL.  The last two rely on a unique index over the
    keys.
    """
    if dialect not in UPSERT_DIALECTS:
        raise ValueError(f"upsert_statement: dialect must be one of {UPSERT_DIALECTS}")
    mark = "`" if dialect == "duplicate" else '"'

    def quoted(name: str) -> str:
        return mark + name.replace(mark, mark * 2) + mark

    names = ", ".join(quoted(name) for name in columns)
    others = [name for name in columns if name not in keys]
    if dialect == "merge":
        match = " AND ".join(f"t.{quoted(key)} = s.{quoted(key)}" for key in keys)
        update = ", ".join(f"{quoted(name)} = s.{quoted(name)}" for name in others)
        values = ", ".join(f"s.{quoted(name)}" for name in columns)
        changed = f" WHEN MATCHED THEN UPDATE SET {update}" if others else ""
        return (
            f"MERGE INTO {table} t USING {staging} s ON {match}{changed}"
            f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
        )
    insert = f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}"
    if dialect == "conflict":
        target = ", ".join(quoted(key) for key in keys)
        update = ", ".join(f"{quoted(name)} = excluded.{quoted(name)}" for name in others)
        action = f"DO UPDATE SET {update}" if others else "DO NOTHING"
        # "WHERE true" keeps SQLite from reading ON as a join condition.
        return f"{insert} WHERE true ON CONFLICT ({target}) {action}"
    update = ", ".join(f"{quoted(name)} = VALUES({quoted(name)})" for name in others or keys)
    return f"{insert} ON DUPLICATE KEY UPDATE {update}"


def write_db(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    *,
    keys: str | Sequence[str] | None = None,
    order_by=None,
    staging: str | None = None,
    execute: Callable[[str], object] | None = None,
    dialect: str = "merge",
    batch_size: int = 10_000,
    num_partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Write rows to a database table and pass the data on.

    ``append`` adds rows, ``overwrite`` replaces the table.  Each task writes
    in one transaction, but a repeated task may write again: where that
    matters use ``upsert``.  It needs ``keys``: rows, one per key, go to the
    ``staging`` table, which a repeat replaces, and ``execute(sql)`` (the
    caller's connection) then runs a single statement inside the database.
    ``num_partitions`` bounds the number of connections.
    """
    require(url, "write_db: needs a url")
    require(table, "write_db: needs a table")
    if mode not in DB_MODES:
        raise ValueError(f"write_db: mode must be one of {DB_MODES}, not {mode!r}")
    options = {"url": url, "batchsize": str(batch_size), **(properties or {})}
    if num_partitions:
        options["numPartitions"] = str(num_partitions)
    if mode != "upsert":
        df.write.format("jdbc").mode(mode).options(**options, dbtable=table).save()
        return df

    names = name_list(keys)
    require(names, "write_db: upsert needs keys")
    require(execute, "write_db: upsert needs execute(sql)")
    require_columns(df, names, "write_db")
    staged = staging or table + "_staging"
    statement = upsert_statement(table, staged, names, df.columns, dialect)
    changes = deduplicate(df, names, order_by)
    changes.write.format("jdbc").mode("overwrite").options(**options, dbtable=staged).save()
    execute(statement)
    return df


def migrate(
    spark: SparkSession,
    source_url: str,
    target_url: str,
    query: str,
    table: str,
    mode: str = "append",
    *,
    read: Mapping[str, object] | None = None,
    write: Mapping[str, object] | None = None,
) -> None:
    """Copy the result of a query from one database into a table of another.

    ``read`` and ``write`` are further arguments of ``read_db`` and
    ``write_db``; give ``read`` a ``partition_column`` for large copies.
    """
    require(source_url, "migrate: needs a source url")
    require(target_url, "migrate: needs a target url")
    require(query.strip(), "migrate: needs a query")
    require(table, "migrate: needs a table")
    rows = read_db(spark, source_url, query, **(read or {}))
    write_db(rows, target_url, table, mode, **(write or {}))
