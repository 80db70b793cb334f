"""JDBC source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from rowloom.columns import require


def jdbc_read_options(
    url: str,
    query: str = "",
    table: str = "",
    *,
    partition_column: str | None = None,
    lower_bound: object = None,
    upper_bound: object = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    timeout: int = 0,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Translate a database read into options of Spark's JDBC source."""
    require(url, "read_db: needs a url")
    if bool(query.strip()) == bool(table.strip()):
        raise ValueError("read_db: give either a query or a table")
    options = {"url": url, "fetchsize": str(fetch_size), **(properties or {})}
    if timeout:
        options["queryTimeout"] = str(timeout)
    if partition_column is None:
        options.update({"query": query} if query else {"dbtable": table})
        return options
    bounds = (lower_bound, upper_bound, num_partitions)
    if any(value is None for value in bounds):
        raise ValueError(
            "read_db: partition_column needs lower_bound, upper_bound and num_partitions"
        )
    # Spark refuses "query" beside "partitionColumn"; a derived table works.
    statement = query.strip().rstrip(";")
    options.update(
        dbtable=f"({statement}) source" if query else table,
        partitionColumn=partition_column,
        lowerBound=str(lower_bound),
        upperBound=str(upper_bound),
        numPartitions=str(num_partitions),
    )
    return options


def read_db(spark: SparkSession, url: str, query: str = "", table: str = "", **how) -> DataFrame:
    """Run a query in a database and read its rows.

    Without ``partition_column`` the rows arrive through one connection and one
    task, which only suits small results.  With it (a numeric, date or
    timestamp column, its bounds and ``num_partitions``) executors read ranges
    in parallel; the bounds only set the strides, rows outside them are read
    too.  Spark pushes filters and column choices on the result into the
    database.  See ``jdbc_read_options`` for all arguments.
    """
    options = jdbc_read_options(url, query, table, **how)
    return spark.read.format("jdbc").options(**options).load()
