"""One query per operator over the given tables, each with its SQL counterpart."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime
from urllib.parse import urlparse

import pandas as pd
import pyarrow
import pyarrow.fs
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.outcome import Reporter, TaskOutcome
from rowloom.functions.rows import (
    filter_py,
    map_rows,
    reported_batches,
    task,
    task_batches,
    task_groups,
)
from rowloom.operators.branching import branch
from rowloom.operators.combine import fan_in, fan_out, join
from rowloom.operators.history import missing_run_dates, snapshot
from rowloom.operators.ordered import join_asof, join_interval, running_total
from rowloom.operators.quality import quality_gate, quality_report, validate
from rowloom.operators.transforms import (
    add_column,
    aggregate,
    aggregate_sets,
    deduplicate,
    drop_columns,
    drop_null,
    filter_rows,
    rename,
    replace_values,
    sort,
    transform,
)
from rowloom.plans import jobs
from rowloom.plans.models import sql_models
from rowloom.session import new_path
from rowloom.sinks.api import deliver, render_requests
from rowloom.sinks.custom import custom_sink
from rowloom.sinks.ledger import deliver_once
from rowloom.sinks.files import upsert, upsert_table, write_file
from rowloom.sources.arrow_tables import read_arrow_table, register_arrow_tables, write_arrow_table
from rowloom.sources.api import api_source, open_payload, parse_payload
from rowloom.sources.custom import custom_source
from rowloom.sources.files import read_file, seed_table
from rowloom.sources.sql import run_query, run_variables
from rowloom.streaming.checked import batch_reports, checked_batches
from rowloom.streaming.ingest import ingest_new_files


class Tables:
    """The test tables of one scale, read on attribute access."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def scratch(self, label: str) -> str:
        return new_path(self.spark, label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str):
    """Register a query under its key together with the equivalent SQL."""

    def register(function: Callable[[Tables], DataFrame]):
        QUERIES[key] = lambda spark, folder: function(Tables(spark, folder))
        ORACLE[key] = sql
        return function

    return register


# --- sources ----------------------------------------------------------------


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema)


@query(
    "s1_csv",
    "SELECT * REPLACE ('  ' || o_orderpriority || ' ' || chr(9) AS o_orderpriority) FROM orders",
)
def s1_csv(t: Tables) -> DataFrame:
    path = t.scratch("s1")
    orders = add_column(t.orders, "o_orderpriority", "'  ' || o_orderpriority || ' \\t'")
    write_file(orders, path, "csv")
    # Columns are found by name, whatever their order in the file.
    schema = T.StructType(list(reversed(orders.schema.fields)))
    return read_file(t.spark, path, "csv", schema)


@query("s2_json", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def s2_json(t: Tables) -> DataFrame:
    path = t.scratch("s2")
    write_file(t.documents, path, "json")
    return read_file(t.spark, path, "json", _schema(t.documents))


@query(
    "s2_json_parse",
    """
    SELECT event_id, CASE WHEN event_id % 10 > 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k
    FROM events
    """,
)
def s2_json_parse(t: Tables) -> DataFrame:
    events = add_column(t.events, "props", "if(event_id % 10 > 0, props, NULL)")
    return parse_payload(events, "props", "k bigint", keep="event_id", outer=True)


@query(
    "s2_open_payload",
    """
    SELECT event_id, CASE WHEN event_id % 3 > 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
           CASE WHEN event_id % 3 = 0 THEN event_id END AS deep, CASE WHEN event_id % 3 = 0 THEN event_type END AS kind
    FROM events
    """,
)
def s2_open_payload(t: Tables) -> DataFrame:
    """Payloads of two shapes, read without a declared schema."""
    other = """'{"k": {"deep": [1, ' || event_id || '], "kind": "' || event_type || '"}}'"""
    events = add_column(t.events, "props", f"if(event_id % 3 = 0, {other}, props)")
    fields = {"k": ("$.k", "bigint"), "deep": ("$.k.deep[1]", "bigint"), "kind": ("$.k.kind", "string")}
    return open_payload(events, "props", fields, keep="event_id")


@query("s3_xml", "SELECT * REPLACE ('  ' || c_name || '   ' AS c_name) FROM customer")
def s3_xml(t: Tables) -> DataFrame:
    path = t.scratch("s3")
    customers = add_column(t.customer, "c_name", "'  ' || c_name || '   '")
    write_file(customers, path, "xml", row_tag="customer")
    return read_file(t.spark, path, "xml", _schema(customers), row_tag="customer")


@query("s4_parquet", "SELECT l_orderkey, l_shipdate, l_tax FROM lineitem")
def s4_parquet(t: Tables) -> DataFrame:
    return read_file(t.spark, t.path("lineitem"), "parquet").select(
        "l_orderkey", "l_shipdate", "l_tax"
    )


S6_SQL = """
    SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS spent
    FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
    JOIN {nation} n ON c.c_nationkey = n.n_nationkey
    WHERE o_orderdate >= TIMESTAMP_NTZ '1996-01-01' - INTERVAL '90' DAY
    GROUP BY n_name
"""


@query(
    "s6_sql",
    """
    SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS spent
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' - INTERVAL '90' DAY
    GROUP BY n_name
    """,
)
def s6_sql(t: Tables) -> DataFrame:
    return run_query(t.spark, S6_SQL, orders=t.orders, customer=t.customer, nation=t.nation)


@query(
    "s6_top_k",
    """
    SELECT c_custkey, c_name, c_acctbal FROM customer
    ORDER BY c_acctbal DESC, c_custkey LIMIT 100
    """,
)
def s6_top_k(t: Tables) -> DataFrame:
    return run_query(
        t.spark,
        """
        SELECT c_custkey, c_name, c_acctbal FROM {customer}
        ORDER BY c_acctbal DESC, c_custkey LIMIT 100
        """,
        customer=t.customer,
    )


@query(
    "s7_api",
    """
    SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
    """,
)
def s7_api(t: Tables) -> DataFrame:
    # Pages of events lie in the shared folder; a request names one and the fetch reads it there.
    folder = t.scratch("s7")
    store = _outbox(folder)
    events = parse_payload(t.events, "props", "k bigint", keep=["event_id", "user_id"])
    pages = render_requests(events, "https://api.example.com/events", batch_size=200)
    deliver(pages, lambda request: store([request["body"]]))
    found = t.spark.read.format("binaryFile").load(folder).select(F.col("path").alias("url"))

    def fetch(request: dict) -> str:
        system, path = _file_system(request["url"])
        with system.open_input_stream(path) as stream:
            return stream.read().decode()

    return api_source(found, fetch, "event_id bigint, user_id bigint, k bigint")


@query("s8_custom", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def s8_custom(t: Tables) -> DataFrame:
    # Arrow IPC files, which Spark has no reader for; tasks write and read them.
    folder, columns = t.scratch("s8"), ["p_partkey", "p_name", "p_size", "p_retailprice"]
    custom_sink(t.part.select(*columns), _outbox(folder, "arrow", _arrow_file))

    def read_arrow(spec: dict):
        system, path = _file_system(spec["path"])
        with system.open_input_file(path) as file, pyarrow.ipc.open_file(file) as reader:
            for number in range(reader.num_record_batches):
                yield from reader.get_batch(number).to_pylist()

    files = t.spark.read.format("binaryFile").load(folder).select("path")
    schema = "p_partkey bigint, p_name string, p_size int, p_retailprice double"
    return custom_source(t.spark, files, read_arrow, schema, parallelism=4)


@query(
    "s8_arrow_table",
    "SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem WHERE l_orderkey >= 50 AND l_orderkey < 400 AND l_returnflag IN ('A', 'R')",
)
def s8_arrow_table(t: Tables) -> DataFrame:
    """Files of ranges of orders, of which the conditions leave most unopened."""
    folder = t.scratch("s8-table")
    write_arrow_table(t.lineitem, folder, "l_orderkey", least_files=8)
    where = [("l_orderkey", ">=", 50), ("l_orderkey", "<", 400), ("l_returnflag", "in", ["A", "R"])]
    return read_arrow_table(t.spark, folder, ["l_orderkey", "l_quantity", "l_shipdate"], where)


def _arrow_file(rows: list[dict]) -> bytes:
    table, out = pyarrow.Table.from_pylist(rows), pyarrow.BufferOutputStream()
    with pyarrow.ipc.new_file(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _file_system(uri: str):
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return pyarrow.fs.LocalFileSystem(), parts.path
    return pyarrow.fs.FileSystem.from_uri(uri)


# --- transforms -------------------------------------------------------------


@query(
    "t1_rename_swap",
    "SELECT n_nationkey AS n_regionkey, n_name, n_regionkey AS n_nationkey FROM nation",
)
def t1_rename_swap(t: Tables) -> DataFrame:
    return rename(t.nation, {"n_nationkey": "n_regionkey", "n_regionkey": "n_nationkey"})


@query("t1a_rename_short", "SELECT * RENAME (ts AS event_time) FROM events")
def t1a_rename_short(t: Tables) -> DataFrame:
    return transform(t.events, [{"type": "rename", "from": "ts", "to": "event_time"}])


@query("t2_drop", "SELECT * EXCLUDE (o_orderpriority, o_orderstatus) FROM orders")
def t2_drop(t: Tables) -> DataFrame:
    return drop_columns(t.orders, ["o_orderpriority", "o_orderstatus"])


@query(
    "t3_add",
    """
    SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net
    FROM lineitem
    """,
)
def t3_add(t: Tables) -> DataFrame:
    priced = add_column(t.lineitem, "net", "round(l_extendedprice * (1 - l_discount), 4)")
    return priced.select("l_orderkey", "l_linenumber", "net")


@query("t4_filter", "SELECT * FROM lineitem WHERE l_quantity > 45 AND l_returnflag != 'N'")
def t4_filter(t: Tables) -> DataFrame:
    return filter_rows(t.lineitem, "l_quantity > 45 AND l_returnflag != 'N'")


@query(
    "t5_replace",
    """
    SELECT * REPLACE (
        CASE o_orderstatus WHEN 'F' THEN 'O' WHEN 'O' THEN 'open' ELSE o_orderstatus END
        AS o_orderstatus)
    FROM orders
    """,
)
def t5_replace(t: Tables) -> DataFrame:
    return replace_values(t.orders, "o_orderstatus", {"F": "O", "O": "open"})


@query(
    "t5_replace_long",
    """
    SELECT * REPLACE (
        CASE WHEN o_custkey BETWEEN 0 AND 499 THEN o_custkey + 1000000 ELSE o_custkey END
        AS o_custkey,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'true' WHEN '2-HIGH' THEN '2.5' ELSE o_orderpriority END
        AS o_orderpriority)
    FROM orders
    """,
)
def t5_replace_long(t: Tables) -> DataFrame:
    # Keys that become equal to earlier ones after the cast have no effect.
    keys = {key: key + 1_000_000 for key in range(500)} | {f"0{key}": 1 for key in range(500)}
    texts = {"1-URGENT": True, "2-HIGH": 2.5} | {f"no such text {i}": "x" for i in range(200)}
    return replace_values(replace_values(t.orders, "o_custkey", keys), "o_orderpriority", texts)


@query("t6_sort", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def t6_sort(t: Tables) -> DataFrame:
    return sort(t.orders, ["o_totalprice", "o_orderkey"], [False, True])


@query(
    "t6_sort_top",
    """
    SELECT o_orderkey, o_totalprice,
           row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position
    FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
    """,
)
def t6_sort_top(t: Tables) -> DataFrame:
    ordered = sort(t.orders, ["o_totalprice", "o_orderkey"], [False, True])
    top = ordered.select("o_orderkey", "o_totalprice").limit(100)
    return top.withColumn("position", F.monotonically_increasing_id() + 1)


@query(
    "t7_dedup_keys",
    """
    SELECT * FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1
    """,
)
def t7_dedup_keys(t: Tables) -> DataFrame:
    return deduplicate(t.events, ["user_id", "event_type"], order_by=["ts", "event_id"])


@query("t7_dedup_all", "SELECT DISTINCT user_id, event_type FROM events")
def t7_dedup_all(t: Tables) -> DataFrame:
    return deduplicate(t.events.select("user_id", "event_type"))


@query(
    "t8_agg",
    """
    SELECT l_returnflag, l_linestatus,
           round(sum(l_extendedprice), 2) AS l_extendedprice_sum,
           round(avg(l_quantity), 4) AS l_quantity_avg,
           min(l_shipdate) AS l_shipdate_min, max(l_shipdate) AS l_shipdate_max,
           count(l_tax) AS l_tax_count, count(*) AS count
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """,
)
def t8_agg(t: Tables) -> DataFrame:
    totals = aggregate(
        t.lineitem,
        ["l_returnflag", "l_linestatus"],
        [
            {"column": "l_extendedprice", "function": "sum"},
            {"column": "l_quantity", "function": "avg"},
            {"column": "l_shipdate", "function": "min"},
            {"column": "l_shipdate", "function": "max"},
            {"column": "l_tax", "function": "count"},
            {"column": "*", "function": "count"},
        ],
    )
    return totals.withColumns(
        {
            "l_extendedprice_sum": F.round("l_extendedprice_sum", 2),
            "l_quantity_avg": F.round("l_quantity_avg", 4),
        }
    )


@query(
    "t8_global_distinct",
    """
    SELECT count(DISTINCT user_id) AS user_id_count_distinct, count(*) AS count FROM events
    """,
)
def t8_global_distinct(t: Tables) -> DataFrame:
    return aggregate(
        t.events,
        [],
        [{"column": "user_id", "function": "count_distinct"}, {"column": "*", "function": "count"}],
    )


@query(
    "t8_group_distinct",
    """
    SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers
    FROM lineitem GROUP BY l_returnflag
    """,
)
def t8_group_distinct(t: Tables) -> DataFrame:
    return aggregate(
        t.lineitem,
        "l_returnflag",
        [
            {"column": "l_partkey", "function": "count_distinct", "alias": "parts"},
            {"column": "l_suppkey", "function": "count_distinct", "alias": "suppliers"},
        ],
    )


@query(
    "t8_sets",
    """
    SELECT l_returnflag, l_linestatus, l_linenumber, GROUPING_ID(l_returnflag, l_linestatus, l_linenumber)::BIGINT AS grouping_id,
           round(sum(l_quantity), 2) AS quantity, round(avg(l_extendedprice), 4) AS price, count(*) AS rows,
           count(DISTINCT l_suppkey) AS suppliers, max(l_shipdate) AS latest
    FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linenumber), (l_returnflag), ())
    """,
)
def t8_sets(t: Tables) -> DataFrame:
    fields = [
        {"column": "l_quantity", "function": "sum", "alias": "quantity"},
        {"column": "l_extendedprice", "function": "avg", "alias": "price"},
        {"column": "*", "function": "count", "alias": "rows"},
        {"column": "l_suppkey", "function": "count_distinct", "alias": "suppliers"},
        {"column": "l_shipdate", "function": "max", "alias": "latest"},
    ]
    sets = [("l_returnflag", "l_linestatus"), ("l_linenumber",), ("l_returnflag",), ()]
    found = aggregate_sets(t.lineitem, sets, fields)
    return found.withColumns({"quantity": F.round("quantity", 2), "price": F.round("price", 4)})


@query(
    "t9_drop_null",
    """
    SELECT o_orderkey, nullif(o_orderpriority, '1-URGENT') AS priority FROM orders
    WHERE nullif(o_orderpriority, '1-URGENT') IS NOT NULL
    """,
)
def t9_drop_null(t: Tables) -> DataFrame:
    derived = t.orders.select(
        "o_orderkey", F.expr("nullif(o_orderpriority, '1-URGENT')").alias("priority")
    )
    return drop_null(derived, "priority")


@query(
    "t10_text_rules",
    """
    SELECT DISTINCT user_id, kind FROM (
        SELECT user_id, nullif(event_type, 'error') AS kind, value FROM events
    ) WHERE kind IS NOT NULL AND value > 10
    """,
)
def t10_text_rules(t: Tables) -> DataFrame:
    derived = t.events.select(
        "user_id", F.expr("nullif(event_type, 'error')").alias("kind"), "value"
    )
    kept = transform(derived, ["drop_null(kind)", "FILTER value > 10", "deduplicate(user_id, kind)"])
    return kept.select("user_id", "kind")


@query(
    "t11_chain",
    """
    SELECT flag, round(sum(l_extendedprice * (1 - l_discount)), 2) AS net, count(*) AS lines
    FROM (SELECT l_returnflag AS flag, * FROM lineitem)
    WHERE l_shipdate < TIMESTAMP '1999-01-01' AND l_quantity > 5 GROUP BY flag
    """,
)
def t11_chain(t: Tables) -> DataFrame:
    return transform(
        t.lineitem,
        [
            {"type": "rename", "mapping": {"l_returnflag": "flag"}},
            {"type": "filter_rows", "condition": "l_shipdate < timestamp_ntz '1999-01-01'"},
            "FILTER l_quantity > 5",
            {"type": "add_column", "name": "n", "expression": "l_extendedprice * (1 - l_discount)"},
            {
                "type": "aggregate",
                "group_by": ["flag"],
                "agg_fields": [
                    {"column": "n", "function": "sum", "alias": "net"},
                    {"column": "*", "function": "count", "alias": "lines"},
                ],
            },
            {"type": "add_column", "name": "net", "expression": "round(net, 2)"},
        ],
    )


# --- joins and fan-in -------------------------------------------------------


def _line_totals(t: Tables) -> DataFrame:
    totals = aggregate(
        t.lineitem,
        "l_orderkey",
        [
            {"column": "l_quantity", "function": "sum", "alias": "quantity"},
            {"column": "*", "function": "count", "alias": "lines"},
        ],
    )
    # Orders without lines, and (by shifting some keys away) lines without orders.
    shifted = "if(quantity > 150, -l_orderkey - 1, l_orderkey)"
    return add_column(totals, "l_orderkey", shifted)


LINE_TOTALS_SQL = """
    SELECT CASE WHEN sum(l_quantity) > 150 THEN -l_orderkey - 1 ELSE l_orderkey END AS l_orderkey,
           sum(l_quantity) AS quantity, count(*) AS lines
    FROM lineitem GROUP BY lineitem.l_orderkey
"""


def _join_sql(how: str) -> str:
    return f"""
        SELECT o_orderkey, o_custkey, o_totalprice, l_orderkey, quantity, lines
        FROM orders {how} JOIN ({LINE_TOTALS_SQL}) ON o_orderkey = l_orderkey
    """


def _joined(t: Tables, how: str, **unique) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return join(orders, _line_totals(t), "o_orderkey=l_orderkey", how, **unique)


@query("j1_inner", _join_sql("INNER"))
def j1_inner(t: Tables) -> DataFrame:
    return _joined(t, "inner")


@query("j2_left", _join_sql("LEFT"))
def j2_left(t: Tables) -> DataFrame:
    return _joined(t, "left")


@query("j2_left_unique", _join_sql("LEFT"))
def j2_left_unique(t: Tables) -> DataFrame:
    return _joined(t, "left", right_unique=True)


@query("j2_left_split", _join_sql("LEFT"))
def j2_left_split(t: Tables) -> DataFrame:
    return _joined(t, "left", split_skew=True)


@query("j4_full_split", _join_sql("FULL"))
def j4_full_split(t: Tables) -> DataFrame:
    return _joined(t, "full", split_skew=True)


@query(
    "j6_inner",
    "SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)",
)
def j6_inner(t: Tables) -> DataFrame:
    return join(t.documents.select("doc_id", "lang"), t.labels, "doc_id")


@query("j3_right", _join_sql("RIGHT"))
def j3_right(t: Tables) -> DataFrame:
    return _joined(t, "right")


@query("j4_full", _join_sql("FULL"))
def j4_full(t: Tables) -> DataFrame:
    return _joined(t, "full")


@query("j4_full_unique", _join_sql("FULL"))
def j4_full_unique(t: Tables) -> DataFrame:
    return _joined(t, "full", left_unique=True, right_unique=True)


@query(
    "j5_many_to_many",
    """
    SELECT e.user_id, e.event_id, o.o_custkey, o.o_orderkey
    FROM events e LEFT JOIN orders o ON e.user_id = o.o_custkey
    """,
)
def j5_many_to_many(t: Tables) -> DataFrame:
    events = t.events.select("user_id", "event_id")
    return join(events, t.orders.select("o_custkey", "o_orderkey"), "user_id = o_custkey", "left")


@query(
    "j6_same_key",
    """
    SELECT doc_id, a.lang, a.n_chars, b.n_chars AS n_chars_right, b.quality
    FROM (SELECT doc_id, lang, n_chars FROM documents WHERE lang != 'en') a
    FULL JOIN (SELECT doc_id, n_chars, quality FROM documents JOIN labels USING (doc_id)) b
    USING (doc_id)
    """,
)
def j6_same_key(t: Tables) -> DataFrame:
    documents = t.documents.select("doc_id", "lang", "n_chars")
    labelled = join(t.documents.select("doc_id", "n_chars"), t.labels, "doc_id")
    return join(
        filter_rows(documents, "lang != 'en'"),
        labelled.select("doc_id", "n_chars", "quality"),
        "doc_id",
        "full",
    )


@query(
    "j_composite_null_keys",
    """
    SELECT a.event_id, a.user_id, a.event_type, b.events
    FROM (SELECT event_id, user_id, nullif(event_type, 'view') AS event_type FROM events) a
    LEFT JOIN (SELECT user_id, nullif(event_type, 'view') AS event_type, count(*) AS events
               FROM events GROUP BY ALL) b
    ON a.user_id = b.user_id AND a.event_type = b.event_type
    """,
)
def j_composite_null_keys(t: Tables) -> DataFrame:
    kinds = t.events.select(
        "event_id", "user_id", F.expr("nullif(event_type, 'view')").alias("event_type")
    )
    counts = aggregate(
        kinds,
        ["user_id", "event_type"],
        [{"column": "*", "function": "count", "alias": "events"}],
    )
    return join(kinds, counts, ["user_id", "event_type"], "left")


@query(
    "u1_fan_in",
    """
    SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL BY NAME SELECT s_name AS name, s_suppkey AS key, s_nationkey AS nation FROM supplier
    UNION ALL BY NAME SELECT p_partkey AS key, p_name AS name FROM part
    """,
)
def u1_fan_in(t: Tables) -> DataFrame:
    customers = t.customer.selectExpr("c_custkey AS key", "c_name AS name", "c_acctbal AS balance")
    suppliers = t.supplier.selectExpr("s_name AS name", "s_suppkey AS key", "s_nationkey AS nation")
    parts = t.part.selectExpr("p_partkey AS key", "p_name AS name")
    return fan_in(customers, suppliers, parts)


# --- quality ----------------------------------------------------------------


def _report_sql(*lines: tuple[str, str, str, str, str]) -> str:
    """SQL of a report: (column, rule, on_failure, failing aggregate, relation) per rule."""
    return " UNION ALL ".join(
        f"""
        SELECT {number} AS rule_no, '{column}' AS "column", '{rule}' AS rule,
               '{severity}' AS on_failure, count(*) AS total_rows,
               CAST({failed} AS BIGINT) AS failed_rows, CAST({failed} AS BIGINT) = 0 AS passed
        FROM {relation}
        """
        for number, (column, rule, severity, failed, relation) in enumerate(lines, start=1)
    )


URGENT_NULL = "(SELECT *, nullif(o_orderpriority, '1-URGENT') AS priority FROM orders)"


def _orders_with_nulls(t: Tables) -> DataFrame:
    return add_column(t.orders, "priority", "nullif(o_orderpriority, '1-URGENT')")


@query(
    "q1_not_null",
    _report_sql(
        ("o_orderkey", "not_null", "block", "count(*) - count(o_orderkey)", URGENT_NULL),
        ("priority", "not_null", "block", "count(*) - count(priority)", URGENT_NULL),
    ),
)
def q1_not_null(t: Tables) -> DataFrame:
    return quality_report(_orders_with_nulls(t), ["not_null(o_orderkey)", "not_null(priority)"])


@query(
    "q2_unique",
    _report_sql(
        ("o_orderkey", "unique", "block", "count(o_orderkey) - count(DISTINCT o_orderkey)", URGENT_NULL),
        ("o_custkey", "unique", "block", "count(o_custkey) - count(DISTINCT o_custkey)", URGENT_NULL),
        ("priority", "unique", "block", "count(priority) - count(DISTINCT priority)", URGENT_NULL),
    ),
)
def q2_unique(t: Tables) -> DataFrame:
    return quality_report(
        _orders_with_nulls(t), ["unique(o_orderkey)", "unique(o_custkey)", "unique(priority)"]
    )


@query(
    "q3_min",
    _report_sql(
        ("c_acctbal", "min", "warn", "count(*) FILTER (c_acctbal < 0)", "customer"),
        ("c_acctbal", "min", "warn", "count(*) FILTER (c_acctbal < -1000)", "customer"),
        ("c_nationkey", "min", "warn", "count(*) FILTER (c_nationkey < 2.5)", "customer"),
        ("as_text", "min", "warn", "count(*) FILTER (c_acctbal < 900)", "customer"),
    ),
)
def q3_min(t: Tables) -> DataFrame:
    customers = add_column(t.customer, "as_text", "cast(c_acctbal AS string)")
    rules = ["min(c_acctbal, 0)", "min(c_acctbal, -1000)", "min(c_nationkey, 2.5)"]
    return quality_report(customers, [*rules, "min(as_text, 900)"])


@query(
    "q4_max",
    _report_sql(
        ("l_quantity", "max", "warn", "count(*) FILTER (l_quantity > 40)", "lineitem"),
        ("l_quantity", "max", "warn", "count(*) FILTER (l_quantity > 100)", "lineitem"),
        (
            "l_shipdate",
            "max",
            "warn",
            "count(*) FILTER (l_shipdate > TIMESTAMP '2000-01-01 12:00:00')",
            "lineitem",
        ),
    ),
)
def q4_max(t: Tables) -> DataFrame:
    return quality_report(
        t.lineitem,
        ["max(l_quantity, 40)", "max(l_quantity, 100)", "max(l_shipdate, 2000-01-01 12:00:00)"],
    )


@query(
    "q5_range",
    _report_sql(
        (
            "value",
            "range",
            "warn",
            "count(*) FILTER (value < 1 OR value > 100)",
            "events",
        ),
        ("user_id", "range", "warn", "count(*) FILTER (user_id < 0)", "events"),
    ),
)
def q5_range(t: Tables) -> DataFrame:
    return quality_report(t.events, ["range(value, 1, 100)", "range(user_id, 0, 1000000000)"])


@query(
    "q6_row_count",
    _report_sql(
        ("", "row_count", "block", "NOT (count(*) >= 100)", "part"),
        ("", "row_count", "block", "NOT (count(*) BETWEEN 1 AND 50)", "part"),
        ("", "row_count", "block", "0", "part"),
    ),
)
def q6_row_count(t: Tables) -> DataFrame:
    return quality_report(t.part, ["row_count(min=100)", "row_count(min=1, max=50)", "row_count()"])


AS_OF = datetime(2024, 1, 31)


@query(
    "q7_freshness",
    _report_sql(
        (
            "ts",
            "freshness",
            "warn",
            "NOT (max(ts) >= TIMESTAMP '2024-01-31' - INTERVAL 24 HOUR)",
            "events",
        ),
        (
            "ts",
            "freshness",
            "warn",
            "NOT (max(ts) >= TIMESTAMP '2024-01-31' - INTERVAL 1 HOUR)",
            "events",
        ),
        (
            "ts",
            "freshness",
            "warn",
            "NOT (max(ts) >= TIMESTAMP '2024-01-31' - INTERVAL 1000 HOUR)",
            "events",
        ),
    ),
)
def q7_freshness(t: Tables) -> DataFrame:
    return quality_report(
        t.events,
        ["freshness(ts)", "freshness(ts, max_hours=1)", "freshness(ts, max_hours=1000)"],
        as_of=AS_OF,
    )


@query(
    "q8_regex",
    _report_sql(
        (
            "priority",
            "regex",
            "warn",
            "count(*) FILTER (NOT regexp_matches(priority, '^[1-3]'))",
            URGENT_NULL,
        ),
        (
            "priority",
            "regex",
            "warn",
            "count(*) FILTER (NOT regexp_matches(priority, '[A-Z]{2,3}'))",
            URGENT_NULL,
        ),
    ),
)
def q8_regex(t: Tables) -> DataFrame:
    return quality_report(
        _orders_with_nulls(t), ["regex(priority, ^[1-3])", "regex(priority, [A-Z]{2,3})"]
    )


TYPED_SQL = """(
    SELECT *, CASE WHEN event_type = 'error' THEN 'none' ELSE CAST(user_id AS VARCHAR) END AS code
    FROM events)"""


@query(
    "q9_type_check",
    _report_sql(
        (
            "code",
            "type_check",
            "warn",
            "count(code) FILTER (TRY_CAST(code AS BIGINT) IS NULL)",
            TYPED_SQL,
        ),
        ("ts", "type_check", "warn", "0", TYPED_SQL),
        ("value", "type_check", "warn", "count(value)", TYPED_SQL),
        ("value", "type_check", "warn", "0", TYPED_SQL),
    ),
)
def q9_type_check(t: Tables) -> DataFrame:
    coded = add_column(
        t.events, "code", "if(event_type = 'error', 'none', cast(user_id AS string))"
    )
    return quality_report(
        coded,
        [
            "type_check(code, int)",
            "type_check(ts, timestamp)",
            "type_check(value, int)",
            "type_check(value, float)",
        ],
    )


@query(
    "q10_report",
    _report_sql(
        ("c_custkey", "not_null", "block", "count(*) - count(c_custkey)", "customer"),
        ("c_custkey", "unique", "block", "count(c_custkey) - count(DISTINCT c_custkey)", "customer"),
        ("c_acctbal", "min", "block", "count(*) FILTER (c_acctbal < 0)", "customer"),
        (
            "c_nationkey",
            "unique",
            "block",
            "count(c_nationkey) - count(DISTINCT c_nationkey)",
            "customer",
        ),
        ("c_name", "regex", "warn", "count(*) FILTER (NOT regexp_matches(c_name, '00[1-4]'))", "customer"),
    ),
)
def q10_report(t: Tables) -> DataFrame:
    return quality_report(
        t.customer,
        [
            "not_null(c_custkey)",
            "unique(c_custkey)",
            {"column": "c_acctbal", "rule": "min", "params": {"min": 0}, "on_failure": "block"},
            "unique(c_nationkey)",
            "regex(c_name, 00[1-4])",
        ],
    )


@query("q11_gate_pass", "SELECT * FROM customer")
def q11_gate_pass(t: Tables) -> DataFrame:
    return quality_gate(
        t.customer,
        ["not_null(c_name)", "unique(c_custkey)", "min(c_acctbal, 0)", "row_count(min=1)"],
    )


@query("q12_validate", "SELECT * FROM labels")
def q12_validate(t: Tables) -> DataFrame:
    def balanced(df: DataFrame):
        share = F.avg("toxic")
        return share <= 1, F.concat(F.lit("toxic share "), share.cast("string"))

    return validate(validate(t.labels, balanced), lambda df: F.max("quality") > 5, "warn")


# --- branching and composition ----------------------------------------------


@query(
    "c1_branch_true",
    """
    SELECT * FROM events WHERE value > 50
    AND (SELECT count(*) FROM events WHERE value > 50) > 100
    """,
)
def c1_branch_true(t: Tables) -> DataFrame:
    return branch(filter_rows(t.events, "value > 50"), "row_count > 100")[0]


@query(
    "c1_branch_false",
    """
    SELECT * FROM events WHERE value > 50
    AND NOT (SELECT count(*) FROM events WHERE value > 50) > 1000000000
    """,
)
def c1_branch_false(t: Tables) -> DataFrame:
    return branch(filter_rows(t.events, "value > 50"), "row_count > 1000000000")[1]


@query(
    "c1_branch_empty",
    """
    SELECT * FROM labels
    WHERE (SELECT count(*) = 0 OR avg(toxic) > 1 FROM labels)
    """,
)
def c1_branch_empty(t: Tables) -> DataFrame:
    return branch(
        t.labels, "row_count = 0 OR toxicity > 1", statistics={"toxicity": F.avg("toxic")}
    )[0]


@query(
    "c1_branch_lazy",
    """
    SELECT 'many' AS taken, o_orderkey FROM orders WHERE (SELECT count(*) FROM orders) > 100
    UNION ALL SELECT 'odd', o_orderkey FROM orders
    WHERE NOT (SELECT count(*) FILTER (o_totalprice IS NULL) = count(*) FROM orders) AND o_orderkey < 10
    """,
)
def c1_branch_lazy(t: Tables) -> DataFrame:
    many, _ = branch(t.orders, "row_count > 100", lazy=True)
    _, odd = branch(t.orders, lambda df: F.bool_and(df.o_totalprice.isNull()), lazy=True)
    return fan_in(
        many.select(F.lit("many").alias("taken"), "o_orderkey"),
        odd.where("o_orderkey < 10").select(F.lit("odd").alias("taken"), "o_orderkey"),
    )


@query(
    "c2_branch",
    """
    SELECT * FROM orders
    WHERE NOT (SELECT count(*) > 100 AND bool_and(o_orderstatus = 'F') FROM orders)
    """,
)
def c2_branch(t: Tables) -> DataFrame:
    return branch(
        t.orders,
        lambda df: (F.count(F.lit(1)) > 100) & F.bool_and(df.o_orderstatus == "F"),
    )[1]


@query(
    "g1_sequence",
    """
    SELECT event_type, count(*) AS count FROM events WHERE value > 1 GROUP BY event_type
    """,
)
def g1_sequence(t: Tables) -> DataFrame:
    return t.events.transform(filter_rows, "value > 1").transform(
        aggregate, "event_type", [{"column": "*", "function": "count"}]
    )


@query(
    "g2_fan_out_in",
    """
    SELECT user_id, event_type, value, 'low' AS level FROM events WHERE value <= 20
    UNION ALL SELECT user_id, event_type, value, 'high' FROM events WHERE value > 20
    """,
)
def g2_fan_out_in(t: Tables) -> DataFrame:
    def branch_to(level: str, condition: str):
        path = t.scratch(f"g2-{level}")

        def consume(df: DataFrame) -> DataFrame:
            write_file(filter_rows(df, condition), path, "parquet")
            return t.spark.read.schema(df.schema).parquet(path).withColumn("level", F.lit(level))

        return consume

    events = t.events.select("user_id", "event_type", "value")
    parts = fan_out(events, [branch_to("low", "value <= 20"), branch_to("high", "value > 20")])
    return fan_in(*parts)


# --- Python functions -------------------------------------------------------


@query("f1_filter", "SELECT * FROM events WHERE event_type = 'purchase' OR value > 100")
def f1_filter(t: Tables) -> DataFrame:
    return filter_py(
        t.events,
        lambda row: row["event_type"] == "purchase" or row["value"] > 100,
        columns=["event_type", "value"],
    )


@query("f1_filter_native", "SELECT * FROM events WHERE event_type = 'purchase' OR value > 100")
def f1_filter_native(t: Tables) -> DataFrame:
    return filter_py(t.events, (F.col("event_type") == "purchase") | (F.col("value") > 100))


@query(
    "m1_map",
    """
    SELECT c_custkey, lower(c_name) AS name, c_acctbal < 0 AS in_debt,
           nullif(c_mktsegment, 'BUILDING') AS segment
    FROM customer
    """,
)
def m1_map(t: Tables) -> DataFrame:
    def enrich(row: dict) -> dict:
        result = {
            "c_custkey": row["c_custkey"],
            "name": row["c_name"].lower(),
            "in_debt": row["c_acctbal"] < 0,
        }
        if row["c_mktsegment"] != "BUILDING":
            result["segment"] = row["c_mktsegment"]
        return result

    return map_rows(
        t.customer,
        enrich,
        "c_custkey bigint, name string, in_debt boolean, segment string",
        columns=["c_custkey", "c_name", "c_acctbal", "c_mktsegment"],
    )


@query(
    "k1_task",
    """
    SELECT lang, count(*) AS documents, max(length(text)) AS longest FROM documents GROUP BY lang
    """,
)
def k1_task(t: Tables) -> DataFrame:
    return task(
        t.documents,
        lambda df: df.groupBy("lang").agg(
            F.count(F.lit(1)).alias("documents"),
            F.max(F.length("text")).cast("bigint").alias("longest"),
        ),
    )


@query(
    "k2_batches",
    """
    SELECT conv_id, turn, length(text) AS chars, role = 'user' AS from_user FROM conversations
    """,
)
def k2_batches(t: Tables) -> DataFrame:
    def measure(rows: list[dict]) -> list[dict]:
        return [
            {
                "conv_id": row["conv_id"],
                "turn": row["turn"],
                "chars": len(row["text"]),
                "from_user": row["role"] == "user",
            }
            for row in rows
        ]

    return task_batches(
        t.conversations, measure, "conv_id bigint, turn bigint, chars bigint, from_user boolean"
    )


@query(
    "k2_batches_pandas",
    """
    SELECT l_orderkey, l_linenumber, round(l_quantity * 0.3 + l_tax * 0.7, 4) AS score
    FROM lineitem
    """,
)
def k2_batches_pandas(t: Tables) -> DataFrame:
    def score(frame: pd.DataFrame) -> pd.DataFrame:
        frame["score"] = (frame["l_quantity"] * 0.3 + frame["l_tax"] * 0.7).round(4)
        return frame[["l_orderkey", "l_linenumber", "score"]]

    return task_batches(
        t.lineitem,
        score,
        "l_orderkey bigint, l_linenumber int, score double",
        columns=["l_orderkey", "l_linenumber", "l_quantity", "l_tax"],
        frames=True,
    )


@query(
    "k3_groups",
    """
    SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean,
           round(max(value) - min(value), 2) AS spread
    FROM events GROUP BY event_type
    """,
)
def k3_groups(t: Tables) -> DataFrame:
    def condense(piece: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "event_type": piece["event_type"].head(1),
                "n": len(piece),
                "total": piece["value"].sum(),
                "low": piece["value"].min(),
                "high": piece["value"].max(),
            }
        )

    def merge(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "event_type": parts["event_type"].head(1),
                "n": parts["n"].sum(),
                "total": parts["total"].sum(),
                "low": parts["low"].min(),
                "high": parts["high"].max(),
            }
        )

    groups = task_groups(
        t.events,
        "event_type",
        condense,
        merge,
        "event_type string, n bigint, total double, low double, high double",
        columns="value",
    )
    return groups.select(
        "event_type",
        "n",
        F.round(F.col("total") / F.col("n"), 4).alias("mean"),
        F.round(F.col("high") - F.col("low"), 2).alias("spread"),
    )


@query(
    "k4_outcome",
    """
    SELECT count(*) AS row_count, count(*) FILTER (c_acctbal < 0) AS in_debt,
           CAST(sum(round(c_acctbal * 100)) AS BIGINT) AS cents
    FROM customer
    """,
)
def k4_outcome(t: Tables) -> DataFrame:
    def audit(rows: list[dict], report: Reporter) -> None:
        for row in rows:
            if row["c_acctbal"] < 0:
                report.warn("in debt")
            if not row["c_name"]:
                report.error("no name")
            report.add("cents", round(row["c_acctbal"] * 100))

    outcome = reported_batches(
        t.customer, audit, warnings=["in debt"], errors=["no name"], sums=["cents"]
    )
    write_file(outcome.df, t.scratch("k4"), "parquet")
    return t.spark.range(1).select(
        F.lit(outcome.row_count).cast("bigint").alias("row_count"),
        F.lit(outcome.warnings.get("in debt", 0)).cast("bigint").alias("in_debt"),
        F.lit(int(outcome.metadata["cents"])).cast("bigint").alias("cents"),
    )


@query(
    "k4_conditions",
    """
    SELECT count(*) AS row_count, count(*) FILTER (c_acctbal < 0) AS in_debt,
           max(c_acctbal) AS highest
    FROM customer
    """,
)
def k4_conditions(t: Tables) -> DataFrame:
    outcome = TaskOutcome(
        t.customer,
        warnings={"in debt": F.col("c_acctbal") < 0},
        errors={"no name": F.col("c_name").isNull()},
        metadata={"highest": F.max("c_acctbal")},
    )
    write_file(outcome.df, t.scratch("k4-conditions"), "parquet")
    return t.spark.range(1).select(
        F.lit(outcome.row_count).cast("bigint").alias("row_count"),
        F.lit(outcome.warnings.get("in debt", 0)).cast("bigint").alias("in_debt"),
        F.lit(outcome.metadata["highest"]).alias("highest"),
    )


# --- sinks ------------------------------------------------------------------


@query(
    "w1_csv", "SELECT * REPLACE (' ' || chr(9) || text || '  ' AS text) FROM documents"
)
def w1_csv(t: Tables) -> DataFrame:
    path = t.scratch("w1")
    documents = add_column(t.documents, "text", "' \\t' || text || '  '")
    # Texts have line breaks, so a file is read by one task.
    write_file(documents, path, "csv", options={"maxRecordsPerFile": 20_000})
    return read_file(t.spark, path, "csv", _schema(documents), multi_line=True)


@query("w2_json", "SELECT * FROM events")
def w2_json(t: Tables) -> DataFrame:
    path = t.scratch("w2")
    write_file(t.events, path, "json", "gzip")
    return read_file(t.spark, path, "json", _schema(t.events))


@query("w3_parquet", "SELECT * FROM lineitem")
def w3_parquet(t: Tables) -> DataFrame:
    path = t.scratch("w3")
    write_file(t.lineitem, path, "parquet", "snappy", partition_by="l_returnflag")
    return read_file(t.spark, path, "parquet", _schema(t.lineitem))


@query("w4_compress", "SELECT * FROM orders")
def w4_compress(t: Tables) -> DataFrame:
    path = t.scratch("w4")
    write_file(t.orders, path, "csv", "gzip")
    return read_file(t.spark, path, "csv", _schema(t.orders))


# The change set moves the price of finished orders and adds copies of pending ones.
CHANGES = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice,
           o_orderdate, o_orderpriority
    FROM {orders} WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM {orders} WHERE o_orderstatus = 'P'
"""
UPSERT_SQL = f"""
    SELECT * FROM orders WHERE o_orderstatus != 'F' UNION ALL {CHANGES.format(orders="orders")}
"""


@query("w6_upsert", UPSERT_SQL)
def w6_upsert(t: Tables) -> DataFrame:
    changes = run_query(t.spark, CHANGES, orders=t.orders)
    return upsert(t.orders, changes, "o_orderkey", order_by="o_totalprice")


# Some partition values are missing, some are empty; the table holds NULL for both.
ODD_PRIORITY = """CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN ''
    ELSE o_orderpriority END"""


@query(
    "w6_upsert_table",
    f"""
    WITH odd AS (SELECT * REPLACE ({ODD_PRIORITY} AS o_orderpriority) FROM orders),
    merged AS (
        SELECT * FROM odd WHERE o_orderstatus != 'F' OR nullif(o_orderpriority, '') IS NULL
        UNION ALL {CHANGES.format(orders="odd")})
    SELECT * REPLACE (nullif(o_orderpriority, '') AS o_orderpriority) FROM merged
    """,
)
def w6_upsert_table(t: Tables) -> DataFrame:
    path = t.scratch("w6")
    orders = add_column(t.orders, "o_orderpriority", ODD_PRIORITY)
    write_file(orders, path, "parquet", partition_by=["o_orderpriority", "o_orderstatus"])
    changes = run_query(t.spark, CHANGES, orders=orders)
    keys = ["o_orderkey", "o_orderpriority", "o_orderstatus"]
    upsert_table(changes, path, keys, ["o_orderpriority", "o_orderstatus"])
    return read_file(t.spark, path, "parquet", _schema(t.orders))


@query(
    "w7_requests",
    """
    SELECT 'https://crm.example.com/customers/' || c_custkey AS url, 'PUT' AS method,
           '{"name": "' || c_name || ' \\"the ' || c_nationkey || '\\"", "segment": "' || c_mktsegment || '"}' AS body
    FROM customer
    """,
)
def w7_requests(t: Tables) -> DataFrame:
    return render_requests(
        add_column(t.customer, "c_name", "c_name || ' \"the ' || c_nationkey || '\"'"),
        "https://crm.example.com/customers/{{ c_custkey }}",
        "PUT",
        '{"name": "{{ c_name }}", "segment": "{{c_mktsegment}}"}',
        {"Content-Type": "application/json"},
    ).select("url", "method", "body")


def _json_lines(lines: list[str]) -> bytes:
    return "".join(line + "\n" for line in lines).encode()


def _outbox(folder: str, ending: str = "json", pack: Callable = _json_lines) -> Callable[[list], None]:
    """Store lists as files named by task and turn, so that a repeated task replaces its own.

    Each attempt writes under a name of its own and moves the finished file.
    """
    turn = 0

    def store(rows: list) -> None:
        nonlocal turn
        turn += 1
        task = TaskContext.get()
        system, path = _file_system(folder)
        system.create_dir(path, recursive=True)
        name = f"part-{task.partitionId()}-{turn}.{ending}"
        draft = f"{path}/_{task.taskAttemptId()}-{name}"
        with system.open_output_stream(draft) as stream:
            stream.write(pack(rows))
        system.move(draft, f"{path}/{name}")

    return store


@query("w7_deliver", "SELECT event_id, user_id, event_type, value FROM events")
def w7_deliver(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "user_id", "event_type", "value")
    path = t.scratch("w7")
    store = _outbox(path)
    requests = render_requests(events, "https://ingest.example.com/events", batch_size=500)
    deliver(requests, lambda request: store([request["body"]]))
    payloads = t.spark.read.text(path)
    return parse_payload(payloads, "value", _schema(events))


@query("w7_deliver_once", "SELECT event_id, user_id, event_type, value FROM events")
def w7_deliver_once(t: Tables) -> DataFrame:
    """Three runs with one ledger; the first loses every other request, the last has nothing to do."""
    events = t.events.select("event_id", "user_id", "event_type", "value")
    path, ledger = t.scratch("w7-once"), t.scratch("w7-ledger")
    requests = render_requests(events, "https://ingest.example.com/events", batch_size=200)

    def transport(run: int) -> Callable[[dict], None]:
        def send(request: dict) -> None:
            key = request["headers"]["Idempotency-Key"]
            if run == 1 and int(key[0], 16) % 2:
                raise OSError("no answer")
            # A request that two runs deliver would be there twice.
            system, folder = _file_system(path)
            system.create_dir(folder, recursive=True)
            with system.open_output_stream(f"{folder}/{key}-{run}.json") as stream:
                stream.write(_json_lines([request["body"]]))

        return send

    for run in (1, 2, 3):
        deliver_once(requests, transport(run), ledger, slices=2)
    return parse_payload(t.spark.read.text(path), "value", _schema(events))


@query(
    "w8_arrow_table",
    "SELECT * FROM events WHERE event_type <> 'view' UNION ALL SELECT * FROM events WHERE user_id < 20",
)
def w8_arrow_table(t: Tables) -> DataFrame:
    """An overwritten table, then an append that readers see as a whole."""
    folder = t.scratch("w8-table")
    register_arrow_tables(t.spark)
    for mode, rows in (("append", t.events), ("overwrite", t.events.where("event_type <> 'view'")), ("append", t.events.where("user_id < 20"))):
        rows.write.format("arrow_table").mode(mode).save(folder)
    return read_arrow_table(t.spark, folder)


@query("w8_custom_sink", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def w8_custom_sink(t: Tables) -> DataFrame:
    path = t.scratch("w8")
    store = _outbox(path)
    suppliers = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    custom_sink(suppliers, lambda rows: store([json.dumps(row) for row in rows]))
    return read_file(t.spark, path, "json", _schema(suppliers))


# --- joins and totals along an order ------------------------------------------

#: Orders moved into the days of the events, no two at the same instant.
PLACED = """
    SELECT o_orderkey, o_custkey, o_orderdate, TIMESTAMP '2024-01-01' + to_days(CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30 AS INT))
           + to_seconds(o_orderkey % 86400) + to_microseconds(o_orderkey) AS placed
    FROM orders
"""


def _placed(t: Tables) -> DataFrame:
    day = "make_dt_interval(CAST(datediff(o_orderdate, DATE'1995-01-01') % 30 AS INT), 0, 0, CAST(o_orderkey % 86400 + o_orderkey / 1000000 AS DECIMAL(18, 6)))"
    return t.orders.selectExpr("o_orderkey", "o_custkey", f"TIMESTAMP_NTZ'2024-01-01 00:00:00' + {day} AS placed")


@query(
    "j7_asof",
    f"""
    SELECT event_id, user_id, ts, CASE WHEN near THEN o_custkey END AS o_custkey, CASE WHEN near THEN o_orderkey END AS o_orderkey,
           CASE WHEN near THEN placed END AS placed
    FROM (SELECT e.*, o.*, placed >= ts - INTERVAL 2 DAYS AS near
          FROM events e ASOF LEFT JOIN ({PLACED}) o ON e.user_id = o.o_custkey AND e.ts >= o.placed)
    """,
)
def j7_asof(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "user_id", "ts")
    return join_asof(events, _placed(t), "user_id=o_custkey", "ts", "placed", tolerance="INTERVAL 2 DAYS")


@query(
    "j7_asof_forward",
    f"""
    SELECT event_id, user_id, ts, o_custkey, o_orderkey, placed
    FROM events e ASOF JOIN ({PLACED}) o ON e.user_id = o.o_custkey AND e.ts < o.placed
    """,
)
def j7_asof_forward(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "user_id", "ts")
    return join_asof(events, _placed(t), "user_id=o_custkey", "ts", "placed", how="inner", direction="forward", exact=False)


@query(
    "j8_within",
    f"""
    SELECT event_id, user_id, ts, o_orderkey, o_custkey, placed, placed + to_hours(CAST(1 + o_orderkey % 24 AS INT)) AS until
    FROM events JOIN ({PLACED}) ON user_id = o_custkey AND ts >= placed AND ts < placed + to_hours(CAST(1 + o_orderkey % 24 AS INT))
    """,
)
def j8_within(t: Tables) -> DataFrame:
    windows = _placed(t).withColumn("until", F.expr("placed + make_dt_interval(0, CAST(1 + o_orderkey % 24 AS INT), 0, 0)"))
    return join_interval(t.events.select("event_id", "user_id", "ts"), windows, "ts", ("placed", "until"), "user_id=o_custkey")


@query(
    "j8_overlap",
    f"""
    SELECT event_id, ts, o_orderkey, placed FROM events LEFT JOIN ({PLACED})
    ON ts < placed + to_seconds(CAST(1 + 10 * (o_orderkey % 5) AS INT)) AND placed < ts + INTERVAL 20 SECONDS AND o_custkey % 5 = 0
    """,
)
def j8_overlap(t: Tables) -> DataFrame:
    """Without a key: events that take 20 seconds, and orders of some customers that take up to 41."""
    windows = _placed(t).where("o_custkey % 5 = 0")
    windows = windows.withColumn("until", F.expr("placed + make_dt_interval(0, 0, 0, 1 + 10 * (o_orderkey % 5))"))
    events = t.events.select("event_id", "ts", F.expr("ts + INTERVAL '20' SECOND").alias("done"))
    met = join_interval(events, windows, ("ts", "done"), ("placed", "until"), how="left")
    return met.select("event_id", "ts", "o_orderkey", "placed")


@query(
    "t12_running_total",
    """
    SELECT event_id, user_id, ts, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 2) AS spent,
           sum(event_id) OVER (ORDER BY ts RANGE UNBOUNDED PRECEDING)::BIGINT AS ids
    FROM events
    """,
)
def t12_running_total(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "user_id", "ts", "value")
    spent = running_total(events, "value", ["ts", "event_id"], "user_id", name="spent")
    both = running_total(spent, "event_id", "ts", name="ids")
    return both.select("event_id", "user_id", "ts", F.round("spent", 2).alias("spent"), "ids")


# --- runs, models, history, ingestion ---------------------------------------


@query(
    "r1_run_variables",
    """
    SELECT event_type, count(*) AS events FROM events
    WHERE ts >= DATE '2024-01-15' AND ts < DATE '2024-01-16' AND value > 5 GROUP BY event_type
    """,
)
def r1_run_variables(t: Tables) -> DataFrame:
    return run_query(
        t.spark,
        """
        SELECT event_type, count(*) AS events FROM {events}
        WHERE ts >= "{{ ds }}" AND ts < {{ next_ds }} AND value > {{ param.low }}
        GROUP BY event_type
        """,
        run_variables(ds="2024-01-15", params={"low": 5}),
        events=t.events,
    )


@query("r2_ingest", "SELECT event_id, event_type, value * 2 AS double_value FROM events")
def r2_ingest(t: Tables) -> DataFrame:
    events = t.events
    target = t.scratch("r2")
    ingest_new_files(
        t.spark,
        t.folder,
        events.schema,
        target,
        t.scratch("r2-checkpoint"),
        format="parquet",
        options={"pathGlobFilter": "events.parquet"},
        transform=lambda stream: add_column(stream, "double_value", "value * 2").select(
            "event_id", "event_type", "double_value"
        ),
    )
    return t.spark.read.parquet(target)


@query("r2_ingest_unique", "SELECT event_id, ts, user_id, value FROM events")
def r2_ingest_unique(t: Tables) -> DataFrame:
    """Two drops: the second repeats the last day of the first, and has rows that come weeks too late."""
    incoming, table, checkpoint = t.scratch("r2-drops"), t.scratch("r2-unique"), t.scratch("r2-state")
    events = t.events.selectExpr("event_id", "CAST(ts AS TIMESTAMP) AS ts", "user_id", "value")
    late = events.where("ts < TIMESTAMP'2024-01-02'").withColumn("event_id", -F.col("event_id") - 1)
    drops = [
        events.where("ts < TIMESTAMP'2024-01-16'"),
        fan_in(events.where("ts >= TIMESTAMP'2024-01-15'"), late),
    ]
    for drop in drops:
        write_file(drop, incoming, "parquet", mode="append")
        ingest_new_files(
            t.spark, incoming, events.schema, table, checkpoint, format="parquet", watermark=("ts", "2 days"), unique="event_id"
        )
    return t.spark.read.parquet(table).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "r2_checked_batches",
    """
    WITH drops AS (
        SELECT event_id % 3 AS batch, event_id, CASE WHEN event_id % 30 = 1 THEN NULL WHEN event_id % 30 = 2 THEN -value ELSE value END AS value
        FROM events
    ), report AS (
        SELECT batch, 'not_null' AS rule, count(*) AS total_rows, count(*) - count(value) AS failed_rows FROM drops GROUP BY batch
        UNION ALL SELECT batch, 'min', count(*), count(*) FILTER (value < 0) FROM drops GROUP BY batch
        UNION ALL SELECT batch, 'unique', count(*), 0 FROM drops GROUP BY batch
    )
    SELECT batch, rule, total_rows, failed_rows, failed_rows = 0 AS passed, batch = 1 AS aside FROM report
    """,
)
def r2_checked_batches(t: Tables) -> DataFrame:
    """Three drops: one is clean, one is set aside for NULLs, one breaks a rule that only warns."""
    incoming, table, checkpoint, history = (t.scratch(f"r2-checked-{name}") for name in ("in", "out", "state", "history"))
    odd = "if(event_id % 30 = 1, NULL, if(event_id % 30 = 2, -value, value)) AS value"
    events = t.events.selectExpr("event_id", odd)
    rules = ["not_null(value)", {"rule": "min", "column": "value", "params": {"min": 0}, "on_failure": "warn"}, "unique(event_id)"]
    for drop in range(3):
        write_file(events.where(F.col("event_id") % 3 == drop), incoming, "parquet", mode="append")
        ingest_new_files(t.spark, incoming, events.schema, checked_batches(table, rules, history), checkpoint, format="parquet")
    aside = t.spark.read.parquet(f"{table}-quarantine").select("batch").distinct().withColumn("aside", F.lit(True))
    report = batch_reports(t.spark, history).select("batch", "rule", "total_rows", "failed_rows", "passed")
    return report.join(aside.withColumn("batch", F.col("batch").cast("bigint")), "batch", "left").fillna(False, "aside")


@query(
    "r3_missing_dates",
    """
    SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE)
           AS run_date
    EXCEPT SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT'
    """,
)
def r3_missing_dates(t: Tables) -> DataFrame:
    urgent = filter_rows(t.orders, "o_orderpriority = '1-URGENT'")
    return missing_run_dates(urgent, "o_orderdate", "1995-01-01", "2001-12-31")


@query(
    "r3_backfill",
    """
    SELECT day, count(*) AS events, round(sum(value), 2) AS total,
           CASE WHEN day IN (SELECT CAST(ts AS DATE) FROM events WHERE value > 300)
                THEN 'first' ELSE 'backfill' END AS run
    FROM (SELECT CAST(ts AS DATE) AS day, value FROM events) GROUP BY day
    """,
)
def r3_backfill(t: Tables) -> DataFrame:
    events = t.events.select(F.col("ts").cast("date").alias("day"), "value")
    path = t.scratch("r3")

    def load(days: DataFrame, key: str, run: str) -> None:
        wanted = join(events, days, f"day={key}")
        fields = [
            {"column": "*", "function": "count", "alias": "events"},
            {"column": "value", "function": "sum", "alias": "total"},
        ]
        daily = aggregate(wanted, "day", fields).withColumn("run", F.lit(run))
        daily = add_column(daily, "total", "round(total, 2)")
        write_file(daily, path, "parquet", mode="overwrite", partition_by="day")

    busy = filter_rows(events, "value > 300").select(F.col("day").alias("busy_day")).distinct()
    load(busy, "busy_day", "first")
    schema = "events bigint, total double, run string, day date"
    target = read_file(t.spark, path, "parquet", schema)
    load(missing_run_dates(target, "day", "2024-01-01", "2024-01-30"), "run_date", "backfill")
    return read_file(t.spark, path, "parquet", schema)


MODELS = {
    "stg_orders": """
        SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate) AS year FROM {orders}
        WHERE o_orderstatus != 'P'
    """,
    "yearly": """
        SELECT year, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue
        FROM {stg_orders} GROUP BY year
    """,
    "buyers": "SELECT year, count(DISTINCT o_custkey) AS buyers FROM {stg_orders} GROUP BY year",
    "report": "SELECT y.*, b.buyers FROM {yearly} y JOIN {buyers} b ON y.year = b.year",
}


@query(
    "r4_models",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders,
           round(sum(o_totalprice), 2) AS revenue, count(DISTINCT o_custkey) AS buyers
    FROM orders WHERE o_orderstatus != 'P' GROUP BY 1
    """,
)
def r4_models(t: Tables) -> DataFrame:
    models = sql_models(
        t.spark, MODELS, {"orders": t.orders}, select=["report"], tables=["stg_orders"]
    )
    return models["report"]


ORDER_YEARS = """(
    SELECT DISTINCT year(o_orderdate) AS year FROM orders WHERE o_orderstatus != 'P')"""


@query(
    "r5_model_test",
    _report_sql(
        ("year", "unique", "block", "count(year) - count(DISTINCT year)", ORDER_YEARS),
        ("year", "not_null", "block", "0", ORDER_YEARS),
    ),
)
def r5_model_test(t: Tables) -> DataFrame:
    models = sql_models(t.spark, MODELS, {"orders": t.orders}, select=["yearly"])
    return quality_report(models["yearly"], ["unique(year)", "not_null(year)"])


@query("r6_seed", "SELECT * FROM part")
def r6_seed(t: Tables) -> DataFrame:
    path = t.scratch("r6-csv")
    write_file(t.part, path, "csv")
    return seed_table(t.spark, path, _schema(t.part), t.scratch("r6"))


@query(
    "r7_snapshot",
    """
    WITH fresh AS (
        SELECT c_custkey AS k, c_acctbal + CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS v
        FROM customer WHERE c_mktsegment != 'MACHINERY'
        UNION ALL SELECT -s_suppkey - 1, s_acctbal FROM supplier)
    SELECT c_custkey AS k, c_acctbal AS v, DATE '2024-01-01' AS valid_from,
           CASE WHEN c_mktsegment = 'BUILDING' THEN DATE '2024-02-01' END AS valid_to
    FROM customer
    UNION ALL
    SELECT f.k, f.v, DATE '2024-02-01', NULL FROM fresh f
    LEFT JOIN customer c ON f.k = c.c_custkey
    WHERE c.c_custkey IS NULL OR c.c_mktsegment = 'BUILDING'
    """,
)
def r7_snapshot(t: Tables) -> DataFrame:
    history = t.customer.selectExpr(
        "c_custkey AS k",
        "c_acctbal AS v",
        "date '2024-01-01' AS valid_from",
        "cast(NULL AS date) AS valid_to",
    )
    changed = filter_rows(t.customer, "c_mktsegment != 'MACHINERY'").selectExpr(
        "c_custkey AS k", "c_acctbal + if(c_mktsegment = 'BUILDING', 1, 0) AS v"
    )
    added = t.supplier.selectExpr("-s_suppkey - 1 AS k", "s_acctbal AS v")
    return snapshot(history, fan_in(changed, added), "k", "2024-02-01")


# --- end-to-end jobs --------------------------------------------------------


@query(
    "e1_export_events",
    """
    SELECT event_id, user_id, upper(event_type) AS event_type,
           CAST(json_extract(props, '$.k') AS INTEGER) AS k
    FROM events WHERE CAST(json_extract(props, '$.k') AS INTEGER) > 0 AND event_type != 'error'
    """,
)
def e1_export_events(t: Tables) -> DataFrame:
    path = t.scratch("e1")
    exported = jobs.export_events(t.events, path)
    return read_file(t.spark, path, "csv", _schema(exported))


@query(
    "e2_load_events",
    """
    SELECT event_id, ts AS event_time, user_id AS account_id, event_type, value FROM events
    """,
)
def e2_load_events(t: Tables) -> DataFrame:
    path = t.scratch("e2")
    clean = jobs.load_events(t.events, lambda df: write_file(df, path, "parquet", mode="append"))
    return read_file(t.spark, path, "parquet", clean.schema)


@query(
    "e3_customer_360",
    """
    SELECT *, CASE WHEN score > 1700000 THEN 'gold' WHEN score > 1230000 THEN 'silver'
              ELSE 'bronze' END AS tier
    FROM (
        SELECT c_custkey, c_name, c_mktsegment,
               round(coalesce(total_spent, 0), 2) AS total_spent,
               coalesce(order_count, 0) AS order_count,
               round(coalesce(total_spent, 0) * 0.6 + coalesce(order_count, 0) * 10, 2) AS score
        FROM customer LEFT JOIN (
            SELECT o_custkey, sum(o_totalprice) AS total_spent, count(*) AS order_count
            FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey)
    """,
)
def e3_customer_360(t: Tables) -> DataFrame:
    return jobs.customer_360(t.customer, t.orders)


@query(
    "e4_event_models",
    """
    SELECT CAST(ts AS DATE) AS day, count(*) AS events, count(DISTINCT user_id) AS users,
           round(sum(value) FILTER (event_type = 'purchase'), 2) AS revenue
    FROM events GROUP BY 1
    """,
)
def e4_event_models(t: Tables) -> DataFrame:
    return jobs.build_event_models(t.spark, t.events)[0]


@query(
    "e5_ingest_leads",
    """
    SELECT lower(c_name) || '@' || lower(c_mktsegment) || '.example.com' AS email,
           CASE c_mktsegment WHEN 'BUILDING' THEN 'Building Trade'
                ELSE upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' Trade' END AS name,
           replace(replace(CAST(c_acctbal AS VARCHAR), '-', ''), ' ', '') AS phone
    FROM customer WHERE c_mktsegment != 'FURNITURE'
    """,
)
def e5_ingest_leads(t: Tables) -> DataFrame:
    incoming, outbox = t.scratch("e5-incoming"), t.scratch("e5-outbox")
    domain = "if(c_mktsegment = 'FURNITURE', c_mktsegment, c_mktsegment || '.example.com')"
    leads = t.customer.selectExpr(
        f"'\\t' || c_name || '@' || {domain} || ' ' AS email",
        "' ' || c_mktsegment || ' trade' AS name",
        "'- ' || c_acctbal AS phone",
    )
    few = t.region.selectExpr("r_name || '@few.example.com' AS email", "r_name AS name", "'1' AS phone")
    push, table, checkpoint = _lead_outbox(outbox), t.scratch("e5"), t.scratch("e5-checkpoint")
    # A batch that is too small is set aside; the one after it is taken.
    for batch in (few, leads):
        write_file(batch, incoming, "csv", mode="append")
        jobs.ingest_leads(t.spark, incoming, table, checkpoint, push)
    return read_file(t.spark, outbox, "json", jobs.LEAD_SCHEMA)


def _lead_outbox(folder: str) -> Callable[[list[dict]], None]:
    store = _outbox(folder)
    return lambda rows: store([json.dumps(row) for row in rows])
