"""Data-pipeline operators for Spark: plain functions on DataFrames."""

from rowloom.errors import QualityError, RuleError, ValidationError
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
from rowloom.operators.rules import parse_quality_rule
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
from rowloom.plans.models import sql_models
from rowloom.session import materialize, release, ship_package, stages
from rowloom.sinks.api import deliver, http_transport, render_requests
from rowloom.sinks.custom import custom_sink
from rowloom.sinks.database import migrate, write_db
from rowloom.sinks.ledger import dead_letters, deliver_once
from rowloom.sinks.files import upsert, upsert_table, write_file
from rowloom.sources.api import api_source, http_fetch, open_payload, payload_shape, request_rows
from rowloom.sources.arrow_tables import read_arrow_table, register_arrow_tables, write_arrow_table
from rowloom.sources.custom import custom_source
from rowloom.sources.database import read_db
from rowloom.sources.files import read_file, seed_table
from rowloom.sources.sql import render_text, run_query, run_variables
from rowloom.streaming.checked import batch_reports, checked_batches
from rowloom.streaming.ingest import ingest_new_files

__all__ = [
    "QualityError",
    "Reporter",
    "RuleError",
    "TaskOutcome",
    "ValidationError",
    "add_column",
    "aggregate",
    "aggregate_sets",
    "api_source",
    "batch_reports",
    "branch",
    "checked_batches",
    "custom_sink",
    "custom_source",
    "dead_letters",
    "deduplicate",
    "deliver",
    "deliver_once",
    "drop_columns",
    "drop_null",
    "fan_in",
    "fan_out",
    "filter_py",
    "filter_rows",
    "http_fetch",
    "http_transport",
    "ingest_new_files",
    "join",
    "join_asof",
    "join_interval",
    "map_rows",
    "materialize",
    "migrate",
    "missing_run_dates",
    "open_payload",
    "parse_quality_rule",
    "payload_shape",
    "quality_gate",
    "quality_report",
    "read_arrow_table",
    "read_db",
    "read_file",
    "register_arrow_tables",
    "release",
    "rename",
    "render_requests",
    "render_text",
    "replace_values",
    "reported_batches",
    "request_rows",
    "run_query",
    "run_variables",
    "running_total",
    "seed_table",
    "ship_package",
    "snapshot",
    "sort",
    "sql_models",
    "stages",
    "task",
    "task_batches",
    "task_groups",
    "transform",
    "upsert",
    "upsert_table",
    "validate",
    "write_arrow_table",
    "write_db",
    "write_file",
]
