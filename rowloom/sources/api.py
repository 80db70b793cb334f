"""HTTP request rows in, JSON payload rows out."""

from __future__ import annotations

import urllib.request
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.columns import column, free_name, name_list, require, require_columns, require_unique_names
from rowloom.functions.rows import as_struct_type

REQUEST_SCHEMA = "url string, method string, headers map<string,string>, body string"


def http_fetch(timeout: int = 30) -> Callable[[dict], str]:
    """A fetch function for ``api_source`` on the standard library."""

    def fetch(request: dict) -> str:
        body = request["body"]
        call = urllib.request.Request(
            request["url"],
            data=body.encode() if body else None,
            headers=request["headers"] or {},
            method=request["method"] or "GET",
        )
        with urllib.request.urlopen(call, timeout=timeout) as answer:
            return answer.read().decode()

    return fetch


def request_rows(
    spark: SparkSession,
    urls: str | Iterable[str],
    method: str = "GET",
    headers: Mapping[str, str] | None = None,
    body: str | None = None,
) -> DataFrame:
    """Build request rows from a url, or from a list of them (pages, days).

    For very many requests build the DataFrame with Spark instead.
    """
    require(urls, "request_rows: needs a url")
    addresses = [urls] if isinstance(urls, str) else list(urls)
    rows = [(url, method, dict(headers or {}), body) for url in addresses]
    return spark.createDataFrame(rows, REQUEST_SCHEMA)


def api_source(
    requests: DataFrame,
    fetch: Callable[[dict], str],
    schema: str | T.StructType,
    *,
    parallelism: int | None = None,
) -> DataFrame:
    """Send one request per input row from the executors, return payload rows.

    ``requests`` has a ``url`` and optionally ``method``, ``headers``, ``body``.
    ``fetch(request_dict)`` returns the response text and is injected, so
    authentication, paging and tests are the caller's; ``http_fetch()`` is one.
    The payload is a JSON list of objects, or one object; ``schema`` describes
    an object.  A payload that is not such JSON fails the job rather than
    vanish, and so does an empty answer (an empty list is an answer).  ``parallelism`` spreads the requests over that many tasks.  A lost
    task repeats its requests.
    """
    require_columns(requests, ["url"], "api_source")
    record = as_struct_type(schema)
    fields = T.StructType.fromDDL(REQUEST_SCHEMA)
    calls = requests.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in requests.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in fields
        ]
    )
    if parallelism:
        calls = calls.repartition(parallelism)

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One response at a time: payloads can be large.
            for index in range(batch.num_rows):
                request = batch.slice(index, 1).to_pylist(maps_as_pydicts="strict")[0]
                yield pa.RecordBatch.from_pydict(
                    {"payload": pa.array([fetch(request)], pa.string())}
                )

    payloads = calls.mapInArrow(send, "payload string")
    empty = F.trim(F.coalesce("payload", F.lit(""))) == ""
    failed = F.raise_error(F.lit("api_source: empty answer")).cast("string")
    payloads = payloads.select(F.when(empty, failed).otherwise(F.col("payload")).alias("payload"))
    return parse_payload(payloads, "payload", record)


def parse_payload(
    df: DataFrame,
    name: str,
    schema: str | T.StructType,
    keep: str | Sequence[str] | None = None,
    *,
    outer: bool = False,
) -> DataFrame:
    """Turn a column of JSON lists (or objects) into one row per object.

    The columns in ``keep`` are repeated beside each object.  Malformed JSON
    fails the job.  A NULL payload and an empty list hold no object and give no
    row; with ``outer=True`` they give one, with NULL in the fields of ``schema``.
    """
    rows = F.from_json(
        column(name), T.ArrayType(as_struct_type(schema)), {"mode": "FAILFAST"}
    )
    return df.select(*[column(other) for other in name_list(keep)], F.inline_outer(rows) if outer else F.inline(rows))


def open_payload(
    df: DataFrame,
    name: str,
    fields: Mapping[str, tuple[str, str]],
    keep: str | Sequence[str] | None = None,
    *,
    malformed: str = "fail",
    strict: bool = False,
) -> DataFrame:
    """Typed fields of JSON texts whose shape is not declared, by way of VARIANT.

    ``fields`` maps an output column to (path, type), such as
    ``("$.address.city", "string")``.  Each text is parsed once; columns in
    ``keep`` stay beside the fields.  A missing path is NULL; a value that does
    not fit its type is NULL too, or fails the job with ``strict``.  NULL texts
    have only NULL fields.  Malformed JSON fails the job, or counts as NULL with
    ``malformed="null"``.
    """
    require(fields, "open_payload: needs fields {name: (path, type)}")
    if malformed not in ("fail", "null"):
        raise ValueError(f"open_payload: malformed must be fail or null, not {malformed!r}")
    require_columns(df, [name, *name_list(keep)], "open_payload")
    require_unique_names([*name_list(keep), *fields], "open_payload")
    parse = F.parse_json if malformed == "fail" else F.try_parse_json
    get = F.variant_get if strict else F.try_variant_get
    payload = free_name("payload", df)
    parsed = df.withColumn(payload, parse(column(name)))
    values = [get(column(payload), path, kind).alias(out) for out, (path, kind) in fields.items()]
    return parsed.select(*[column(other) for other in name_list(keep)], *values)


def payload_shape(df: DataFrame, name: str) -> str:
    """The type that covers the JSON texts of a column, as DDL: what ``open_payload`` may be asked for.

    One aggregate over all rows; only the type reaches the driver.  NULLs and
    malformed texts say nothing.
    """
    require_columns(df, [name], "payload_shape")
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(column(name)))).first()[0]
