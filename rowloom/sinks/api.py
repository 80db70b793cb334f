"""Rendering rows as HTTP requests and delivering them."""

from __future__ import annotations

import re
import urllib.request
from collections.abc import Callable, Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.columns import column, require, require_columns
from rowloom.sinks.custom import run_sink

_PLACEHOLDER = re.compile(r"\{\{\s*(\w+)\s*\}\}")


def render_template(df: DataFrame, template: str, escape: Callable[[Column], Column] | None = None) -> Column:
    """A text with ``{{ column }}`` filled in per row, escaped if asked; NULL becomes empty text."""
    pieces = []
    position = 0
    for found in _PLACEHOLDER.finditer(template):
        require_columns(df, [found.group(1)], "render_template")
        if found.start() > position:
            pieces.append(F.lit(template[position : found.start()]))
        value = F.coalesce(column(found.group(1)).cast("string"), F.lit(""))
        pieces.append(escape(value) if escape else value)
        position = found.end()
    if position < len(template) or not pieces:
        pieces.append(F.lit(template[position:]))
    return F.concat(*pieces)


def json_text(value: Column) -> Column:
    """A value as it stands between the quotes of a JSON text."""
    whole = F.to_json(F.struct(value.alias("t")))
    return F.substring(whole, F.lit(7), F.char_length(whole) - 8)


def url_part(value: Column) -> Column:
    """A value as it stands in the path or query of a url."""
    return F.replace(F.url_encode(value), F.lit("+"), F.lit("%20"))


def render_requests(
    df: DataFrame,
    url: str,
    method: str = "POST",
    body_template: str = "",
    headers: Mapping[str, str] | None = None,
    batch_size: int = 1,
) -> DataFrame:
    """One request row ``(url, method, headers, body)`` per input row.

    The body is the row as a JSON object (NULL fields kept), or
    ``body_template`` with ``{{ column }}`` filled in, escaped for JSON text;
    ``url`` takes placeholders as well, their values are percent-encoded.  With ``batch_size`` above 1 each request carries a
    JSON list of up to that many bodies; rows are batched where they lie,
    without a shuffle, and the url is then fixed.
    """
    require(url, "render_requests: needs a url")
    if batch_size < 1:
        raise ValueError("render_requests: batch_size must be at least 1")
    if body_template:
        body = render_template(df, body_template, json_text)
    else:
        everything = F.struct(*[column(name) for name in df.columns])
        body = F.to_json(everything, {"ignoreNullFields": "false"})
    pairs = [F.lit(text) for pair in (headers or {}).items() for text in pair]
    header_map = (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,string>")
    fixed = [F.lit(method).alias("method"), header_map.alias("headers")]
    if batch_size == 1:
        return df.select(render_template(df, url, url_part).alias("url"), *fixed, body.alias("body"))
    if _PLACEHOLDER.search(url):
        raise ValueError("render_requests: a batched request cannot have a url per row")

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[str] = []
        for batch in batches:
            for text in batch.column(0).to_pylist():
                waiting.append(text)
                if len(waiting) == batch_size:
                    yield _body_batch(waiting)
                    waiting = []
        if waiting:
            yield _body_batch(waiting)

    bodies = df.select(body.alias("body")).mapInArrow(pack, "body string")
    return bodies.select(F.lit(url).alias("url"), *fixed, F.col("body"))


def _body_batch(texts: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"body": pa.array(["[" + ",".join(texts) + "]"])})


def http_transport(timeout: int = 30) -> Callable[[dict], None]:
    """A transport for ``deliver`` on the standard library; an HTTP error fails the task."""

    def send(request: dict) -> None:
        call = urllib.request.Request(
            request["url"],
            data=request["body"].encode(),
            headers=request["headers"] or {},
            method=request["method"],
        )
        with urllib.request.urlopen(call, timeout=timeout) as answer:
            answer.read()

    return send


def deliver(requests: DataFrame, transport: Callable[[dict], object]) -> None:
    """Hand every request dict to ``transport`` on the executors.

    At least once: a repeated task sends its requests again, so receivers
    should recognise repeats, for example by a key in the url or body.
    """

    def send(rows: list[dict]) -> None:
        for row in rows:
            transport(row)

    run_sink(requests, send)
