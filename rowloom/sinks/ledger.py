"""Delivery of requests with a ledger, so that a repeated run sends only what is missing."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.columns import column, require, require_columns
from rowloom.functions.rows import from_dicts, to_dicts
from rowloom.session import materialize, release

LEDGER = (
    "request_id string, run string, at timestamp, status string, error string, "
    "url string, method string, headers map<string,string>, body string"
)
OUTCOME = "request_id string, status string, error string, url string, method string, headers map<string,string>, body string"
KEY_HEADER = "Idempotency-Key"


def request_ids(requests: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """Requests with ``request_id``, a digest of the columns ``key`` or else of method, url and body.

    The id is sent along as a header, by which a receiver knows a repeat.
    """
    names = list(key or ["method", "url", "body"])
    require_columns(requests, [*names, "url", "method", "headers", "body"], "deliver_once")
    ident = F.sha2(F.to_json(F.struct(*[column(name) for name in names]), {"ignoreNullFields": "false"}), 256)
    headers = F.map_concat(
        F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda name, _: F.lower(name) != KEY_HEADER.lower()),
        F.create_map(F.lit(KEY_HEADER), F.col("request_id")),
    )
    keyed = requests.withColumn("request_id", ident)
    return keyed.select("request_id", "url", "method", headers.alias("headers"), "body")


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All attempts so far; none for a ledger that does not exist yet."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def _settled(attempts: DataFrame, max_attempts: int) -> DataFrame:
    """Ids that need no further attempt, with ``delivered``."""
    counted = attempts.groupBy("request_id").agg(F.bool_or(F.col("status") == "delivered").alias("delivered"), F.count(F.lit(1)).alias("attempts"))
    return counted.where(F.col("delivered") | (F.col("attempts") >= max_attempts))


def deliver_once(
    requests: DataFrame,
    transport: Callable[[dict], object],
    ledger: str,
    *,
    key: Sequence[str] | None = None,
    max_attempts: int = 3,
    slices: int = 8,
) -> DataFrame:
    """Hand requests to ``transport`` unless the ledger says that they were delivered.

    Each request gets an id (``request_ids``); requests with one id are one
    request.  What the ledger, a Parquet folder, holds as delivered is left out
    by an anti join, and so are dead letters: requests that failed
    ``max_attempts`` times.  An exception of ``transport`` is a failure of that
    request alone and is written down with its text and the request.  Returns
    the attempts of this run.

    The pending requests are written to the shared folder and sent in
    ``slices``, each a job that appends its attempts to the ledger when it ends.
    So a run that dies half-way sends again what its last slice had sent, and
    nothing else; within that bound delivery is at least once, and a receiver
    tells repeats by the header ``Idempotency-Key``.
    """
    require(ledger, "deliver_once: needs a ledger folder")
    if max_attempts < 1 or slices < 1:
        raise ValueError("deliver_once: max_attempts and slices must be at least 1")
    spark = requests.sparkSession
    run = uuid.uuid4().hex

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in to_dicts(batch.schema.names, batch.columns):
                done = []
                for row in rows:
                    status, error = "delivered", None
                    try:
                        transport({name: row[name] for name in ("url", "method", "headers", "body")})
                    except Exception as failure:
                        status, error = "failed", f"{type(failure).__name__}: {failure}"[:2000]
                    kept = row if error else {"request_id": row["request_id"]}
                    done.append({**kept, "status": status, "error": error})
                yield from from_dicts(done, arrow)

    arrow = pa.schema(
        [(name, pa.string()) for name in ("request_id", "status", "error", "url", "method")]
        + [("headers", pa.map_(pa.string(), pa.string())), ("body", pa.string())]
    )
    keyed = request_ids(requests, key).dropDuplicates(["request_id"])
    open_ones = keyed.join(_settled(read_ledger(spark, ledger), max_attempts), "request_id", "left_anti")
    pending = materialize(open_ones.withColumn("slice", F.pmod(F.xxhash64("request_id"), F.lit(slices)).cast("int")), "pending")
    try:
        for number in range(slices):
            part = pending.where(F.col("slice") == number).drop("slice")
            sent = part.mapInArrow(send, OUTCOME)
            stamped = sent.withColumns({"run": F.lit(run), "at": F.current_timestamp()})
            stamped.select(*[name.split()[0] for name in LEDGER.split(", ")]).write.mode("append").parquet(ledger)
    finally:
        release(pending)
    return read_ledger(spark, ledger).where(F.col("run") == run)


def dead_letters(spark: SparkSession, ledger: str, max_attempts: int = 3) -> DataFrame:
    """Requests that failed ``max_attempts`` times or more and were never delivered: the last attempt of each, and their number."""
    attempts = read_ledger(spark, ledger)
    dead = _settled(attempts, max_attempts).where(~F.col("delivered")).select("request_id", "attempts")
    last = attempts.groupBy("request_id").agg(F.max_by(F.struct("at", "error", "url", "method", "headers", "body"), "at").alias("last"))
    return dead.join(last, "request_id").select("request_id", "attempts", "last.*")
