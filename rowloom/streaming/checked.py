"""Quality rules on the batches of a stream."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from rowloom.columns import require
from rowloom.operators.quality import quality_report
from rowloom.operators.rules import parse_quality_rules
from rowloom.session import materialize, release

log = logging.getLogger("rowloom.quality")

REPORT = "rule_no int, column string, rule string, on_failure string, total_rows bigint, failed_rows bigint, passed boolean"


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def checked_batches(
    table: str,
    rules: Sequence[str | Mapping],
    history: str,
    quarantine: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """Q10, Q11 on a stream: a sink for ``ingest_new_files`` that checks each batch first.

    The report of ``quality_report`` on a batch goes to the Parquet folder
    ``history`` under ``batch=<id>``.  A batch that breaks a rule with
    ``on_failure`` ``"block"`` goes to ``quarantine`` (by default ``table`` +
    ``-quarantine``), any other to ``table``, under the same name; the stream
    goes on either way, and broken rules are logged.

    After a failure a batch may come again under its id.  Its report is then
    the one that history has, so it goes where it went, even if a rule looks at
    the clock, and its folder is replaced: each batch is stored once.  ``unique``
    means inside the batch; over batches see ``unique`` of ``ingest_new_files``.
    """
    require(table, "checked_batches: needs a table folder")
    require(history, "checked_batches: needs a history folder")
    parse_quality_rules(rules)
    aside = quarantine or f"{table}-quarantine"

    def take(batch: DataFrame, batch_id: int) -> None:
        spark, place = batch.sparkSession, f"{history}/batch={batch_id}"
        received = materialize(batch, "batch")
        try:
            report = _stored(spark, place, REPORT)
            if report is None:
                quality_report(received, rules).coalesce(1).write.mode("overwrite").parquet(place)
                report = spark.read.schema(REPORT).parquet(place)
            broken = report.where("NOT passed").orderBy("rule_no").collect()
            blocked = any(line.on_failure == "block" for line in broken)
            received.write.mode("overwrite").parquet(f"{aside if blocked else table}/batch={batch_id}")
        finally:
            release(received)
        for line in broken:
            log.warning(
                "batch %s: rule %s(%s) broken by %s of %s rows%s",
                *(batch_id, line.rule, line.column, line.failed_rows, line.total_rows),
                ", set aside" if blocked else "",
            )

    return take


def batch_reports(spark: SparkSession, history: str) -> DataFrame:
    """The reports of all batches so far, one row per batch and rule."""
    schema = REPORT + ", batch bigint"
    found = _stored(spark, history, schema)
    return spark.createDataFrame([], schema) if found is None else found
