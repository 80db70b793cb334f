"""End-to-end jobs built from the operators."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.errors import ValidationError
from rowloom.functions.rows import filter_py
from rowloom.operators.branching import branch
from rowloom.operators.combine import join
from rowloom.operators.quality import quality_gate, validate
from rowloom.operators.transforms import add_column, aggregate, transform
from rowloom.plans.models import sql_models
from rowloom.session import materialize, release
from rowloom.sinks.custom import custom_sink
from rowloom.sinks.files import write_file
from rowloom.sources.api import parse_payload
from rowloom.streaming.ingest import ingest_new_files


log = logging.getLogger("rowloom.jobs")


def export_events(events: DataFrame, path: str) -> DataFrame:
    """Parse JSON payloads, derive columns, keep the interesting rows, write CSV."""
    rows = parse_payload(events, "props", "k int", keep=["event_id", "user_id", "event_type"])
    rows = rows.select(
        "event_id",
        "user_id",
        F.upper("event_type").alias("event_type"),
        F.coalesce("k", F.lit(0)).alias("k"),
    )
    kept = filter_py(rows, (F.col("k") > 0) & (F.col("event_type") != "ERROR"))
    return write_file(kept, path, "csv")


def load_events(events: DataFrame, load: Callable[[DataFrame], object]) -> DataFrame:
    """Check the dataset twice, rename and drop columns, load it."""
    checked = validate(
        events,
        lambda df: (
            F.count(F.lit(1)) > 0,
            F.concat(F.lit("received "), F.count(F.lit(1)).cast("string"), F.lit(" events")),
        ),
    )
    missing = F.count_if(F.col("event_type").isNull() | (F.col("event_type") == ""))
    checked = validate(
        checked,
        lambda df: (missing == 0, F.concat(missing.cast("string"), F.lit(" without type"))),
        on_failure="warn",
    )
    clean = transform(
        checked,
        [
            {"type": "rename_columns", "mapping": {"ts": "event_time", "user_id": "account_id"}},
            {"type": "drop_columns", "columns": ["props"]},
        ],
    )
    load(clean)
    return clean


def customer_360(
    customers: DataFrame,
    orders: DataFrame,
    *,
    gold: float = 1_700_000,
    silver: float = 1_230_000,
    reuse: str | None = "table",
) -> DataFrame:
    """E3, the flagship: customers with order totals, checked, scored and tiered.

    Orders are summed per customer before the join, which makes the right side
    unique, so the plain left join is safe against customers with very many
    orders.  The gate reads the joined rows twice; by default they are written
    once to the shared folder and the gate and all later work read that.  Run
    the job and the writing of its result inside ``stages()``, which removes
    that copy at the end.
    """
    totals = aggregate(
        orders,
        "o_custkey",
        [
            {"column": "o_totalprice", "function": "sum", "alias": "total_spent"},
            {"column": "*", "function": "count", "alias": "order_count"},
        ],
    )
    merged = join(customers, totals, "c_custkey=o_custkey", "left", right_unique=True)
    checked = quality_gate(
        merged.drop("o_custkey"),
        ["not_null(c_name)", "unique(c_custkey)", "min(total_spent, 0)"],
        reuse=reuse,
    )
    spent = F.coalesce("total_spent", F.lit(0.0))
    count = F.coalesce("order_count", F.lit(0))
    scored = add_column(checked, "score", F.round(spent * 0.6 + count * 10, 2))
    tier = (
        F.when(F.col("score") > gold, "gold")
        .when(F.col("score") > silver, "silver")
        .otherwise("bronze")
    )
    return add_column(scored, "tier", tier).select(
        "c_custkey",
        "c_name",
        "c_mktsegment",
        F.round(spent, 2).alias("total_spent"),
        count.alias("order_count"),
        "score",
        "tier",
    )


EVENT_MODELS = {
    "staging_events": """
        SELECT event_id, CAST(ts AS DATE) AS day, user_id, event_type, value
        FROM {events} WHERE event_type IS NOT NULL
    """,
    "revenue": """
        SELECT day, round(sum(value), 2) AS revenue
        FROM {staging_events} WHERE event_type = 'purchase' GROUP BY day
    """,
    "engagement": """
        SELECT day, count(*) AS events, count(DISTINCT user_id) AS users
        FROM {staging_events} GROUP BY day
    """,
}


def build_event_models(spark: SparkSession, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Build chained SQL models, then branch on whether they are sound.

    Returns the daily report as ``(sound, unsound)``; one of them is empty.
    """
    models = sql_models(spark, EVENT_MODELS, {"events": events}, select=["revenue", "engagement"])
    report = join(
        models["engagement"],
        models["revenue"],
        "day",
        "left",
        right_unique=True,
    )
    return branch(
        report,
        lambda df: F.bool_and(F.col("users") <= F.col("events")) & (F.count(F.lit(1)) > 0),
        reuse="table",
    )


LEAD_SCHEMA = "email string, name string, phone string"


def clean_leads(leads: DataFrame) -> DataFrame:
    """Row-wise clean-up of partner leads; works on streams.

    Trims all white space (not only blanks), lower-cases addresses, and
    capitalises names the way ``initcap`` does.
    """

    def trimmed(name: str):
        return F.regexp_replace(F.coalesce(name, F.lit("")), r"^\s+|\s+$", "")

    cleaned = leads.select(
        F.lower(trimmed("email")).alias("email"),
        F.initcap(trimmed("name")).alias("name"),
        F.translate(F.coalesce("phone", F.lit("")), "- ", "").alias("phone"),
    )
    domain = F.element_at(F.split("email", "@"), -1)
    return cleaned.filter(F.contains(F.col("email"), F.lit("@")) & F.contains(domain, F.lit(".")))


def ingest_leads(
    spark: SparkSession,
    incoming: str,
    table: str,
    checkpoint: str,
    push: Callable[[list[dict]], object],
    *,
    minimum: int = 10,
) -> DataFrame:
    """E5: take new lead files, clean them, require a minimum, push them on.

    A batch is checked before anything is stored.  One with fewer than
    ``minimum`` leads goes to the folder ``table`` + ``-quarantine`` and is
    reported in the log, and the stream goes on; any other ends up in ``table``
    and is handed to ``push`` on the executors.  Both folders hold each batch
    id once.
    """
    quarantine = f"{table}-quarantine"
    rejected = []

    def take(batch: DataFrame, batch_id: int) -> None:
        received = materialize(batch, "leads")
        enough = F.count(F.lit(1)) >= minimum
        message = F.concat(F.lit("got "), F.count(F.lit(1)).cast("string"), F.lit(" leads"))
        try:
            validate(received, lambda df: (enough, message))
        except ValidationError as error:
            # The same batch id replaces its own folder, so a repeat adds nothing.
            received.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
            rejected.append(f"batch {batch_id}: {error}")
        else:
            target = f"{table}/batch={batch_id}"
            received.write.mode("overwrite").parquet(target)
            custom_sink(received, push)
        release(received)

    ingest_new_files(
        spark, incoming, LEAD_SCHEMA, take, checkpoint, format="csv", transform=clean_leads
    )
    for reason in rejected:
        log.warning("leads in quarantine (%s), %s", quarantine, reason)
    stored = LEAD_SCHEMA + ", batch bigint"
    try:
        return spark.read.schema(stored).parquet(table)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], stored)
