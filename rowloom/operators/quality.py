"""Data-quality reports, gates and dataset checks."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal, InvalidOperation
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.columns import column, require_batch, require_columns
from rowloom.errors import QualityError, ValidationError
from rowloom.operators.combine import reusable
from rowloom.operators.rules import parse_quality_rules
from rowloom.session import release

log = logging.getLogger("rowloom.quality")

# Expected types of type_check, with the spellings accepted for
# each, the Spark types a typed column may have, and the cast a text column
# must survive.
EXPECTED_TYPES = {
    "int": (("int", "integer", "long", "bigint"), (T.IntegralType,), "bigint"),
    "float": (
        ("float", "double", "number", "numeric"),
        (T.FractionalType, T.IntegralType),
        "double",
    ),
    "string": (("string", "str", "text"), (T.StringType,), "string"),
    "bool": (("bool", "boolean"), (T.BooleanType,), "boolean"),
    "date": (("date",), (T.DateType,), "date"),
    "timestamp": (
        ("timestamp", "datetime"),
        (T.TimestampType, T.TimestampNTZType),
        "timestamp_ntz",
    ),
}


def quality_report(
    df: DataFrame,
    rules: Sequence[str | Mapping],
    as_of: datetime | str | None = None,
    *,
    reuse: str | None = None,
) -> DataFrame:
    """Q10: measure every rule; one output row per rule.

    Output: ``rule_no, column, rule, on_failure, total_rows, failed_rows,
    passed``.  What counts as failed:

    * not_null: the value is NULL
    * unique: non-NULL values minus distinct non-NULL values
    * min, max, range: the value lies outside the inclusive bounds; NULL
      passes, NaN is greater than any number.  In a text column a bound that is
      a number compares numbers, and a text that is none fails; other bounds
      compare texts
    * row_count: 1 when the number of rows is outside the bounds
    * freshness: 1 when the newest value is older than ``max_hours`` (24 unless
      given) before ``as_of`` (now unless given), or when there is no value
    * regex: the text holds no match (search, not full match); NULL passes
    * type_check: a text value that cannot be cast to the type; a column that
      is not text either has the type or fails with all its non-NULL values.
      Whole-number columns satisfy ``float``.

    Plan: all rules but ``unique`` are one aggregate whose shuffle carries a
    single row per task.  Each ``unique`` rule is a grouped count of its own
    over just that column, combined before the shuffle, so a value that fills
    a large share of the table costs no more than others and no row is
    multiplied.  Everything runs as one job.  Each of these parts reads ``df``:
    over files that is a narrow scan, a computed input is better written once
    first (``reuse="table"``).
    """
    require_batch(df, "quality_report", "check each batch inside foreachBatch")
    parsed = parse_quality_rules(rules)
    require_columns(df, [r["column"] for r in parsed if r["column"]], "quality_report")
    df = reusable(df, reuse)

    measured = [
        (number, rule, _failed(df, rule, as_of))
        for number, rule in enumerate(parsed, start=1)
        if rule["rule"] != "unique"
    ]
    parts = []
    if measured:
        totals = df.agg(
            F.count(F.lit(1)).alias("total"),
            *[failed.cast("bigint").alias(f"failed_{number}") for number, _, failed in measured],
        )
        lines = F.array(
            *[
                _line(number, rule, F.col("total"), F.col(f"failed_{number}"))
                for number, rule, _ in measured
            ]
        )
        parts.append(totals.select(F.inline(lines)))
    for number, rule in enumerate(parsed, start=1):
        if rule["rule"] == "unique":
            parts.append(_unique_line(df, number, rule))
    report = reduce(DataFrame.unionAll, parts)
    return report.withColumn("passed", F.col("failed_rows") == 0)


def _line(number: int, rule: Mapping, total: Column, failed: Column) -> Column:
    return F.struct(
        F.lit(number).alias("rule_no"),
        F.lit(rule["column"]).alias("column"),
        F.lit(rule["rule"]).alias("rule"),
        F.lit(rule["on_failure"]).alias("on_failure"),
        total.alias("total_rows"),
        failed.alias("failed_rows"),
    )


def _unique_line(df: DataFrame, number: int, rule: Mapping) -> DataFrame:
    counts = (
        df.select(column(rule["column"]).alias("value"))
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    surplus = F.when(F.col("value").isNotNull(), F.col("copies") - 1)
    sums = counts.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.sum(surplus), F.lit(0)).cast("bigint").alias("failed"),
    )
    return sums.select(F.inline(F.array(_line(number, rule, F.col("total"), F.col("failed")))))


def _failed(df: DataFrame, rule: Mapping, as_of) -> Column:
    """The aggregate that counts what a rule rejects."""
    name, params = rule["rule"], rule["params"]
    if name == "row_count":
        return _outside_row_count(params)
    value = column(rule["column"])
    data_type = df.schema[rule["column"]].dataType
    if name == "not_null":
        return F.count_if(value.isNull())
    if name == "regex":
        return F.count_if(~value.cast("string").rlike(params["pattern"]))
    if name == "freshness":
        return _stale(value, data_type, params, as_of)
    if name == "type_check":
        return _wrong_type(value, data_type, params["expected_type"])
    outside = []
    for side in ("min", "max"):
        if side in params:
            held, limit = value, None
            if isinstance(data_type, T.StringType) and _number(params[side]) is not None:
                # Text columns hold numbers when the bound is one; what is none fails.
                held, limit = value.try_cast("double"), F.lit(_number(params[side]))
                outside.append(value.isNotNull() & held.isNull())
            else:
                limit = bound(data_type, params[side])
            outside.append(held < limit if side == "min" else held > limit)
    outside = [F.coalesce(part, F.lit(False)) for part in outside]
    return F.count_if(reduce(lambda a, b: a | b, outside))


def _number(text) -> float | None:
    try:
        return float(str(text))
    except ValueError:
        return None


def bound(data_type: T.DataType, text) -> Column:
    """Turn a rule's parameter into a literal fit for comparison with a column.

    A parameter that cannot be read as the column's type is a ``ValueError``
    before any job starts.
    """
    try:
        if isinstance(data_type, (T.FloatType, T.DoubleType)):
            return F.lit(float(text))
        if isinstance(data_type, T.NumericType):
            number = Decimal(str(text))
            if not number.is_finite():
                raise ValueError("not a finite number")
            return F.lit(int(number)) if number == int(number) else F.lit(number)
        if isinstance(data_type, T.DateType):
            return F.lit(date.fromisoformat(str(text)))
        if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
            return F.lit(datetime.fromisoformat(str(text)).isoformat(sep=" ")).cast(data_type)
    except (ValueError, InvalidOperation) as error:
        raise ValueError(
            f"quality bound {text!r} does not fit a column of type {data_type.simpleString()}"
        ) from error
    if isinstance(data_type, T.StringType):
        return F.lit(str(text))
    raise ValueError(f"quality bounds do not apply to type {data_type.simpleString()}")


def _outside_row_count(params: Mapping) -> Column:
    unknown = set(params) - {"min", "max"}
    if unknown:
        raise ValueError(f"row_count: unknown bounds {sorted(unknown)}")
    total = F.count(F.lit(1))
    outside = F.lit(False)
    if "min" in params:
        outside = outside | (total < int(params["min"]))
    if "max" in params:
        outside = outside | (total > int(params["max"]))
    return outside.cast("bigint")


def _stale(value: Column, data_type: T.DataType, params: Mapping, as_of) -> Column:
    unknown = set(params) - {"max_hours"}
    if unknown:
        raise ValueError(f"freshness: unknown option {sorted(unknown)}")
    kind = "timestamp" if isinstance(data_type, T.TimestampType) else "timestamp_ntz"
    if as_of is None:
        now = F.current_timestamp() if kind == "timestamp" else F.localtimestamp()
    else:
        now = F.lit(as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else as_of).cast(kind)
    seconds = Decimal(str(params.get("max_hours", 24))) * 3600
    cutoff = now - F.make_dt_interval(secs=F.lit(seconds))
    moment = value.try_cast(kind) if isinstance(data_type, T.StringType) else value.cast(kind)
    return F.when(F.max(moment) >= cutoff, F.lit(0)).otherwise(F.lit(1))


def _wrong_type(value: Column, data_type: T.DataType, expected: str) -> Column:
    for spellings, accepted, cast in EXPECTED_TYPES.values():
        if str(expected).lower() in spellings:
            break
    else:
        raise ValueError(f"type_check: unknown type {expected!r}; use {list(EXPECTED_TYPES)}")
    if isinstance(data_type, T.StringType):
        return F.count_if(value.isNotNull() & value.try_cast(cast).isNull())
    if isinstance(data_type, accepted):
        return F.count_if(F.lit(False))
    return F.count(value)


def quality_gate(
    df: DataFrame,
    rules: Sequence[str | Mapping],
    as_of: datetime | str | None = None,
    *,
    reuse: str | None = "table",
) -> DataFrame:
    """Q11: report on ``df``, stop on a failed ``block`` rule, else pass it on.

    Only ``"block"`` stops, with ``QualityError``; any other ``on_failure``
    logs a warning.  A gate has to run a job before the rest of the plan.
    By default (``reuse="table"``) the rows are written once to the shared
    folder, so that rules and what follows read the same rows and nothing is
    computed twice; ``stages`` or ``release`` removes them.  ``"persist"`` keeps
    them on the executors, ``None`` computes them again.
    """
    parse_quality_rules(rules)
    checked = reusable(df, reuse)
    report = [
        row.asDict()
        for row in quality_report(checked, rules, as_of).orderBy("rule_no").collect()
    ]
    if any(not line["passed"] and line["on_failure"] == "block" for line in report):
        if reuse == "persist":
            checked.unpersist()
        if reuse == "table":
            release(checked)
        raise QualityError(report)
    for line in report:
        if not line["passed"]:
            log.warning(
                "quality rule %s(%s): %s of %s rows failed",
                line["rule"],
                line["column"],
                line["failed_rows"],
                line["total_rows"],
            )
    return checked


def validate(
    df: DataFrame,
    check: Callable[[DataFrame], DataFrame | Column | tuple],
    on_failure: str = "block",
    *,
    reuse: str | None = None,
) -> DataFrame:
    """Q12: run a check over the whole dataset and pass the data on.

    ``check(df)`` describes the verdict as an aggregate, so it is computed on
    the executors: a boolean aggregate ``Column``, a pair of it and a message
    ``Column`` (or text), or a one-row DataFrame ``(passed[, message])``.
    A NULL verdict is a failure.  Only ``on_failure="block"`` raises
    ``ValidationError``; anything else logs a warning.
    """
    require_batch(df, "validate", "validate each batch inside foreachBatch")
    checked = reusable(df, reuse)
    verdict = check(checked)
    if not isinstance(verdict, DataFrame):
        passed, message = verdict if isinstance(verdict, tuple) else (verdict, "")
        message = F.lit(message) if isinstance(message, str) else message
        verdict = checked.agg(passed.alias("passed"), message.cast("string").alias("message"))
    rows = verdict.take(2)
    if len(rows) != 1:
        raise ValueError("validate: the check must give exactly one row")
    passed, message = rows[0][0], rows[0][1] if len(rows[0]) > 1 else ""
    if not passed:
        if on_failure == "block":
            if reuse == "persist":
                checked.unpersist()
            raise ValidationError(message or "validation failed")
        log.warning("validation failed: %s", message)
    elif message:
        log.info("validation passed: %s", message)
    return checked
