"""Dataset-level branching."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.columns import require, require_batch
from rowloom.operators.combine import reusable


def branch(
    df: DataFrame,
    predicate: str | Callable[[DataFrame], Column],
    *,
    statistics: Mapping[str, Column] | None = None,
    reuse: str | None = None,
    lazy: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Send a whole dataset down one of two branches.

    Returns ``(if_true, if_false)``: one is the input, the other is empty with
    the same schema.  ``predicate`` is either an expression over dataset
    statistics (``row_count``, plus any aggregates named in ``statistics``)
    or a function giving one boolean aggregate ``Column``, for example
    ``lambda df: F.bool_and(df.id.isNotNull()) & (F.count("*") > 100)``.
    The value alone decides, also for an empty input; NULL counts as false.

    The predicate is one aggregate, evaluated right away; a single boolean
    reaches the driver and the branch not taken costs nothing.  With ``lazy``
    nothing runs yet: both branches are filters on a scalar subquery, which
    runs once before the rows of a plan that uses them, and the branch not
    taken still reads its input.  ``reuse`` would write the input at once, so
    it does not go with ``lazy``.
    """
    require_batch(df, "branch", "branch inside foreachBatch")
    if lazy and reuse:
        raise ValueError("branch: reuse runs the input at once, which lazy forbids")
    source = reusable(df, reuse)
    if isinstance(predicate, str):
        require(predicate.strip(), "branch: needs an expression")
        measured = source.agg(
            F.count(F.lit(1)).alias("row_count"),
            *[value.alias(name) for name, value in (statistics or {}).items()],
        )
        flag = measured.select(F.expr(predicate).cast("boolean"))
    else:
        flag = source.agg(predicate(source).cast("boolean"))
    if lazy:
        holds = F.coalesce(flag.scalar(), F.lit(False))
        return source.where(holds), source.where(~holds)
    holds = bool(flag.first()[0])
    empty = source.limit(0)
    return (source, empty) if holds else (empty, source)
