"""Named SQL models that build on each other."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from rowloom.columns import require
from rowloom.session import materialize
from rowloom.sources.sql import run_query


def sql_models(
    spark: SparkSession,
    models: Mapping[str, str],
    inputs: Mapping[str, DataFrame],
    *,
    select: Iterable[str] | None = None,
    tables: Iterable[str] = (),
    values: Mapping[str, object] | None = None,
) -> dict[str, DataFrame]:
    """Evaluate SELECTs, in the given order, into DataFrames.

    ``{name}`` in a model stands for an input or an earlier model; ``{{ ds }}``
    and other run variables may be used.  Models are lazy and merge into one
    plan per use, except those named in ``tables``: they are written once to
    the shared folder, for models with several dependants.  ``select`` limits
    the result to some models.
    """
    require(models, "sql_models: needs at least one model")
    written = set(tables)
    wanted = list(models) if select is None else list(select)
    unknown = (written | set(wanted)) - set(models)
    if unknown:
        raise ValueError(f"sql_models: no such model {sorted(unknown)}")
    known = dict(inputs)
    for name, query in models.items():
        if name in known:
            raise ValueError(f"sql_models: the name {name!r} is used twice")
        used = {other: frame for other, frame in known.items() if "{" + other + "}" in query}
        result = run_query(spark, query, values, **used)
        known[name] = materialize(result, name) if name in written else result
    return {name: known[name] for name in wanted}
