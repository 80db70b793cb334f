"""Row and column transforms, single or as an ordered list of rules."""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.columns import (
    column,
    expression,
    free_name,
    name_list,
    require,
    require_batch,
    require_columns,
    require_unique_names,
)
from rowloom.session import materialize

# A CASE chain is evaluated branch by branch and ends up in generated code, so
# larger replacement mappings become a lookup table; both read keys and values
# alike.  Whether that table is broadcast is Spark's choice, by its size.
MAX_CASE_BRANCHES = 64


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns in one projection.

    All names are read before any is written, so ``{"a": "b", "b": "a"}``
    swaps.  An unknown column, or a result with two equal names, is a
    ``ValueError``.
    """
    require(mapping, "rename: needs a non-empty mapping {old: new}")
    require_columns(df, mapping, "rename")
    targets = [mapping.get(name, name) for name in df.columns]
    require_unique_names(targets, "rename")
    return df.select(
        *[column(name).alias(target) for name, target in zip(df.columns, targets)]
    )


def drop_columns(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Drop columns; a column that is not there is a ``ValueError``."""
    names = name_list(columns)
    require(names, "drop_columns: needs at least one column")
    require_columns(df, names, "drop_columns")
    return df.select(*[column(name) for name in df.columns if name not in names])


def add_column(df: DataFrame, name: str, expression_: str | Column) -> DataFrame:
    """Add a column computed from a Spark SQL expression (or replace it)."""
    require(name, "add_column: needs a name")
    if isinstance(expression_, str):
        require(expression_, "add_column: needs an expression")
    return df.withColumn(name, expression(expression_))


def filter_rows(df: DataFrame, condition: str | Column) -> DataFrame:
    """T4: keep rows whose condition is true; a NULL condition drops the row."""
    if isinstance(condition, str):
        require(condition.strip(), "filter_rows: needs a condition")
    return df.filter(expression(condition))


def replace_values(df: DataFrame, column_name: str, mapping: Mapping) -> DataFrame:
    """T5: replace exact values of one column, leave all others.

    One pass, so ``{"a": "b", "b": "c"}`` turns ``a`` into ``b`` and does not
    chain.  Keys are cast to the column's type as SQL literals are; of keys
    that become equal the first counts, and a ``None`` key matches NULL.  The
    column keeps its type unless a replacement is text and the column is not:
    then the result is a string column.  Up to ``MAX_CASE_BRANCHES`` entries
    become one CASE expression, a longer mapping a lookup table with one row
    per key, whose size Spark knows when it picks the join; the result is the same.
    """
    require_columns(df, [column_name], "replace_values")
    require(mapping, "replace_values: needs a non-empty mapping {old: new}")
    source_type = df.schema[column_name].dataType
    text_result = any(isinstance(value, str) for value in mapping.values())
    result_type = (
        T.StringType()
        if text_result and not _takes_text(source_type)
        else source_type
    )
    current = column(column_name)
    if len(mapping) <= MAX_CASE_BRANCHES:
        replaced = None
        for old, new in mapping.items():
            matches = current.isNull() if old is None else current == F.lit(old).cast(source_type)
            value = F.lit(new).cast(result_type)
            replaced = F.when(matches, value) if replaced is None else replaced.when(matches, value)
        return df.withColumn(column_name, replaced.otherwise(current.cast(result_type)))

    old_name, new_name = free_name("old", df), free_name("new", df)
    lookup = _lookup(df.sparkSession, mapping, source_type, result_type).withColumnsRenamed(
        {"old": old_name, "new": new_name}
    )
    joined = df.join(lookup, current.eqNullSafe(column(old_name)), "left")
    hit = column(new_name)
    value = F.when(hit.isNotNull(), hit["value"]).otherwise(current.cast(result_type))
    return joined.select(
        *[value.alias(name) if name == column_name else column(name) for name in df.columns]
    )


def _lookup(spark, mapping: Mapping, source_type: T.DataType, result_type: T.DataType) -> DataFrame:
    """The mapping as rows (old, new struct), one per key after the cast, the first one given.

    Entries of the same Python types become one table with the types that
    ``lit`` gives them, so the casts are those of the CASE expression.
    """
    by_type: dict[tuple, list[tuple]] = {}
    for place, (old, new) in enumerate(mapping.items()):
        by_type.setdefault((_literal_type(old), _literal_type(new)), []).append((place, old, new))
    tables = []
    for (old_type, new_type), entries in by_type.items():
        schema = T.StructType().add("place", "long").add("old", old_type).add("new", new_type)
        table = spark.createDataFrame(entries, schema)
        tables.append(
            table.select("place", F.col("old").cast(source_type), F.col("new").cast(result_type))
        )
    # The mapping came from the driver, so it fits there after the cast as well.
    cast = reduce(DataFrame.unionAll, tables).toArrow().sort_by("place")
    first: dict = {}
    for place, old in enumerate(cast.column("old").to_pylist()):
        first.setdefault("NaN" if old != old else (type(old), old), place)
    kept = cast.take(pa.array(first.values()))
    schema = T.StructType().add("old", source_type).add("new", result_type)
    table = spark.createDataFrame(kept.select(["old", "new"]), schema)
    return table.select("old", F.struct(F.col("new").alias("value")).alias("new"))


def _literal_type(value) -> T.DataType:
    if value is None:
        return T.NullType()
    if isinstance(value, Decimal):
        sign, digits, exponent = value.as_tuple()
        scale = max(0, -exponent)
        return T.DecimalType(min(38, max(len(digits) + max(0, exponent), scale)), min(38, scale))
    if isinstance(value, int) and not isinstance(value, bool):
        return T.IntegerType() if -(2**31) <= value < 2**31 else T.LongType()
    kinds = {
        bool: T.BooleanType(),
        float: T.DoubleType(),
        str: T.StringType(),
        bytes: T.BinaryType(),
        datetime: T.TimestampType(),
        date: T.DateType(),
    }
    for kind, data_type in kinds.items():
        if isinstance(value, kind):
            return data_type
    raise ValueError(f"replace_values: {value!r} is no plain value")


def _takes_text(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))


def sort(
    df: DataFrame,
    columns: str | Sequence[str],
    ascending: bool | Sequence[bool] = True,
) -> DataFrame:
    """Globally sort by one or several columns.

    Ascending by default; nulls come last in both directions.  Spark cuts the
    key space into ranges from a sample, one range per task.  Equal keys would
    all fall into one range, so the input partition breaks ties: a value that
    fills a large share of the table is then spread over many tasks.
    """
    require_batch(df, "sort", "sort inside foreachBatch")
    names = name_list(columns)
    require(names, "sort: needs at least one column")
    require_columns(df, names, "sort")
    directions = [ascending] * len(names) if isinstance(ascending, bool) else list(ascending)
    if len(directions) != len(names):
        raise ValueError("sort: give one direction, or one per column")
    order = [_nulls_last(name, up) for name, up in zip(names, directions)]
    tie = free_name("tie", df)
    return df.withColumn(tie, F.spark_partition_id()).orderBy(*order, tie).drop(tie)


def _nulls_last(name: str, up: bool = True) -> Column:
    return column(name).asc_nulls_last() if up else column(name).desc_nulls_last()


def deduplicate(
    df: DataFrame,
    columns: str | Sequence[str] | None = None,
    order_by: str | Column | Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep one row per key, or one of each distinct row without keys.

    With ``order_by`` the first row of a key in that order survives (names sort
    ascending, nulls last; pass a ``Column`` such as ``col.desc()`` for other
    orders).  Ties, and keys without an order, go to the row whose remaining
    columns are smallest, so the choice is repeatable; only orders given as
    ``Column`` and rows holding maps leave ties open.

    The row is found by an aggregate (the minimum of a struct) or a ranking
    window.  Both cut a key down to one row inside each input partition before
    the shuffle, so a key that holds a large share of the table does not end
    up in one task.  The aggregate sorts by the key only, which makes it the
    faster of the two.

    A stream needs a watermark: duplicates are then dropped within it.
    """
    names = name_list(columns)
    require_columns(df, names, "deduplicate")
    if df.isStreaming:
        if order_by is not None:
            require_batch(df, "deduplicate with order_by", "use foreachBatch")
        return df.dropDuplicatesWithinWatermark(names or df.columns)
    wanted = [order_by] if isinstance(order_by, (str, Column)) else list(order_by or [])
    if wanted and not names:
        raise ValueError("deduplicate: order_by needs key columns")
    if not names or set(names) == set(df.columns):
        return df.distinct()
    by_name = all(isinstance(item, str) for item in wanted)
    if by_name and all(_orderable(field.dataType) for field in df.schema):
        return _smallest_row(df, names, wanted)
    if not wanted:
        return df.dropDuplicates(names)
    order = [_nulls_last(item) if isinstance(item, str) else item for item in wanted]
    window = Window.partitionBy(*[column(name) for name in names]).orderBy(*order)
    rank = free_name("rank", df)
    ranked = df.withColumn(rank, F.row_number().over(window))
    return ranked.filter(F.col(rank) == 1).drop(rank)


def _smallest_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    require_columns(df, order, "deduplicate (order_by)")
    others = [name for name in df.columns if name not in keys]
    ranks = [
        part.alias(f"r{index}_{place}")
        for index, name in enumerate(order)
        for place, part in enumerate((column(name).isNull(), column(name)))
    ]
    row = F.struct(*[column(name) for name in others]).alias("row")
    best_name = free_name("best", df)
    best = df.groupBy(*[column(name) for name in keys]).agg(
        F.min(F.struct(*ranks, row)).alias(best_name)
    )
    return best.select(
        *[
            column(name) if name in keys else F.col(best_name)["row"][name].alias(name)
            for name in df.columns
        ]
    )


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_orderable(field.dataType) for field in data_type)
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    return isinstance(data_type, T.AtomicType) and not isinstance(data_type, T.VariantType)


_AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "avg": F.avg,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "count_distinct": F.count_distinct,
}


def aggregate(
    df: DataFrame,
    group_by: str | Sequence[str] | None,
    agg_fields: Sequence[Mapping[str, str]],
) -> DataFrame:
    """Grouped aggregation.

    ``agg_fields`` is a list of ``{"column", "function"}`` with an optional
    ``alias``; functions are sum, avg (mean), min, max, count and
    count_distinct.  The default output name is ``<column>_<function>``, and
    ``count`` for ``{"column": "*", "function": "count"}``.  An empty
    ``group_by`` gives one global row.
    """
    require_batch(df, "aggregate", "aggregate inside foreachBatch")
    keys = name_list(group_by)
    require_columns(df, keys, "aggregate")
    require(agg_fields, "aggregate: needs at least one agg field")
    outputs = []
    names = list(keys)
    for field in agg_fields:
        source, function = field.get("column", ""), field.get("function", "")
        if function not in _AGGREGATES:
            raise ValueError(f"aggregate: unknown function {function!r}; use {list(_AGGREGATES)}")
        if source == "*":
            if function != "count":
                raise ValueError("aggregate: only count takes '*'")
            value, default = F.count(F.lit(1)), "count"
        else:
            require_columns(df, [source], "aggregate")
            value, default = _AGGREGATES[function](column(source)), f"{source}_{function}"
        name = field.get("alias") or default
        names.append(name)
        outputs.append(value.alias(name))
    require_unique_names(names, "aggregate")
    return df.groupBy(*[column(key) for key in keys]).agg(*outputs)


def aggregate_sets(
    df: DataFrame,
    sets: Sequence[Sequence[str]],
    agg_fields: Sequence[Mapping[str, str]],
) -> DataFrame:
    """``aggregate`` for several groupings at once, coarser ones from the finest.

    ``sets`` lists the columns of each grouping; ``()`` is the global row.  The
    result holds all of these columns, NULL where a row's grouping lacks one,
    ``grouping_id`` as SQL counts it (a bit for each column that is lacking, the
    first column highest), and the fields of ``aggregate``.

    The input is read once, grouped by all columns (and by those that
    ``count_distinct`` counts), and this finest level is written to the shared
    folder.  Every grouping adds up its rows: sums of sums, least of least,
    averages from sums and counts.  No row of the input is multiplied.
    """
    require_batch(df, "aggregate_sets", "aggregate inside foreachBatch")
    require(sets, "aggregate_sets: needs at least one grouping")
    wanted = [tuple(name_list(names)) for names in sets]
    if len({frozenset(names) for names in wanted}) < len(wanted):
        raise ValueError("aggregate_sets: a grouping is given twice")
    keys = list(dict.fromkeys(name for names in wanted for name in names))
    # Checks the fields, and knows the types that the results have.
    plain = aggregate(df, keys, agg_fields)
    kinds = {field.name: field.dataType for field in plain.schema.fields[len(keys) :]}
    require_unique_names([*keys, "grouping_id", *kinds], "aggregate_sets")

    parts, finals, extra = [], [], {}
    for number, (field, name) in enumerate(zip(agg_fields, kinds, strict=True)):
        source, function = field["column"], field["function"]
        value = F.lit(1) if source == "*" else column(source)
        part = f"part_{number}"
        if function == "count_distinct":
            counted = extra.setdefault(source, f"value_{len(extra)}")
            final = F.count_distinct(F.col(counted))
        elif function in ("avg", "mean"):
            whole = value if isinstance(kinds[name], T.DecimalType) else value.cast("double")
            parts += [F.sum(whole).alias(part), F.count(value).alias(f"{part}_n")]
            final = F.try_divide(F.sum(part), F.sum(f"{part}_n"))
        elif function == "count":
            parts.append(F.count(value).alias(part))
            final = F.coalesce(F.sum(part), F.lit(0))
        else:
            parts.append(_AGGREGATES[function](value).alias(part))
            final = _AGGREGATES[function](F.col(part))
        finals.append(final.cast(kinds[name]).alias(name))
    named = {key: f"key_{place}" for place, key in enumerate(keys)}
    finest_keys = [*(column(key).alias(new) for key, new in named.items()), *(column(c).alias(new) for c, new in extra.items())]
    finest = materialize(df.groupBy(*finest_keys).agg(*(parts or [F.count(F.lit(1)).alias("rows")])), "finest-level")
    levels = []
    for names in wanted:
        lacking = sum(1 << (len(keys) - 1 - place) for place, key in enumerate(keys) if key not in names)
        level = finest.groupBy(*[F.col(named[key]) for key in keys if key in names]).agg(*finals)
        shown = [(F.col(named[key]) if key in names else F.lit(None).cast(df.schema[key].dataType)).alias(key) for key in keys]
        levels.append(level.select(*shown, F.lit(lacking).cast("long").alias("grouping_id"), *[column(name) for name in kinds]))
    return reduce(DataFrame.unionAll, levels)


def drop_null(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Drop rows that hold NULL (or NaN) in any of the given columns."""
    names = name_list(columns)
    require(names, "drop_null: needs a column")
    require_columns(df, names, "drop_null")
    return df.dropna(subset=names)


# --- ordered rule lists -----------------------------------------------------

_CALL = re.compile(r"(drop_null|deduplicate)\s*\((.*)\)", re.DOTALL)
_FILTER = re.compile(r"filter\s+(.+)", re.DOTALL | re.IGNORECASE)


def parse_rule(rule: str | Mapping, position: int = 1) -> dict:
    """Bring one transform rule into its full dict form.

    ``{"type": "rename", "from": a, "to": b}`` becomes a one-entry mapping.
    Half of the pair, the pair beside a mapping, or an empty mapping is a
    ``ValueError``.  Text rules are ``drop_null(c)``, ``deduplicate(c)`` and
    ``FILTER <condition>``; other text is a ``ValueError``.  Anything that is
    neither text nor a dict is a ``TypeError`` naming its 1-based position.
    """
    where = f"transform rule #{position}"
    if isinstance(rule, str):
        return _parse_text_rule(rule.strip(), where)
    if not isinstance(rule, Mapping):
        raise TypeError(f"{where} must be text or a dict, not {type(rule).__name__}")
    spec = dict(rule)
    if spec.get("type") in ("rename", "rename_columns"):
        short = [key for key in ("from", "to") if key in spec]
        if short and ("mapping" in spec or len(short) == 1):
            raise ValueError(f"{where} (rename): give both 'from' and 'to', or only 'mapping'")
        if short:
            spec["mapping"] = {spec.pop("from"): spec.pop("to")}
        if not isinstance(spec.get("mapping"), Mapping) or not spec["mapping"]:
            raise ValueError(f"{where} (rename): 'mapping' must be a non-empty dict")
    if spec.get("type") not in _RULES:
        raise ValueError(f"{where}: unknown type {spec.get('type')!r}; use {list(_RULES)}")
    return spec


def _parse_text_rule(text: str, where: str) -> dict:
    call = _CALL.fullmatch(text)
    if call:
        names = [name.strip() for name in call.group(2).split(",") if name.strip()]
        if call.group(1) == "drop_null" and not names:
            raise ValueError(f"{where}: drop_null needs a column")
        return {"type": call.group(1), "columns": names}
    condition = _FILTER.fullmatch(text)
    if condition:
        return {"type": "filter_rows", "condition": condition.group(1)}
    raise ValueError(
        f"{where}: cannot read {text!r}; use drop_null(c), deduplicate(c) or FILTER <condition>"
    )


_RULES: dict[str, Callable[[DataFrame, dict], DataFrame]] = {
    "rename": lambda df, r: rename(df, r["mapping"]),
    "rename_columns": lambda df, r: rename(df, r["mapping"]),
    "drop_columns": lambda df, r: drop_columns(df, r.get("columns")),
    "add_column": lambda df, r: add_column(df, r.get("name"), r.get("expression", "")),
    "filter_rows": lambda df, r: filter_rows(df, r.get("condition", "")),
    "replace_values": lambda df, r: replace_values(df, r.get("column"), r.get("mapping")),
    "sort": lambda df, r: sort(df, r.get("column"), r.get("ascending", True)),
    "deduplicate": lambda df, r: deduplicate(df, r.get("columns"), r.get("order_by")),
    "aggregate": lambda df, r: aggregate(df, r.get("group_by"), r.get("agg_fields")),
    "drop_null": lambda df, r: drop_null(df, r.get("columns") or r.get("column")),
}


def transform(df: DataFrame, rules: Sequence[str | Mapping] | None = None) -> DataFrame:
    """Apply transform rules in order.

    Every rule is checked before the first is applied.  No rules pass the
    input through with a warning.
    """
    if not rules:
        warnings.warn("transform without rules passes its input through", stacklevel=2)
        return df
    specs = [parse_rule(rule, position) for position, rule in enumerate(rules, start=1)]
    for spec in specs:
        df = _RULES[spec["type"]](df, spec)
    return df
