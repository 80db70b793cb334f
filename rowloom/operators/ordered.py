"""Joins and totals along an order: as-of join, interval join, running totals.

A key may hold any share of the rows: its rows are cut into ranges of the order
column, and what one range needs of the ones before it is carried over from one
small row per key and range.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.columns import any_null, column, free_name, name_list, require, require_columns, require_unique_names
from rowloom.operators.combine import parse_join_keys
from rowloom.session import materialize

#: Ranges of the order column, all keys together.
PIECES = 64


def cut_points(values: DataFrame, name: str, pieces: int) -> list[Column]:
    """At most ``pieces`` - 1 ascending values that cut a column into ranges of about equal size.

    Measured over all rows, whatever their key, by one aggregate of bounded size.
    """
    if pieces < 2:
        return []
    shares = [step / pieces for step in range(1, pieces)]
    kind = values.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        # As microseconds, since the text of an hour that a clock repeats would be ambiguous.
        found = cut_points(values.select(F.unix_micros(name).alias(name)), name, pieces)
        return [F.timestamp_micros(micros) for micros in found]
    found = values.agg(F.percentile_approx(name, shares, 1000).cast("array<string>").alias("cuts")).first().cuts
    return [F.lit(text).cast(kind) for text in dict.fromkeys(found or [])]


def range_number(value: Column, cuts: Sequence[Column], first: int = 0) -> Column:
    """How many cuts a value has reached, by bisection in the expression itself."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    below = range_number(value, cuts[:middle], first)
    return F.when(value < cuts[middle], below).otherwise(range_number(value, cuts[middle + 1 :], first + middle + 1))


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_sortable(field.dataType) for field in kind)
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _order_column(df: DataFrame, name: str, operator: str) -> None:
    kind = df.schema[name].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{operator}: {name!r} must be a number, a date or a timestamp, not {kind.simpleString()}")


def join_asof(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    left_order: str,
    right_order: str | None = None,
    *,
    how: str = "left",
    direction: str = "backward",
    tolerance: str | Column | None = None,
    exact: bool = True,
    pieces: int = PIECES,
) -> DataFrame:
    """Give each left row the nearest right row of its key before it.

    ``direction="backward"`` takes the last right row whose order value is not
    above the left one's, ``"forward"`` the first that is not below;
    ``exact=False`` leaves equal values out.  A match further away than
    ``tolerance`` (SQL text or a Column, such as ``"INTERVAL 2 HOURS"``) is
    none.  ``how="left"`` keeps left rows without a match, ``"inner"`` drops
    them.  Keys are named as in ``join``; a NULL key or order value never
    matches.  Of several right rows at one place the greatest counts, comparing
    its columns in their order (forward: the smallest).

    Both sides are put under each other and shuffled once by key and range of
    the order column, so a hot key is spread over ``pieces`` tasks; the last
    right row of each key and range is carried into the later ranges.  Rows of
    one key at one order value stay together.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"join_asof: how must be left or inner, not {how!r}")
    if direction not in ("backward", "forward"):
        raise ValueError(f"join_asof: direction must be backward or forward, not {direction!r}")
    right_order = right_order or left_order
    keys = parse_join_keys(on)
    require_columns(left, [*(a for a, _ in keys), left_order], "join_asof (left)")
    require_columns(right, [*(b for _, b in keys), right_order], "join_asof (right)")
    _order_column(left, left_order, "join_asof (left)")
    _order_column(right, right_order, "join_asof (right)")
    shared = {a for a, b in keys if a == b}
    kept = [field for field in right.schema if field.name not in shared]
    taken = {name.lower() for name in left.columns}
    outputs = {f.name: f.name + "_right" if f.name.lower() in taken else f.name for f in kept}
    require_unique_names([*left.columns, *outputs.values()], "join_asof")

    back = direction == "backward"
    ours = F.struct(*[column(name) for name in left.columns]).alias("ours")
    theirs = F.struct(*[column(f.name).alias(f"c{i}") for i, f in enumerate(kept)], F.lit(1).alias("there")).alias("theirs")
    rank = [column(f.name).alias(f"c{i}") for i, f in enumerate(kept) if _sortable(f.dataType)]
    ties = F.struct(*rank, F.lit(1).alias("there")).alias("ties")
    right_first = 0 if exact else 2
    left_keys = [column(a).alias(f"k{i}") for i, (a, _) in enumerate(keys)]
    right_keys = [column(b).alias(f"k{i}") for i, (_, b) in enumerate(keys)]
    missing_left = any_null([*(a for a, _ in keys), left_order])
    missing_right = any_null([*(b for _, b in keys), right_order])
    rows_left = left.where(~missing_left).select(*left_keys, column(left_order).alias("at"), F.lit(1).alias("side"), ours)
    rows_right = right.where(~missing_right).select(
        *right_keys, column(right_order).alias("at"), F.lit(right_first).alias("side"), theirs, ties
    )
    rows = rows_left.unionByName(rows_right, allowMissingColumns=True)
    by = [f"k{i}" for i in range(len(keys))]

    places = left.select(column(left_order).alias("at")).unionByName(right.select(column(right_order).alias("at")))
    rows = rows.withColumn("piece", range_number(F.col("at"), cut_points(places, "at", pieces)))
    if pieces > 1:
        near = F.max_by if back else F.min_by
        place = F.when(F.col("theirs").isNotNull(), F.struct("at", "ties"))
        ends = rows.groupBy(*by, "piece").agg(near(F.struct("at", "theirs", "ties"), place).alias("end"))
        towards = F.col("piece") if back else F.col("piece").desc()
        before = Window.partitionBy(*by).orderBy(towards).rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.select(*by, "piece", F.last("end", ignorenulls=True).over(before).alias("end")).where("end IS NOT NULL")
        entering = carried.select(*by, "piece", "end.at", F.lit(0).alias("side"), "end.theirs", "end.ties")
        rows = rows.unionByName(entering, allowMissingColumns=True)
    order = [F.col("at"), F.col("side"), F.col("ties")] if back else [F.col("at").desc(), F.col("side"), F.col("ties").desc()]
    so_far = Window.partitionBy(*by, "piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = F.last(F.when(F.col("theirs").isNotNull(), F.struct("at", "theirs")), ignorenulls=True).over(so_far)
    matched = rows.select("ours", "at", "side", found.alias("found")).where("side = 1")
    match = F.col("found")
    if tolerance is not None:
        width = F.expr(tolerance) if isinstance(tolerance, str) else tolerance
        close = F.col("found.at") >= F.col("at") - width if back else F.col("found.at") <= F.col("at") + width
        match = F.when(close, match)
    matched = matched.select("ours", match.alias("found"))
    if how == "inner":
        matched = matched.where("found IS NOT NULL")
    names = [F.col("ours").getField(name).alias(name) for name in left.columns]
    values = [F.col("found.theirs").getField(f"c{i}").alias(outputs[f.name]) for i, f in enumerate(kept)]
    result = matched.select(*names, *values)
    if how == "inner":
        return result
    empty = [F.lit(None).cast(f.dataType).alias(outputs[f.name]) for f in kept]
    return result.unionAll(left.where(missing_left).select(*[column(name) for name in left.columns], *empty))


#: Widths of the bins of an interval join are powers of two to this power.
STEP = 3
DAY = 86_400_000_000


def ticks(value: Column, kind: T.DataType) -> Column:
    """An order value as a number: integers, days, microseconds or doubles."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        # By its parts, since its distance from 1970 must not pass through a time zone.
        clock = (F.hour(value) * 60 + F.minute(value)).cast("long") * 60_000_000
        seconds = (F.date_part(F.lit("SECONDS"), value) * 1_000_000).cast("long")
        return F.unix_date(value.cast("date")).cast("long") * DAY + clock + seconds
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    return value.cast("long") if isinstance(kind, T.IntegralType) else value.cast("double")


def bin_of(value: Column, level: Column) -> Column:
    """The bin of a number among those of width 2 ** (STEP * level)."""
    whole = F.lit(2.0) ** (F.lit(float(STEP)) * level)
    return F.floor(value.cast("double") / whole)


def level_of(length: Column) -> Column:
    """The first level whose bins are at least as wide as ``length``."""
    return F.ceil(F.log2(length.cast("double")) / STEP).cast("int")


def join_interval(
    left: DataFrame,
    right: DataFrame,
    left_place: str | tuple[str, str],
    right_range: tuple[str, str],
    on: str | Sequence[str] | None = None,
    *,
    how: str = "inner",
) -> DataFrame:
    """Join left places with the right intervals that they touch.

    ``right_range`` names the columns of start and end; an interval holds its
    start and not its end.  ``left_place`` is a column, whose value must lie in
    the interval, or two, an interval that must overlap it.  ``on`` adds equal
    keys as in ``join``.  NULLs never match, and neither do intervals that end
    where they start or before.  Right columns whose name is taken get the
    suffix ``_right``.  ``how="left"`` keeps left rows without a match; the
    left side is then written to the shared folder, since it is read twice.

    Intervals are dealt into bins of the width that suits their own length, so
    each has two of a level (three at most by rounding); places look into the
    levels that occur, of which there are few, as widths grow by eight.  Pairs
    meet by an equi-join on key, level and bin, which Spark may split where it
    is skewed; an overlap counts in the first bin that both have.  There is
    never a nested loop.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join_interval: how must be inner or left, not {how!r}")
    ends = name_list(left_place) if isinstance(left_place, str) else list(left_place)
    if len(ends) not in (1, 2) or len(right_range) != 2:
        raise ValueError("join_interval: give one or two left columns and two right ones")
    keys = parse_join_keys(on) if on else []
    require_columns(left, [*(a for a, _ in keys), *ends], "join_interval (left)")
    require_columns(right, [*(b for _, b in keys), *right_range], "join_interval (right)")
    for df, names, side in ((left, ends, "left"), (right, right_range, "right")):
        for name in names:
            _order_column(df, name, f"join_interval ({side})")
    shared = {a for a, b in keys if a == b}
    kept = [name for name in right.columns if name not in shared]
    taken = {name.lower() for name in left.columns}
    outputs = {name: name + "_right" if name.lower() in taken else name for name in kept}
    require_unique_names([*left.columns, *outputs.values()], "join_interval")

    if how == "left":
        number = free_name("row_number", left, right)
        left = materialize(left.withColumn(number, F.monotonically_increasing_id()), "left")

    def dealt(df: DataFrame, names: Sequence[str], pairs: list[Column], payload: str) -> DataFrame:
        low, high = (ticks(column(n), df.schema[n].dataType) for n in (names[0], names[-1]))
        whole = df.where(~any_null(names)).select(
            *pairs, low.alias("low"), high.alias("high"), F.struct(*[column(n) for n in df.columns]).alias(payload)
        )
        return whole if len(names) == 1 else whole.where("low < high").withColumn("own", level_of(F.col("high") - F.col("low")))

    ours = dealt(left, ends, [column(a).alias(f"k{i}") for i, (a, _) in enumerate(keys)], "ours")
    theirs = dealt(right, list(right_range), [column(b).alias(f"j{i}") for i, (_, b) in enumerate(keys)], "theirs")
    levels = sorted(row.own for row in theirs.select("own").distinct().collect())
    if len(ends) == 2:
        more = {row.own for row in ours.select("own").distinct().collect()}
        levels = sorted({*levels, *more})
    every = F.array(*[F.lit(level) for level in levels]) if levels else F.array().cast("array<int>")

    def binned(df: DataFrame, level: Column) -> DataFrame:
        """One row for each bin that the row touches on each of the levels."""
        listed = df.withColumn("level", F.explode(level))
        first, last = bin_of(F.col("low"), F.col("level")), bin_of(F.col("high"), F.col("level"))
        return listed.withColumn("first", first).withColumn("bin", F.explode(F.sequence(F.col("first"), last)))

    # A pair meets on the level of the longer interval.
    coarser = F.filter(every, lambda level: level >= F.col("own"))
    ours = binned(ours, every if len(ends) == 1 else coarser)
    theirs = binned(theirs, F.array("own") if len(ends) == 1 else coarser)
    a, b = ours.alias("a"), theirs.alias("b")
    same = [F.col("a.level") == F.col("b.level"), F.col("a.bin") == F.col("b.bin")]
    same += [F.col(f"a.k{i}") == F.col(f"b.j{i}") for i in range(len(keys))]
    if len(ends) == 1:
        touch = (F.col("b.low") <= F.col("a.low")) & (F.col("a.low") < F.col("b.high"))
    else:
        touch = (F.col("b.low") < F.col("a.high")) & (F.col("a.low") < F.col("b.high"))
        touch &= F.col("a.level") == F.greatest("a.own", "b.own")
        touch &= F.col("a.bin") == F.greatest("a.first", "b.first")
    met = a.join(b, reduce(lambda x, y: x & y, same) & touch, "inner")
    values = [F.col("b.theirs").getField(name).alias(outputs[name]) for name in kept]
    result = met.select(*[F.col("a.ours").getField(name).alias(name) for name in left.columns], *values)
    if how == "inner":
        return result
    alone = left.join(result.select(number).distinct(), number, "left_anti")
    empty = [F.lit(None).cast(right.schema[name].dataType).alias(outputs[name]) for name in kept]
    alone = alone.select(*[column(name) for name in left.columns], *empty)
    return result.unionAll(alone).drop(number)


def running_total(
    df: DataFrame,
    value: str,
    order_by: str | Sequence[str],
    partition_by: str | Sequence[str] | None = None,
    *,
    name: str = "running_total",
    pieces: int = PIECES,
) -> DataFrame:
    """Add the sum of ``value`` over the rows of a key up to each row.

    Rows are taken in the order of ``order_by``; rows that agree in all of it
    get the same total, the one after the last of them.  NULL values count as
    nothing, NULLs in the order come first and make a range of their own, and
    a NULL key is a key.

    The first order column is cut into ranges: one small row per key and range
    holds its sum, a window over these gives what lies before a range, and a
    window inside each range the rest.  So neither a hot key nor a single key
    for all rows (no ``partition_by``) lands in one task.
    """
    keys, order = name_list(partition_by), name_list(order_by)
    require(order, "running_total: needs a column to order by")
    require_columns(df, [value, *order, *keys], "running_total")
    _order_column(df, order[0], "running_total")
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"running_total: the column {name!r} exists already")
    piece, before, inside = (free_name(stem, df) for stem in ("piece", "sum_before", "sum_inside"))
    lead = column(order[0])
    number = range_number(lead, cut_points(df.select(lead.alias("at")), "at", pieces))
    rows = df.withColumn(piece, F.when(lead.isNull(), F.lit(-1)).otherwise(number))
    by = [column(key) for key in keys]
    sums = rows.groupBy(*by, column(piece)).agg(F.sum(column(value)).alias(inside))
    earlier = Window.partitionBy(*by).orderBy(column(piece)).rowsBetween(Window.unboundedPreceding, -1)
    started = sums.select(*by, column(piece), F.sum(column(inside)).over(earlier).alias(before))
    renamed = started.select(*[column(key).alias(f"start_{i}") for i, key in enumerate(keys)], column(piece).alias("start_piece"), column(before))
    same = [column(key).eqNullSafe(F.col(f"start_{i}")) for i, key in enumerate(keys)] + [column(piece) == F.col("start_piece")]
    within = Window.partitionBy(*by, column(piece)).orderBy(*[column(c) for c in order]).rangeBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn(inside, F.sum(column(value)).over(within))
    joined = summed.join(renamed, reduce(lambda x, y: x & y, same), "left")
    parts = [column(before), column(inside)]
    total = F.when(parts[0].isNotNull() | parts[1].isNotNull(), reduce(lambda x, y: x + y, [F.coalesce(p, F.lit(0)) for p in parts]))
    return joined.select(*[column(c) for c in df.columns], total.alias(name))
