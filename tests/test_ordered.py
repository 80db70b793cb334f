"""As-of joins, interval joins and running totals against plain loops, and with a hot key."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rowloom import join_asof, join_interval, running_total
from rowloom.operators.ordered import STEP, level_of


def sides(seed, count=120):
    draw = random.Random(seed)
    key = lambda: draw.choice([1, 1, 1, 2, 3, None])
    place = lambda: draw.choice([None, *range(40)])
    left = [(i, key(), place(), "L") for i in range(count)]
    right = [(key(), place(), draw.choice([None, "x", "y", "z"])) for i in range(count)]
    return left, right


def asof_by_hand(left, right, how, back, tolerance, exact):
    result = []
    for row in left:
        _, k, t, _ = row
        best = None
        for other in right:
            rk, rt, _ = other
            if None in (k, t, rk, rt) or rk != k:
                continue
            gap = t - rt if back else rt - t
            if gap < 0 or (gap == 0 and not exact):
                continue
            rank = tuple((v is not None, v or "") for v in other)
            # Nearest first; the greatest row (forward: the smallest) of one place.
            if best is None or gap < best[0] or (gap == best[0] and (rank > best[1]) == back and rank != best[1]):
                best = (gap, rank, other)
        if best and tolerance is not None and best[0] > tolerance:
            best = None
        if best or how == "left":
            result.append((*row, *(best[2][1:] if best else (None, None))))
    return sorted(result, key=repr)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize(("tolerance", "exact", "pieces"), [(None, True, 1), (3, True, 5), (None, False, 64), (0, True, 7)])
def test_asof_by_hand(spark, rows, how, direction, tolerance, exact, pieces):
    left, right = sides(len(how) + pieces)
    a = spark.createDataFrame(left, "id int, k int, t int, side string")
    b = spark.createDataFrame(right, "k int, t int, v string")
    limit = None if tolerance is None else str(tolerance)
    got = join_asof(a, b, "k", "t", how=how, direction=direction, tolerance=limit, exact=exact, pieces=pieces)
    assert got.columns == ["id", "k", "t", "side", "t_right", "v"]
    assert rows(got) == asof_by_hand(left, right, how, direction == "backward", tolerance, exact)


def test_asof_with_times_maps_and_other_key_names(spark, rows):
    start = datetime(2024, 3, 31, 1)
    a = spark.createDataFrame([(1, start + timedelta(hours=2))], "k long, at timestamp_ntz")
    b = spark.createDataFrame([(1, start + timedelta(hours=h), {"h": h}) for h in range(4)], "j int, AT timestamp_ntz, m map<string,int>")
    got = join_asof(a, b, "k=j", "at", "AT", tolerance="INTERVAL 1 HOUR", exact=False)
    assert got.columns == ["k", "at", "j", "AT_right", "m"]
    assert rows(got) == [(1, start + timedelta(hours=2), 1, start + timedelta(hours=1), {"h": 1})]
    assert join_asof(a.limit(0), b, "k=j", "at", "AT").count() == 0
    assert join_asof(a, b.limit(0), "k=j", "at", "AT").first().j is None


def test_asof_cuts_a_hot_key(spark):
    """Two thirds of the rows have one key; no window partition holds more than a few ranges of it."""
    rows = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 > 0, 7, id) AS k", "id AS t")
    got = join_asof(rows, rows.selectExpr("k", "t", "t AS v"), "k", "t", exact=False)
    checked = got.agg(F.count("*"), F.count("v"), F.expr("count_if(k = 7 AND v NOT IN (t - 1, t - 2))"), F.expr("count_if(k <> 7 AND v IS NOT NULL)"))
    assert tuple(checked.first()) == (60_000, 39_999, 0, 0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "piece" in plan.split("Window")[1] and "NestedLoop" not in plan and "Cartesian" not in plan
    from rowloom.operators.ordered import cut_points, range_number

    sizes = rows.groupBy("k", range_number(F.col("t"), cut_points(rows, "t", 64)).alias("piece")).count()
    assert sizes.agg(F.max("count")).first()[0] < 2 * 40_000 / 64


@pytest.mark.parametrize(("options", "said"), [({"how": "full"}, "how"), ({"direction": "up"}, "direction")])
def test_asof_rejects(spark, options, said):
    df = spark.createDataFrame([(1, 1, "a")], "k int, t int, s string")
    with pytest.raises(ValueError, match=said):
        join_asof(df, df, "k", "t", **options)
    with pytest.raises(ValueError, match="timestamp"):
        join_asof(df, df, "k", "s")


def spans(seed, count, kind=int):
    draw = random.Random(seed)
    made = []
    for i in range(count):
        low = draw.choice([None, *range(-60, 60)]) if i % 9 == 0 else draw.randrange(-60, 60)
        size = draw.choice([0, 1, 2, 3, 8, 9, 30, 200, -2])
        high = None if low is None or i % 11 == 0 else low + size
        made.append((i % 4 or None, None if low is None else kind(low), None if high is None else kind(high), i))
    return made


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("overlap", [True, False])
@pytest.mark.parametrize("kind", ["int", "double"])
def test_intervals_by_hand(spark, rows, how, keyed, overlap, kind):
    as_kind = int if kind == "int" else lambda v: v / 7
    left, right = spans(1, 60, as_kind), spans(2, 60, as_kind)
    a = spark.createDataFrame(left, f"k int, low {kind}, high {kind}, a int")
    b = spark.createDataFrame(right, f"k int, low {kind}, high {kind}, b int")
    got = join_interval(a, b, ("low", "high") if overlap else "low", ("low", "high"), "k" if keyed else None, how=how)

    def touch(x, y):
        if None in (x[1], y[1], y[2]) or (keyed and (x[0] is None or x[0] != y[0])) or y[1] >= y[2]:
            return False
        if not overlap:
            return y[1] <= x[1] < y[2]
        return x[2] is not None and x[1] < x[2] and x[1] < y[2] and y[1] < x[2]

    cut = 1 if keyed else 0
    wanted = [(*x, *y[cut:]) for x in left for y in right if touch(x, y)]
    if how == "left":
        wanted += [(*x, *[None] * (4 - cut)) for x in left if not any(touch(x, y) for y in right)]
    assert rows(got) == sorted(wanted, key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_long_intervals_stay_few_rows(spark):
    """Lengths from a second to a century: an interval has three bins at most."""
    lengths = spark.range(1, 60).selectExpr("shiftleft(1L, cast(id AS int)) - 1 AS n")
    level = level_of(F.col("n"))
    least = lengths.select(F.min((F.lit(2.0) ** (level * STEP)) / F.col("n")), F.max((F.lit(2.0) ** (level * STEP)) / F.col("n"))).first()
    assert least[0] >= 0.999999 and least[1] <= 8.000001
    points = spark.range(0, 20_000, 1, 4).selectExpr("id * 1000 AS p")
    windows = spark.createDataFrame([(0, 1 << 50), (5000, 6000), (5000, 5001)], "s long, e long")
    assert join_interval(points, windows, "p", ("s", "e")).count() == 20_000 + 1 + 1


def test_interval_times_and_names(spark, rows):
    start = datetime(2024, 3, 31, 1, 30, 0, 250)
    a = spark.createDataFrame([(1, start)], "k int, at timestamp_ntz")
    b = spark.createDataFrame([(start, start + timedelta(microseconds=1), 9), (start + timedelta(microseconds=1), start + timedelta(days=1), 8)], "at timestamp_ntz, end timestamp_ntz, k int")
    got = join_interval(a, b, "at", ("at", "end"))
    assert got.columns == ["k", "at", "at_right", "end", "k_right"]
    assert rows(got) == [(1, start, start, start + timedelta(microseconds=1), 9)]


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("pieces", [1, 6])
def test_running_total_by_hand(spark, rows, keys, pieces):
    draw = random.Random(8)
    data = [(draw.choice([1, 1, 2, None]), draw.choice([None, *range(12)]), draw.randrange(3), draw.choice([None, 1, 5, -2])) for _ in range(150)]
    df = spark.createDataFrame(data, "k int, t int, u int, v int")
    got = running_total(df, "v", ["t", "u"], keys, name="sum", pieces=pieces)
    place = lambda r: (r[1] is not None, r[1] or 0, r[2])
    wanted = []
    for row in data:
        group = [r[3] for r in data if (not keys or r[0] == row[0]) and place(r) <= place(row) and r[3] is not None]
        wanted.append((*row, sum(group) if group else None))
    assert rows(got) == sorted(wanted, key=repr)


def test_running_total_of_one_key(spark):
    df = spark.range(0, 50_000, 1, 8).selectExpr("id", "1 AS one")
    got = running_total(df, "one", "id")
    assert got.where("running_total <> id + 1").count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1  # of one row for each range
    with pytest.raises(ValueError, match="exists"):
        running_total(df, "one", "id", name="ONE")
