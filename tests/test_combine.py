import random

import pytest
from pyspark.sql import functions as F

from rowloom import branch, fan_in, fan_out, join, upsert
from rowloom.operators.combine import parse_join_keys


def brute_join(left, right, how):
    """Nested loops over (key, value) rows; gives (left key, value, right key, value)."""
    out, hit_right = [], set()
    for a in left:
        hits = [i for i, b in enumerate(right) if a[0] is not None and a[0] == b[0]]
        out += [(*a, *right[i]) for i in hits]
        hit_right.update(hits)
        if not hits and how in ("left", "full"):
            out.append((*a, None, None))
    if how in ("right", "full"):
        out += [(None, None, *b) for i, b in enumerate(right) if i not in hit_right]
    return sorted(out, key=repr)


class TestKeys:
    def test_forms(self):
        assert parse_join_keys("id") == [("id", "id")]
        assert parse_join_keys(" id = customer_id ") == [("id", "customer_id")]
        assert parse_join_keys("a=b=c") == [("a", "b=c")]
        assert parse_join_keys(["a", "b=c"]) == [("a", "a"), ("b", "c")]

    @pytest.mark.parametrize("on", ["", "=b", "a=", [], ["a", ""]])
    def test_empty(self, on):
        with pytest.raises(ValueError):
            parse_join_keys(on)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, rows, how, seed):
    rng = random.Random(seed)
    keys = [None, 1, 1, 1, 2, 3, 4, 5, 6]
    left = [(rng.choice(keys), i) for i in range(25)]
    right = [(rng.choice([*keys, 7, 8]), i + 100) for i in range(25)]
    a = spark.createDataFrame(left, "k bigint, v int").repartition(3)
    b = spark.createDataFrame(right, "j bigint, w int").repartition(2)
    assert rows(join(a, b, "k=j", how)) == brute_join(left, right, how)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_unique_sides_give_the_same(spark, rows, how):
    left = [(1, 1), (2, 2), (None, 3), (5, 5)]
    right = [(2, 20), (3, 30), (None, 40), (5, 50)]
    a = spark.createDataFrame(left, "k bigint, v int")
    b = spark.createDataFrame(right, "j bigint, w int")
    plain = join(a, b, "k=j", how, left_unique=True, right_unique=True)
    assert rows(plain) == brute_join(left, right, how)
    assert rows(join(a, b, "k=j", how)) == rows(plain)


@pytest.mark.parametrize(
    "how, expected",
    [
        ("inner", [(2, "b", "B")]),
        ("left", [(1, "a", None), (2, "b", "B"), (None, "n", None)]),
        ("right", [(2, "b", "B"), (3, None, "C"), (None, None, "N")]),
        (
            "full",
            [
                (1, "a", None),
                (2, "b", "B"),
                (3, None, "C"),
                (None, "n", None),
                (None, None, "N"),
            ],
        ),
    ],
)
@pytest.mark.parametrize("unique", [True, False])
def test_shared_key_and_collision(spark, rows, how, expected, unique):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k bigint, v string")
    b = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k bigint, v string")
    result = join(a, b, "k", how, left_unique=unique, right_unique=unique)
    assert result.columns == ["k", "v", "v_right"]
    assert rows(result) == sorted(expected, key=repr)


def test_self_join(spark, rows):
    df = spark.createDataFrame([(1, 2), (2, 3)], "id int, parent int")
    result = join(df, df, "parent=id", "full")
    assert result.columns == ["id", "parent", "id_right", "parent_right"]
    assert rows(result) == [(1, 2, 2, 3), (2, 3, None, None), (None, None, 1, 2)]


def test_names_differing_in_case_collide(spark):
    a = spark.createDataFrame([(1, "x")], "k int, Name string")
    b = spark.createDataFrame([(1, "y")], "k int, name string")
    assert join(a, b, "k").columns == ["k", "Name", "name_right"]


def test_nan_keys_match(spark, rows):
    nan = float("nan")
    a = spark.createDataFrame([(nan, 1), (1.0, 2)], "k double, v int")
    b = spark.createDataFrame([(nan, 3)], "k double, w int")
    result = join(a, b, "k", "left").select("v", "w")
    assert rows(result) == [(1, 3), (2, None)]


def test_composite_key(spark, rows):
    a = spark.createDataFrame([(1, 1, "x"), (1, None, "y")], "a int, b int, v string")
    b = spark.createDataFrame([(1, 1, "p"), (1, 2, "q")], "a int, c int, w string")
    assert rows(join(a, b, ["a", "b=c"], "full")) == [
        (1, 1, "x", 1, "p"),
        (1, None, "y", None, None),
        (1, None, None, 2, "q"),
    ]


def test_rejected(spark):
    df = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError, match="how"):
        join(df, df, "k", "cross")
    with pytest.raises(ValueError, match="zzz"):
        join(df, df, "zzz")
    wide = spark.createDataFrame([(1, 2, 3)], "k int, v int, v_right int")
    with pytest.raises(ValueError, match="two columns"):
        join(wide, wide, "k")


class TestFanIn:
    def test_differing_columns(self, spark, rows):
        a = spark.createDataFrame([(1, 2)], "x int, y int")
        b = spark.createDataFrame([(3, 4)], "y int, z int")
        result = fan_in(a, b, a)
        assert result.columns == ["x", "y", "z"]
        assert rows(result) == [(1, 2, None), (1, 2, None), (None, 3, 4)]

    def test_no_input(self):
        with pytest.raises(ValueError):
            fan_in()


class TestFanOut:
    @pytest.mark.parametrize("reuse", ["persist", "table", None])
    def test_every_consumer_sees_all(self, spark, reuse):
        df = spark.range(10)
        results = fan_out(df, [lambda d: d.count(), lambda d: d.agg(F.sum("id")).first()[0]], reuse=reuse)
        assert results == [10, 45]

    def test_released_after_failure(self, spark):
        df = spark.range(3)

        def fail(_):
            raise RuntimeError("no")

        with pytest.raises(RuntimeError):
            fan_out(df, [fail])
        assert not df.is_cached

    def test_unknown_reuse(self, spark):
        with pytest.raises(ValueError):
            fan_out(spark.range(1), [lambda d: None], reuse="magic")


class TestBranch:
    @pytest.fixture
    def data(self, spark):
        return spark.createDataFrame([(1, "ok"), (2, "error")], "id int, status string")

    def test_row_count(self, data):
        yes, no = branch(data, "row_count > 1")
        assert (yes.count(), no.count()) == (2, 0)
        assert yes.schema == no.schema

    def test_false(self, data):
        yes, no = branch(data, "row_count > 2")
        assert (yes.count(), no.count()) == (0, 2)

    def test_function(self, data):
        yes, no = branch(data, lambda df: F.bool_and(df.status != "error"))
        assert (yes.count(), no.count()) == (0, 2)

    def test_null_is_false(self, data):
        yes, no = branch(data.limit(0), lambda df: F.bool_and(df.status != "error"))
        assert (yes.count(), no.count()) == (0, 0)

    def test_predicate_true_on_empty_input(self, data):
        yes, no = branch(data.limit(0), "row_count = 0")
        assert yes.columns == ["id", "status"] and yes.count() == 0

    def test_statistics(self, data):
        yes, _ = branch(data, "highest = 2 and row_count = 2", statistics={"highest": F.max("id")})
        assert yes.count() == 2

    def test_empty_expression(self, data):
        with pytest.raises(ValueError):
            branch(data, " ")


class TestUpsert:
    def test_replace_and_add(self, spark, rows):
        target = spark.createDataFrame([(1, 2), (5, 5)], "id bigint, v bigint")
        source = spark.createDataFrame([(1, 9), (2, 3)], "id bigint, v bigint")
        assert rows(upsert(target, source, "id")) == [(1, 9), (2, 3), (5, 5)]

    def test_repeated_source_keys(self, spark, rows):
        target = spark.createDataFrame([(1, 0)], "id bigint, v bigint")
        source = spark.createDataFrame([(1, 3), (1, 2), (4, 9), (4, 8)], "id bigint, v bigint")
        assert rows(upsert(target, source, "id", order_by="v")) == [(1, 2), (4, 8)]

    def test_null_keys_match_nothing(self, spark, rows):
        target = spark.createDataFrame([(None, 1), (1, 1)], "id bigint, v bigint")
        source = spark.createDataFrame([(None, 2), (None, 3)], "id bigint, v bigint")
        assert rows(upsert(target, source, "id")) == [(1, 1), (None, 1), (None, 2), (None, 3)]

    def test_composite_keys(self, spark, rows):
        target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "i int, j int, v string")
        source = spark.createDataFrame([("c", 1, 2)], "v string, i int, j int")
        assert rows(upsert(target, source, ["i", "j"])) == [(1, 1, "a"), (1, 2, "c")]

    def test_against_brute_force(self, spark, rows):
        rng = random.Random(5)
        target = [(k, rng.randrange(100)) for k in range(30)] + [(3, 1), (3, 2)]
        source = [(rng.randrange(60), rng.randrange(100)) for _ in range(40)]
        newest = {}
        for k, v in source:
            newest[k] = min(v, newest.get(k, v))
        expected = [row for row in target if row[0] not in newest] + list(newest.items())
        a = spark.createDataFrame(target, "k int, v int")
        b = spark.createDataFrame(source, "k int, v int")
        assert rows(upsert(a, b, "k", order_by="v")) == sorted(expected, key=repr)


@pytest.mark.parametrize("predicate", ["row_count > 3", "row_count > 5", "most > 3", "NULL", lambda df: F.max("v") == 4])
def test_lazy_branch(spark, rows, predicate):
    df = spark.createDataFrame([(1, 1), (2, 4), (None, 2), (3, None)], "id int, v int")
    statistics = {"most": F.max("v")}
    spark.sparkContext.setJobGroup("lazy", "")
    yes, no = branch(df, predicate, statistics=statistics, lazy=True)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    eager = branch(df, predicate, statistics=statistics)
    assert [rows(yes), rows(no)] == [rows(part) for part in eager]
    plan = yes.unionAll(no)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError, match="lazy"):
        branch(df, "row_count > 1", reuse="table", lazy=True)
