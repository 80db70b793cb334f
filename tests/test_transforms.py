import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rowloom import (
    add_column,
    aggregate,
    aggregate_sets,
    deduplicate,
    drop_columns,
    drop_null,
    filter_rows,
    rename,
    replace_values,
    sort,
    transform,
)
from rowloom.operators.transforms import parse_rule


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame([(1, 2), (3, 4)], "a int, b int")


class TestRename:
    def test_swap(self, pairs, rows):
        swapped = rename(pairs, {"a": "b", "b": "a"})
        assert swapped.columns == ["b", "a"]
        assert rows(swapped) == [(1, 2), (3, 4)]

    def test_unknown_column(self, pairs):
        with pytest.raises(ValueError, match="nope"):
            rename(pairs, {"nope": "x"})

    def test_collision(self, pairs):
        with pytest.raises(ValueError, match="two columns"):
            rename(pairs, {"a": "b"})

    def test_empty_mapping(self, pairs):
        with pytest.raises(ValueError):
            rename(pairs, {})

    def test_odd_names(self, spark):
        df = spark.createDataFrame([(1, 2)], ["a.b", "c`d"])
        assert rename(df, {"a.b": "x y", "c`d": "e.f"}).columns == ["x y", "e.f"]


class TestRenameRule:
    def test_mapping_is_kept(self):
        rule = {"type": "rename", "mapping": {"o_orderdate": "ordered_on"}}
        assert parse_rule(rule) == rule

    def test_alias_type(self):
        rule = {"type": "rename_columns", "mapping": {"l_tax": "tax"}}
        assert parse_rule(rule)["mapping"] == {"l_tax": "tax"}

    def test_shorthand(self):
        assert parse_rule({"type": "rename", "from": "l_tax", "to": "tax"}) == {
            "type": "rename",
            "mapping": {"l_tax": "tax"},
        }

    def test_input_is_not_changed(self):
        rule = {"type": "rename", "from": "x", "to": "y"}
        parse_rule(rule)
        assert rule == {"type": "rename", "from": "x", "to": "y"}

    @pytest.mark.parametrize(
        "rule",
        [
            {"type": "rename", "from": "x"},
            {"type": "rename", "to": "y"},
            {"type": "rename", "from": "x", "to": "y", "mapping": {"a": "b"}},
            {"type": "rename", "from": "x", "mapping": {"a": "b"}},
            {"type": "rename", "mapping": {}},
            {"type": "rename", "mapping": ["a", "b"]},
            {"type": "rename"},
        ],
    )
    def test_rejected(self, rule):
        with pytest.raises(ValueError, match="#3"):
            parse_rule(rule, 3)

    @pytest.mark.parametrize("rule", [42, None, ["rename"]])
    def test_wrong_kind(self, rule):
        with pytest.raises(TypeError, match="#2"):
            parse_rule(rule, 2)


class TestRuleList:
    def test_in_order(self, pairs, rows):
        result = transform(
            pairs,
            [
                {"type": "rename", "from": "a", "to": "k"},
                {"type": "add_column", "name": "sum", "expression": "k + b"},
                "FILTER sum > 3",
                {"type": "drop_columns", "columns": ["b"]},
            ],
        )
        assert result.columns == ["k", "sum"]
        assert rows(result) == [(3, 7)]

    def test_no_rules_pass_through(self, pairs):
        with pytest.warns(UserWarning, match="without rules"):
            assert transform(pairs, []) is pairs

    def test_unknown_type(self, pairs):
        with pytest.raises(ValueError, match="explode"):
            transform(pairs, [{"type": "explode"}])

    def test_all_rules_are_checked_first(self, pairs):
        with pytest.raises(TypeError, match="#2"):
            transform(pairs, [{"type": "filter_rows", "condition": "no_such > 1"}, 7])

    @pytest.mark.parametrize("text", ["upper(a)", "drop_null()", "FILTER", "select 1", ""])
    def test_unreadable_text(self, text):
        with pytest.raises(ValueError):
            parse_rule(text)

    def test_text_rules(self):
        assert parse_rule(" drop_null( a ) ") == {"type": "drop_null", "columns": ["a"]}
        assert parse_rule("deduplicate(a, b)") == {"type": "deduplicate", "columns": ["a", "b"]}
        assert parse_rule("deduplicate()") == {"type": "deduplicate", "columns": []}
        assert parse_rule("filter x > 0") == {"type": "filter_rows", "condition": "x > 0"}


class TestColumns:
    def test_drop(self, pairs):
        assert drop_columns(pairs, ["a"]).columns == ["b"]

    def test_drop_unknown(self, pairs):
        with pytest.raises(ValueError, match="zzz"):
            drop_columns(pairs, ["zzz"])

    def test_add(self, pairs, rows):
        assert rows(add_column(pairs, "c", "a + b")) == [(1, 2, 3), (3, 4, 7)]
        assert rows(add_column(pairs, "c", F.col("a") * 2)) == [(1, 2, 2), (3, 4, 6)]

    @pytest.mark.parametrize("name, expression", [("", "a"), ("c", "")])
    def test_add_needs_both(self, pairs, name, expression):
        with pytest.raises(ValueError):
            add_column(pairs, name, expression)

    def test_filter_drops_null_conditions(self, spark, rows):
        df = spark.createDataFrame([("kept",), ("deleted",), (None,)], "status string")
        assert rows(filter_rows(df, "status != 'deleted'")) == [("kept",)]


class TestReplace:
    @pytest.fixture
    def values(self, spark):
        return spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "v string")

    def test_no_chaining(self, values, rows):
        result = rows(replace_values(values, "v", {"a": "b", "b": "c"}))
        assert result == [("b",), ("c",), ("c",), (None,)]

    def test_null_key_and_value(self, values, rows):
        result = rows(replace_values(values, "v", {None: "none", "a": None}))
        assert result == [("b",), ("c",), ("none",), (None,)]

    def test_long_mapping_gives_the_same(self, spark, rows):
        df = spark.createDataFrame([(n,) for n in range(200)] + [(None,)], "v int")
        mapping = {n: n + 1 for n in range(0, 200, 2)}
        expected = sorted(((mapping.get(n, n),) for n in [*range(200), None]), key=repr)
        result = replace_values(df, "v", mapping)
        assert rows(result) == expected
        assert result.schema == df.schema

    def test_long_mapping_is_broadcast_by_size_only(self, spark):
        result = replace_values(spark.range(200), "id", {n: -n for n in range(100)})
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = result._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Broadcast" not in plan
            assert result.agg(F.sum("id")).first()[0] == sum(range(100, 200)) - sum(range(100))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    def test_long_mapping_null_key(self, spark, rows):
        df = spark.createDataFrame([("1",), (None,)], "v string")
        mapping = {None: "none", **{str(n): f"n{n}" for n in range(100)}}
        assert rows(replace_values(df, "v", mapping)) == [("n1",), ("none",)]

    def test_text_for_numbers(self, spark, rows):
        df = spark.createDataFrame([(1,), (2,)], "v int")
        assert rows(replace_values(df, "v", {"1": "one"})) == [("2",), ("one",)]

    def test_unknown_column(self, values):
        with pytest.raises(ValueError):
            replace_values(values, "w", {"a": "b"})


class TestSort:
    def test_nulls_last_both_ways(self, spark):
        df = spark.createDataFrame([(2,), (None,), (1,)], "v int")
        assert [row.v for row in sort(df, "v").collect()] == [1, 2, None]
        assert [row.v for row in sort(df, "v", False).collect()] == [2, 1, None]

    def test_several_columns(self, spark):
        rng = random.Random(1)
        data = [(rng.randrange(4), rng.randrange(50)) for _ in range(300)]
        df = spark.createDataFrame(data, "a int, b int").repartition(7)
        result = [tuple(row) for row in sort(df, ["a", "b"], [True, False]).collect()]
        assert result == sorted(data, key=lambda row: (row[0], -row[1]))

    def test_hot_value_is_spread(self, spark):
        hot = spark.range(0, 20_000, 1, 8).selectExpr("if(id % 3 = 0, id, 7) AS v")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            result = sort(hot, "v").withColumn("task", F.spark_partition_id()).collect()
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        sizes = Counter(row.task for row in result)
        assert len(sizes) == 4 and max(sizes.values()) < 8_000
        values = [row.v for row in result]
        assert values == sorted(values) and len(values) == 20_000

    def test_directions_must_fit(self, pairs):
        with pytest.raises(ValueError):
            sort(pairs, ["a", "b"], [True])


class TestDeduplicate:
    @pytest.fixture
    def events(self, spark):
        data = [(1, 2, "late"), (1, 1, "early"), (None, 1, "n"), (None, 2, "n2"), (2, None, "x")]
        return spark.createDataFrame(data, "k int, ord int, v string").repartition(3)

    def test_first_by_order(self, events, rows):
        assert rows(deduplicate(events, "k", order_by="ord")) == [
            (1, 1, "early"),
            (2, None, "x"),
            (None, 1, "n"),
        ]

    def test_last_by_order(self, events, rows):
        result = deduplicate(events, ["k"], order_by=F.col("ord").desc_nulls_last())
        assert (1, 2, "late") in rows(result)

    def test_ties_are_settled(self, events, rows):
        assert rows(deduplicate(events, "k")) == [(1, 1, "early"), (2, None, "x"), (None, 1, "n")]
        tied = events.withColumn("ord", F.lit(0))
        assert (1, 0, "early") in rows(deduplicate(tied, "k", order_by="ord"))

    def test_order_by_missing_column(self, events):
        with pytest.raises(ValueError, match="zzz"):
            deduplicate(events, "k", order_by="zzz")

    def test_odd_names(self, spark, rows):
        df = spark.createDataFrame([(1, 2, 3), (1, 1, 9)], ["k.x", "o`y", "row"])
        assert rows(deduplicate(df, "k.x", order_by="o`y")) == [(1, 1, 9)]

    def test_maps_and_nested_rows(self, spark):
        df = spark.sql(
            "SELECT * FROM VALUES (1, map('a', 1), 2), (1, map('b', 2), 1) AS t(k, m, o)"
        )
        assert deduplicate(df, "k", order_by="o").first().m == {"b": 2}
        assert deduplicate(df, "k").count() == 1
        nested = df.selectExpr("k", "struct(o, array(o) AS l) AS s")
        assert deduplicate(nested, "k").first().s.l == [1]

    def test_schema_is_kept(self, events):
        assert deduplicate(events, "v", order_by="ord").dtypes == events.dtypes

    def test_whole_rows(self, events):
        assert deduplicate(events.union(events)).count() == 5

    def test_order_needs_keys(self, events):
        with pytest.raises(ValueError):
            deduplicate(events, order_by="ord")

    def test_partial_before_shuffle(self, events):
        def plan(order):
            return deduplicate(events, "k", order_by=order)._jdf.queryExecution().toString()

        assert "partial_min" in plan("ord") and "partial_min" in plan(None)
        ranked = plan(F.col("ord").desc())
        assert "WindowGroupLimit" in ranked and "Partial" in ranked


class TestAggregate:
    @pytest.fixture
    def sales(self, spark):
        data = [("a", 1, 1.0), ("a", 1, None), ("b", 2, 4.0), ("b", 3, 6.0)]
        return spark.createDataFrame(data, "k string, n int, v double")

    def test_functions_and_names(self, sales, rows):
        fields = [
            {"column": "v", "function": f}
            for f in ("sum", "avg", "mean", "min", "max", "count", "count_distinct")
        ]
        result = aggregate(sales, ["k"], fields)
        assert result.columns == [
            "k", "v_sum", "v_avg", "v_mean", "v_min", "v_max", "v_count", "v_count_distinct",
        ]
        assert rows(result) == [
            ("a", 1.0, 1.0, 1.0, 1.0, 1.0, 1, 1),
            ("b", 10.0, 5.0, 5.0, 4.0, 6.0, 2, 2),
        ]

    def test_global(self, sales, rows):
        fields = [
            {"column": "n", "function": "count_distinct", "alias": "kinds"},
            {"column": "*", "function": "count"},
        ]
        result = aggregate(sales, [], fields)
        assert result.columns == ["kinds", "count"]
        assert rows(result) == [(3, 4)]

    def test_empty_input(self, sales, rows):
        field = [{"column": "v", "function": "sum"}]
        assert rows(aggregate(sales.limit(0), [], field)) == [(None,)]
        assert rows(aggregate(sales.limit(0), "k", field)) == []

    @pytest.mark.parametrize(
        "keys, fields",
        [
            (["k"], []),
            (["k"], [{"column": "v", "function": "median"}]),
            (["k"], [{"column": "*", "function": "sum"}]),
            (["zzz"], [{"column": "v", "function": "sum"}]),
            (["k"], [{"column": "zzz", "function": "sum"}]),
            (["k"], [{"column": "v", "function": "sum"}, {"column": "v", "function": "sum"}]),
        ],
    )
    def test_rejected(self, sales, keys, fields):
        with pytest.raises(ValueError):
            aggregate(sales, keys, fields)


def test_drop_null(spark, rows):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (3, None)], "a int, b string")
    assert rows(drop_null(df, "a")) == [(1, "x"), (3, None)]
    assert rows(drop_null(df, ["a", "b"])) == [(1, "x")]
    with pytest.raises(ValueError):
        drop_null(df, "zzz")


class TestStreams:
    @pytest.fixture
    def stream(self, spark):
        return spark.readStream.format("rate").load()

    def test_row_wise_rules_apply(self, stream):
        result = transform(
            stream,
            [
                {"type": "rename", "mapping": {"value": "n"}},
                "FILTER n > 1",
                {"type": "add_column", "name": "m", "expression": "n * 2"},
                {"type": "replace_values", "column": "n", "mapping": {3: 4}},
                {"type": "drop_columns", "columns": ["timestamp"]},
            ],
        )
        assert result.isStreaming and result.columns == ["n", "m"]

    def test_others_are_refused(self, stream):
        with pytest.raises(ValueError, match="foreachBatch"):
            sort(stream, "value")
        with pytest.raises(ValueError, match="foreachBatch"):
            aggregate(stream, [], [{"column": "value", "function": "sum"}])
        with pytest.raises(ValueError, match="foreachBatch"):
            deduplicate(stream, "value", order_by="timestamp")

    def test_deduplicate_within_watermark(self, stream):
        limited = stream.withWatermark("timestamp", "1 minute")
        assert deduplicate(limited, "value").isStreaming


def test_timestamps_stay_untouched(spark, rows):
    moment = datetime(2024, 1, 1, 12, 30, 15, 123456)
    df = spark.createDataFrame([(moment,)], "t timestamp_ntz")
    assert rows(transform(df, ["FILTER t > timestamp_ntz '2024-01-01'"])) == [(moment,)]


SET_FIELDS = [
    {"column": "v", "function": f, "alias": f"v_{f}"} for f in ("sum", "avg", "min", "max", "count", "count_distinct")
] + [{"column": "*", "function": "count"}, {"column": "d", "function": "avg"}, {"column": "s", "function": "count_distinct"}]


@pytest.mark.parametrize("count", [0, 60])
@pytest.mark.parametrize("sets", [[("a", "b"), ("a",), ()], [("b",), ("a",)], [()]])
def test_grouping_sets_as_sql_does_them(spark, rows, tmp_path, count, sets):
    made = spark.range(0, count, 1, 3).selectExpr(
        "if(id % 5 = 0, NULL, id % 3) AS a", "if(id % 7 = 0, NULL, 'b' || id % 2) AS b", "if(id % 4 = 0, NULL, id % 9) AS v",
        "CAST(id AS DECIMAL(10, 2)) / 3 AS d", "if(id % 2 = 0, NULL, 's' || id % 6) AS s"
    )
    made.write.parquet(str(tmp_path / "given"))
    df = spark.read.parquet(str(tmp_path / "given"))
    got = aggregate_sets(df, sets, SET_FIELDS)
    keys = list(dict.fromkeys(k for names in sets for k in names))
    shown = ", ".join([*keys, f"grouping_id({', '.join(keys)})" if keys else "0L"])
    fields = "sum(v), avg(v), min(v), max(v), count(v), count(DISTINCT v), count(*), avg(d), count(DISTINCT s)"
    listed = ", ".join(f"({', '.join(names)})" for names in sets)
    grouped = f"GROUP BY GROUPING SETS ({listed})" if keys else ""
    wanted = spark.sql(f"SELECT {shown}, {fields} FROM {{df}} {grouped}", df=df)
    assert [f.dataType for f in got.schema] == [f.dataType for f in wanted.schema]
    if count:
        assert rows(got) == rows(wanted)
    else:  # the global row is there also for an empty input, as for aggregate
        assert got.count() == sets.count(())
    # What is planned reads the finest level and no longer the input.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "finest-level" in plan and "given" not in plan


def test_grouping_sets_rejects(spark):
    df = spark.createDataFrame([(1, 2)], "a int, grouping_id int")
    with pytest.raises(ValueError, match="twice"):
        aggregate_sets(df, [("a",), ("a",)], [{"column": "*", "function": "count"}])
    with pytest.raises(ValueError, match="grouping_id"):
        aggregate_sets(df, [("grouping_id",)], [{"column": "*", "function": "count"}])
