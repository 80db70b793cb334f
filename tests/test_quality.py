import logging
from datetime import datetime, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowloom import (
    QualityError,
    RuleError,
    ValidationError,
    parse_quality_rule,
    quality_gate,
    quality_report,
    validate,
)
from rowloom.operators.rules import parse_quality_rules


def rule(column, name, params, on_failure):
    return {"column": column, "rule": name, "params": params, "on_failure": on_failure}


class TestGrammar:
    @pytest.mark.parametrize(
        "text, expected",
        [
            ("not_null(email)", rule("email", "not_null", {}, "block")),
            ("unique(id)", rule("id", "unique", {}, "block")),
            ("min(amount, 0)", rule("amount", "min", {"min": "0"}, "warn")),
            ("max(amount, 75.5)", rule("amount", "max", {"max": "75.5"}, "warn")),
            ("range(share, -1, 1)", rule("share", "range", {"min": "-1", "max": "1"}, "warn")),
            ("row_count(min=7)", rule("", "row_count", {"min": "7"}, "block")),
            (
                "row_count(min=2, max=90)",
                rule("", "row_count", {"min": "2", "max": "90"}, "block"),
            ),
            ("row_count()", rule("", "row_count", {}, "block")),
            (
                "freshness(seen, max_hours=1.5)",
                rule("seen", "freshness", {"max_hours": "1.5"}, "warn"),
            ),
            ("freshness(seen)", rule("seen", "freshness", {}, "warn")),
            (r"regex(code, ^[A-Z]+\d$)", rule("code", "regex", {"pattern": r"^[A-Z]+\d$"}, "warn")),
            ("regex(c, a{1,3})", rule("c", "regex", {"pattern": "a{1,3}"}, "warn")),
            ("regex(c, a, b)", rule("c", "regex", {"pattern": "a, b"}, "warn")),
            ("regex(c, (x))", rule("c", "regex", {"pattern": "(x)"}, "warn")),
            ("type_check(age, int)", rule("age", "type_check", {"expected_type": "int"}, "warn")),
            ("  not_null (  email  ) ", rule("email", "not_null", {}, "block")),
            ("min(a, 1, surplus)", rule("a", "min", {"min": "1"}, "warn")),
            ("range(a, 1, 2, 3)", rule("a", "range", {"min": "1", "max": "2"}, "warn")),
            ("type_check(a, int, x)", rule("a", "type_check", {"expected_type": "int"}, "warn")),
        ],
    )
    def test_accepted(self, text, expected):
        assert parse_quality_rule(text) == expected

    @pytest.mark.parametrize(
        "text",
        [
            "",
            "not_null",
            "not_null(email",
            "not null(email)",
            "not_null()",
            "not_null(a, b)",
            "unique()",
            "min(a)",
            "max()",
            "range(a, 1)",
            "row_count(100)",
            "row_count(min=1,)",
            "freshness()",
            "freshness(a, 24)",
            "regex(a)",
            "type_check(a)",
            "positive(a)",
        ],
    )
    def test_rejected(self, text):
        with pytest.raises(RuleError) as caught:
            parse_quality_rule(text)
        assert caught.value.rule == text.strip()

    @given(
        name=st.sampled_from(["min", "max", "range", "regex", "type_check"]),
        column=st.from_regex(r"[a-z_]\w{0,8}", fullmatch=True),
        values=st.lists(st.from_regex(r"-?\d{1,4}(\.\d)?", fullmatch=True), min_size=2, max_size=2),
        pads=st.lists(st.sampled_from(["", " ", "\t"]), min_size=6, max_size=6),
    )
    def test_white_space_does_not_matter(self, name, column, values, pads):
        used = values if name == "range" else values[:1]
        parts = [pads[i] + part + pads[i + 1] for i, part in enumerate([column, *used])]
        padded = f"{pads[4]}{name}({','.join(parts)}){pads[5]}"
        parsed = parse_quality_rule(padded)
        assert parsed == parse_quality_rule(f"{name}({', '.join([column, *used])})")
        assert parsed["column"] == column and list(parsed["params"].values()) == used

    def test_dict_rules(self):
        full = rule("name", "not_null", {}, "warn")
        parsed = parse_quality_rule(full)
        assert parsed == full and parsed is not full
        assert parse_quality_rule({"column": "a", "rule": "unique"})["on_failure"] == "block"

    @pytest.mark.parametrize(
        "bad",
        [{"rule": "nope"}, {"rule": "not_null"}, {"rule": "min", "column": "a"}, {}],
    )
    def test_bad_dict_rules(self, bad):
        with pytest.raises(RuleError):
            parse_quality_rule(bad)

    @pytest.mark.parametrize("other", [1, None, ["not_null(a)"]])
    def test_other_kinds(self, other):
        with pytest.raises(TypeError):
            parse_quality_rule(other)

    def test_no_rules(self):
        with pytest.raises(ValueError):
            parse_quality_rules([])


def failures(df, *rules, **how):
    lines = quality_report(df, list(rules), **how).orderBy("rule_no").collect()
    return [line.failed_rows for line in lines]


class TestReport:
    @pytest.fixture
    def people(self, spark):
        data = [(1, "a@x.org", 5.0), (2, None, -1.0), (2, "bad", float("nan")), (None, "b@y.org", None)]
        return spark.createDataFrame(data, "id bigint, email string, amount double")

    def test_layout(self, people):
        report = quality_report(people, ["not_null(email)", "unique(id)", "min(amount, 0)"])
        assert report.dtypes == [
            ("rule_no", "int"),
            ("column", "string"),
            ("rule", "string"),
            ("on_failure", "string"),
            ("total_rows", "bigint"),
            ("failed_rows", "bigint"),
            ("passed", "boolean"),
        ]
        assert sorted(tuple(row) for row in report.collect()) == [
            (1, "email", "not_null", "block", 4, 1, False),
            (2, "id", "unique", "block", 4, 1, False),
            (3, "amount", "min", "warn", 4, 1, False),
        ]

    def test_bounds(self, people):
        # NaN is greater than any number, NULL passes.
        assert failures(people, "max(amount, 5)", "range(amount, -1, 5)", "range(id, 1, 2)") == [1, 1, 0]

    def test_bound_types(self, spark):
        df = spark.sql(
            "SELECT 5 AS i, 1.5BD AS d, date '2024-05-01' AS day, "
            "timestamp_ntz '2024-05-01 10:00:00' AS t, 'm' AS s"
        )
        assert failures(
            df,
            "min(i, 4.5)",
            "min(i, 5.5)",
            "max(d, 1.25)",
            "min(day, 2024-05-02)",
            "max(t, 2024-05-01 09:59:59)",
            "max(s, k)",
        ) == [0, 1, 1, 1, 1, 1]

    @pytest.mark.parametrize("text", ["min(id, many)", "max(amount, x)", "range(id, 1, inf)"])
    def test_bound_must_fit(self, people, text):
        with pytest.raises(ValueError, match="does not fit"):
            quality_report(people, [text])

    def test_unknown_column(self, people):
        with pytest.raises(ValueError, match="zzz"):
            quality_report(people, ["not_null(zzz)"])

    def test_row_count(self, people):
        rules = ["row_count()", "row_count(min=4)", "row_count(min=5)", "row_count(max=3)"]
        assert failures(people, *rules) == [0, 0, 1, 1]
        assert failures(people.limit(0), "row_count(max=3)", "row_count(min=1)") == [0, 1]

    def test_unknown_options(self, people):
        with pytest.raises(ValueError):
            quality_report(people, ["row_count(least=1)"])

    def test_empty_input(self, people):
        empty = people.limit(0)
        rules = ["not_null(id)", "unique(id)", "min(id, 0)", "regex(email, x)", "type_check(email, int)"]
        report = quality_report(empty, rules).collect()
        assert [(line.total_rows, line.failed_rows) for line in report] == [(0, 0)] * 5

    def test_regex_is_a_search(self, spark):
        df = spark.createDataFrame([("a, b",), ("a,b",), (None,)], "s string")
        assert failures(df, "regex(s, a, b)", "regex(s, b)", "regex(s, ^b)") == [1, 0, 2]

    def test_regex_on_numbers(self, spark):
        assert failures(spark.range(12), "regex(id, ^\\d$)") == [2]

    def test_type_check(self, spark):
        df = spark.createDataFrame([("1", 1), ("x", 2), (None, None)], "s string, n int")
        assert failures(
            df,
            "type_check(s, int)",
            "type_check(s, float)",
            "type_check(s, string)",
            "type_check(n, int)",
            "type_check(n, float)",
            "type_check(n, string)",
            "type_check(s, date)",
            "type_check(n, bool)",
        ) == [1, 1, 0, 0, 0, 2, 2, 2]

    def test_type_check_dates(self, spark):
        df = spark.createDataFrame([("2024-02-30",), ("2024-02-29",), ("true",)], "s string")
        assert failures(df, "type_check(s, date)", "type_check(s, bool)") == [2, 2]
        assert failures(df, "type_check(s, timestamp)") == [2]

    def test_unknown_type(self, spark):
        with pytest.raises(ValueError, match="decimal"):
            quality_report(spark.range(1), ["type_check(id, decimal)"])

    @pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string"])
    @pytest.mark.parametrize("late, failed", [(-1, 0), (0, 0), (1, 1)])
    def test_freshness_bound(self, spark, kind, late, failed):
        as_of = datetime(2024, 1, 31, 12)
        newest = as_of - timedelta(hours=6, seconds=late)
        df = spark.createDataFrame([(str(newest),), ("2020-01-01 00:00:00",)], "t string")
        df = df.select(F.col("t").cast(kind))
        assert failures(df, "freshness(t, max_hours=6)", as_of=as_of) == [failed]

    def test_freshness_defaults(self, spark):
        now = spark.sql("SELECT localtimestamp() - interval 23 hours AS t, current_date() AS d")
        assert failures(now, "freshness(t)", "freshness(t, max_hours=1)", "freshness(d)") == [0, 1, 0]

    def test_freshness_without_values(self, spark):
        df = spark.createDataFrame([(None,)], "t timestamp_ntz")
        assert failures(df, "freshness(t)") == [1]
        assert failures(df.limit(0), "freshness(t)") == [1]

    def test_no_expand(self, people):
        report = quality_report(people, ["unique(id)", "unique(email)", "unique(amount)"])
        assert "Expand" not in report._jdf.queryExecution().toString()

    def test_against_python(self, spark):
        values = [None if i % 7 == 0 else i % 40 for i in range(1000)]
        present = [v for v in values if v is not None]
        df = spark.createDataFrame([(v,) for v in values], "v int").repartition(5)
        assert failures(df, "not_null(v)", "unique(v)", "range(v, 3, 30)") == [
            len(values) - len(present),
            len(present) - len(set(present)),
            sum(not 3 <= v <= 30 for v in present),
        ]

    def test_streams_are_refused(self, spark):
        with pytest.raises(ValueError, match="foreachBatch"):
            quality_report(spark.readStream.format("rate").load(), ["not_null(value)"])


class TestGate:
    def test_block(self, spark):
        df = spark.createDataFrame([(1,), (1,), (None,)], "id int")
        with pytest.raises(QualityError) as caught:
            quality_gate(df, ["unique(id)", "not_null(id)", "min(id, 5)"])
        assert [line["rule"] for line in caught.value.failed] == ["unique", "not_null"]
        assert len(caught.value.report) == 3
        assert "unique(id): 1 of 3" in str(caught.value)

    @pytest.mark.parametrize("reuse", [None, "persist", "table"])
    def test_warn_passes_data_on(self, spark, rows, caplog, reuse):
        df = spark.createDataFrame([(1,), (2,)], "id int")
        with caplog.at_level(logging.WARNING, "rowloom.quality"):
            result = quality_gate(df, ["min(id, 2)", "not_null(id)"], reuse=reuse)
        assert rows(result) == [(1,), (2,)]
        assert "min(id)" in caplog.text and "not_null" not in caplog.text

    def test_on_failure_may_be_overridden(self, spark):
        df = spark.range(3)
        soft = {"rule": "min", "column": "id", "params": {"min": 2}}
        assert quality_gate(df, [{**soft, "on_failure": "skip"}], reuse=None) is df
        with pytest.raises(QualityError):
            quality_gate(df, [{**soft, "on_failure": "block"}])


class TestValidate:
    def test_column(self, spark):
        df = spark.range(3)
        assert validate(df, lambda d: F.count("*") == 3) is df

    def test_blocked_with_message(self, spark):
        check = lambda d: (F.count("*") >= 10, F.concat(F.lit("got "), F.count("*").cast("string")))
        with pytest.raises(ValidationError, match="got 3"):
            validate(spark.range(3), check)

    @pytest.mark.parametrize("action", ["warn", "skip", ""])
    def test_only_block_raises(self, spark, caplog, action):
        df = spark.range(3)
        with caplog.at_level(logging.WARNING, "rowloom.quality"):
            assert validate(df, lambda d: (F.max("id") > 5, "too small"), action) is df
        assert "too small" in caplog.text

    def test_frame(self, spark):
        df = spark.range(3)
        check = lambda d: d.agg((F.sum("id") == 3).alias("passed"), F.lit("ok").alias("message"))
        assert validate(df, check) is df
        assert validate(df, lambda d: d.agg(F.lit(True))) is df

    def test_null_verdict_fails(self, spark):
        with pytest.raises(ValidationError):
            validate(spark.range(0), lambda d: F.max("id") > 0)

    def test_frame_must_have_one_row(self, spark):
        with pytest.raises(ValueError, match="one row"):
            validate(spark.range(3), lambda d: d.select(F.lit(True)))
