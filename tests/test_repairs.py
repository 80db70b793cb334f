"""Cases beyond the clean test tables: odd inputs, unstable inputs, stage data."""

import json
import os
import random
from datetime import date
from urllib.parse import unquote

import pytest
from pyspark.errors import ParseException
from pyspark.sql import functions as F

from rowloom import (
    api_source,
    custom_source,
    deduplicate,
    fan_out,
    ingest_new_files,
    join,
    materialize,
    quality_gate,
    quality_report,
    read_file,
    release,
    render_requests,
    replace_values,
    request_rows,
    run_query,
    run_variables,
    snapshot,
    sort,
    stages,
    task_batches,
    upsert,
    upsert_table,
    write_file,
)
from rowloom.plans import jobs
from rowloom.session import shared_dir
from rowloom.sources.api import parse_payload


class TestReplace:
    """One behaviour, whether the mapping is short or long."""

    CASES = [
        ("string", ["a", "b", None], {"a": True, "b": 1e20}),
        ("binary", [b"a", b"b"], {"a": "x"}),
        ("int", [1, 2, None], {1: 1.5, None: 7}),
        ("int", [1, 2], {"1": 10, "01": 20}),
        ("string", ["2024-01-01", "x"], {date(2024, 1, 1): "new year", "x": None}),
    ]

    @pytest.mark.parametrize(("kind", "values", "mapping"), CASES)
    def test_same_result(self, spark, kind, values, mapping):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, v {kind}")
        padding = {1000 + i: 0 for i in range(200)} if kind == "int" else {f"no {i}": "z" for i in range(200)}
        got = [
            [(r.id, r.v) for r in replace_values(df, "v", m).orderBy("id").collect()]
            for m in (mapping, mapping | padding)
        ]
        assert got[0] == got[1] and len(got[0]) == len(values)

    def test_columns_named_like_helpers(self, spark, rows):
        df = spark.createDataFrame([(1, "o", "n")], "v int, old string, new string")
        assert rows(replace_values(df, "v", {i: i + 1 for i in range(100)})) == [(2, "o", "n")]


class TestUpsert:
    def test_columns_must_agree(self, spark):
        target, source = spark.range(2).selectExpr("id", "1 AS v"), spark.range(2)
        for a, b in ((target, source), (source, target)):
            with pytest.raises(ValueError, match="one side only"):
                upsert(a, b, "id")

    def test_scans(self, spark, tmp_path):
        path = str(tmp_path / "t")
        spark.range(100).selectExpr("id", "1 AS v").write.parquet(path)
        stored = spark.read.parquet(path)
        plan = upsert(stored, stored.selectExpr("id", "v + 1 AS v"), "id")._jdf.queryExecution()
        assert plan.optimizedPlan().toString().count("Relation") <= 4

    def test_missing_and_empty_partitions(self, spark, tmp_path, rows):
        path = str(tmp_path / "t")
        schema = "k int, p string, v string"
        write_file(spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "x", "c"), (4, "y", "d")], schema), path, "parquet", partition_by="p")
        upsert_table(spark.createDataFrame([(9, "", "new"), (3, "x", "C")], schema), path, ["k", "p"], "p")
        got = rows(spark.read.schema(schema).parquet(path).select("k", "p", "v"))
        assert got == sorted([(1, None, "a"), (2, None, "b"), (9, None, "new"), (3, "x", "C"), (4, "y", "d")], key=repr)

    def test_columns_of_the_table_stay(self, spark, tmp_path, rows):
        path = str(tmp_path / "t")
        write_file(spark.createDataFrame([(1, "x", "keep")], "k int, p string, v string"), path, "parquet", partition_by="p")
        with pytest.raises(ValueError, match="one side only"):
            upsert_table(spark.createDataFrame([(2, "x")], "k int, p string"), path, ["k", "p"], "p")
        assert rows(spark.read.parquet(path).select("k", "v")) == [(1, "keep")]

    def test_text_partitions_that_look_like_numbers(self, spark, tmp_path, rows):
        path, schema = str(tmp_path / "t"), "k int, p string"
        write_file(spark.createDataFrame([(1, "01"), (2, "1")], schema), path, "parquet", partition_by="p")
        upsert_table(spark.createDataFrame([(1, "01"), (3, "01")], schema), path, ["k", "p"], "p")
        assert rows(spark.read.schema(schema).parquet(path)) == [(1, "01"), (2, "1"), (3, "01")]


class TestJoins:
    @pytest.mark.parametrize("split", [False, True])
    @pytest.mark.parametrize("how", ["left", "full"])
    def test_unstable_input(self, spark, how, split):
        def with_random_keys(batch):
            return [{"id": row["id"], "k": random.randrange(100)} for row in batch]

        left = task_batches(spark.range(0, 20_000, 1, 4), with_random_keys, "id bigint, k bigint")
        right = spark.range(50).selectExpr("id AS j")
        got = join(left, right, "k=j", how, split_skew=split)
        got = materialize(got)
        assert got.where("id IS NOT NULL").count() == got.select("id").where("id IS NOT NULL").distinct().count() == 20_000

    def test_scans_of_a_left_join(self, spark, tmp_path):
        for name in ("a", "b"):
            spark.range(1000).write.parquet(str(tmp_path / name))
        a, b = (spark.read.parquet(str(tmp_path / n)) for n in ("a", "b"))
        plan = join(a, b, "id", "left")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation") == 2


class TestFiles:
    def test_white_space(self, spark, tmp_path, rows):
        df = spark.createDataFrame([(" a\t", "　b "), ("  ", "c")], "v string, w string")
        for kind, extra in (("csv", {}), ("json", {}), ("xml", {"row_tag": "r"})):
            path = str(tmp_path / kind)
            write_file(df, path, kind, **extra)
            assert rows(read_file(spark, path, kind, "v string, w string", **extra)) == rows(df)

    def test_columns_by_name(self, spark, tmp_path, rows):
        (tmp_path / "leads.csv").write_text("name,email,phone\nAnn,a@x.org,1\n")
        path = str(tmp_path / "leads.csv")
        assert rows(read_file(spark, path, "csv", "email string, NAME string")) == [("a@x.org", "Ann")]
        with pytest.raises(ValueError, match="no such column"):
            read_file(spark, path, "csv", "email string, city string")

    def test_other_header_in_another_file_fails(self, spark, tmp_path):
        (tmp_path / "1.csv").write_text("a,b\n1,2\n")
        (tmp_path / "2.csv").write_text("b,a\n1,2\n")
        with pytest.raises(Exception, match="header"):
            read_file(spark, str(tmp_path), "csv", "a int, b int").collect()

    @pytest.mark.parametrize(
        ("kind", "text", "extra"),
        [
            ("csv", "a,b\n1,x\nx,y\n", {}),
            ("csv", "a,b\n1,x\n2\n", {}),
            ("csv", "a,b\n1,x\n2,y,z\n", {}),
            ("json", '{"a": 1, "b": "x"}\n{"a": \n', {}),
            ("xml", "<t><r><a>1</a><b>x</b></r><r><a>u</a><b>y</b></r></t>", {"row_tag": "r"}),
        ],
    )
    def test_bad_records(self, spark, tmp_path, kind, text, extra):
        path = tmp_path / f"f.{kind}"
        path.write_text(text)
        with pytest.raises(Exception, match="(?i)malformed|parse|MALFORMED"):
            read_file(spark, str(path), kind, "a int, b string", **extra).collect()
        assert read_file(spark, str(path), kind, "a int, b string", malformed="null", **extra).collect()
        kept = read_file(spark, str(path), kind, "a int, b string", bad_records="bad", **extra).cache()
        assert [r.bad is None for r in kept.collect()].count(False) == 1

    def test_stream_with_another_header_fails(self, spark, tmp_path):
        (tmp_path / "in").mkdir()
        (tmp_path / "in" / "1.csv").write_text("b,a\n1,2\n")
        with pytest.raises(Exception, match="(?i)header|STREAM_FAILED"):
            ingest_new_files(spark, str(tmp_path / "in"), "a int, b int", str(tmp_path / "out"), str(tmp_path / "cp"))


class TestPayloads:
    def test_small_batch_does_not_block_later_ones(self, spark, tmp_path, rows):
        incoming, table, pushed = str(tmp_path / "in"), str(tmp_path / "t"), tmp_path / "pushed"
        pushed.mkdir()

        def leads(n, name):
            rows_ = [(f"{name}{i}@x.org", name, "1") for i in range(n)]
            write_file(spark.createDataFrame(rows_, jobs.LEAD_SCHEMA), incoming, "csv", mode="append")

        def push(batch):
            (pushed / f"{random.random()}").write_text(json.dumps([row["email"] for row in batch]))

        for count, name in ((3, "few"), (50, "many")):
            leads(count, name)
            stored = jobs.ingest_leads(spark, incoming, table, str(tmp_path / "cp"), push)
        sent = [mail for file in pushed.iterdir() for mail in json.loads(file.read_text())]
        assert sorted(sent) == sorted(f"many{i}@x.org" for i in range(50))
        assert stored.count() == 50 and spark.read.parquet(table + "-quarantine").count() == 3

    def test_empty_answers_fail(self, spark):
        requests = request_rows(spark, ["a", "b"])
        for answer in ("", "  ", None):
            with pytest.raises(Exception, match="empty answer"):
                api_source(requests, lambda request, a=answer: a, "x int").collect()
        assert api_source(requests, lambda request: "[]", "x int").collect() == []

    def test_missing_payloads(self, spark, rows):
        df = spark.createDataFrame([(1, None), (2, "[]"), (3, '[{"x": 5}]')], "id int, p string")
        assert rows(parse_payload(df, "p", "x int", keep="id")) == [(3, 5)]
        assert rows(parse_payload(df, "p", "x int", keep="id", outer=True)) == [(1, None), (2, None), (3, 5)]


class TestTexts:
    def test_variables_in_text_literals(self, spark):
        values = run_variables(ds="2024-01-15", params={"who": 'a"b'})
        sql = '''SELECT "{{ ds }}" AS a, 'it\\'s {{ ds }}' AS b, "say ""{{ ds }}""" AS c, 'x{{ param.who }}' AS d,
                 date "{{ ds }}" AS e, 'no variable' AS `odd name` -- {{ not.read }}\n'''
        row = run_query(spark, sql, values).first()
        assert [str(x) for x in row] == ["2024-01-15", "it's 2024-01-15", row.c, row.d, "2024-01-15", "no variable"]
        assert "2024-01-15" in row.c and row.d.endswith('a"b') and ":run" not in row.c + row.d

    @pytest.mark.parametrize("sql", ["SELECT 1 AS `{{ ds }}`", "SELECT r'{{ ds }}'", "SELECT 'open {{ ds }}"])
    def test_unreadable_variables(self, spark, sql):
        with pytest.raises((ValueError, ParseException)):
            run_query(spark, sql, run_variables(ds="2024-01-15"))

    def test_requests_are_escaped(self, spark):
        name = 'O\'Neil "Al"\\ /\nñ&'
        df = spark.createDataFrame([(name, None)], "n string, m string")
        row = render_requests(df, "http://h/{{ n }}?m={{ m }}", "PUT", '{"n": "{{ n }}", "m": "{{ m }}"}').first()
        assert json.loads(row.body) == {"n": name, "m": ""}
        assert " " not in row.url and unquote(row.url.removeprefix("http://h/").removesuffix("?m=")) == name

    def test_numeric_bounds_on_text(self, spark):
        df = spark.createDataFrame([("10",), ("100",), ("4",), ("x",), (None,)], "v string")
        report = quality_report(df, ["min(v, 5)", "max(v, 50)", "range(v, 5, 50)", "min(v, m)"])
        assert [r.failed_rows for r in report.orderBy("rule_no").collect()] == [2, 2, 3, 3]


class TestStages:
    @staticmethod
    def folders(spark):
        root = shared_dir(spark).removeprefix("file:") + "/rowloom"
        return len(os.listdir(root)) if os.path.isdir(root) else 0

    def test_nothing_is_left(self, spark):
        materialize(spark.range(1))
        before = self.folders(spark)
        with stages():
            checked = quality_gate(spark.range(100), ["unique(id)", "not_null(id)"])
            assert self.folders(spark) == before + 1
            assert fan_out(checked, [lambda df: df.count()]) == [100]
        assert self.folders(spark) == before
        release(materialize(spark.range(3)))
        release(spark.range(3))
        assert self.folders(spark) == before

    def test_costly_step_runs_once_per_report(self, spark):
        calls = spark.sparkContext.accumulator(0)

        def costly(batch):
            calls.add(len(batch))
            return batch

        df = task_batches(spark.range(0, 90, 1, 3).selectExpr("id", "id AS v"), costly)
        rules = ["unique(id)", "unique(v)", "not_null(id)"]
        with stages():
            report = quality_report(df, rules, reuse="table")
            assert all(row.passed for row in report.collect())
            plan = report._jdf.queryExecution().optimizedPlan().toString()
        assert "InArrow" not in plan
        assert calls.value in (0, 90)  # Spark may not carry accumulators out of these functions


class TestNames:
    def test_sort_and_deduplicate_keep_user_columns(self, spark, rows):
        df = spark.createDataFrame([(2, "a", 5, 1), (1, "b", 6, 2), (1, "c", 7, 0)], "k int, tie string, rank int, best int")
        assert sort(df, "k").columns == df.columns
        kept = deduplicate(df, "k", order_by=F.col("best").desc())
        assert rows(kept) == [(1, "b", 6, 2), (2, "a", 5, 1)]
        assert rows(deduplicate(df, "k", order_by="best")) == [(1, "c", 7, 0), (2, "a", 5, 1)]

    def test_custom_source_obeys_parallelism(self, spark, rows):
        got = custom_source(spark, list(range(50)), lambda n: [{"n": n}], "n int", parallelism=4)
        assert got.rdd.getNumPartitions() == 4
        assert rows(got) == [(n,) for n in range(50)] or sorted(r.n for r in got.collect()) == list(range(50))
        assert custom_source(spark, [], lambda n: [], "n int").collect() == []

    def test_snapshot_keeps_columns_and_rejects_early_dates(self, spark, rows):
        history = spark.createDataFrame([(1, 5, "note", date(2024, 1, 1), None)], "k int, v int, remark string, valid_from date, valid_to date")
        source = spark.createDataFrame([(1, 6)], "k int, v int")
        got = snapshot(history, source, "k", date(2024, 2, 1))
        assert got.columns == history.columns
        assert rows(got) == sorted([(1, 5, "note", date(2024, 1, 1), date(2024, 2, 1)), (1, 6, None, date(2024, 2, 1), None)], key=repr)
        with pytest.raises(Exception, match="before the start"):
            snapshot(history, source, "k", date(2023, 1, 1)).collect()
