import json
from datetime import date, datetime

import pytest

from rowloom import (
    api_source,
    custom_source,
    http_fetch,
    open_payload,
    payload_shape,
    read_db,
    read_file,
    render_text,
    request_rows,
    run_query,
    run_variables,
    seed_table,
)
from rowloom.sources.api import parse_payload
from rowloom.sources.database import jdbc_read_options


class TestFiles:
    def test_csv(self, spark, tmp_path, rows):
        path = tmp_path / "users.csv"
        path.write_text('id,name,note\n1,"O""Neil, Ann",\n2,Bob,""\n')
        df = read_file(spark, str(path), "csv", "id int, name string, note string")
        assert df.columns == ["id", "name", "note"]
        assert rows(df)[0][:2] == (1, 'O"Neil, Ann')

    def test_csv_is_text_without_schema(self, spark, tmp_path):
        path = tmp_path / "n.csv"
        path.write_text("a\n1\n")
        assert read_file(spark, str(path)).dtypes == [("a", "string")]
        assert read_file(spark, str(path), infer_schema=True).dtypes == [("a", "int")]

    def test_json_lines_and_document(self, spark, tmp_path, rows):
        lines, document = tmp_path / "l.json", tmp_path / "d.json"
        users = [{"id": 1, "address": {"city": "Rome"}}, {"id": 2, "address": None}]
        lines.write_text("\n".join(json.dumps(user) for user in users))
        document.write_text(json.dumps(users, indent=1))
        schema = "id int, address struct<city: string>"
        first = read_file(spark, str(lines), "json", schema).select("id", "address.city")
        second = read_file(spark, str(document), "json", schema, multi_line=True)
        assert rows(first) == rows(second.select("id", "address.city")) == [(1, "Rome"), (2, None)]

    def test_xml(self, spark, tmp_path, rows):
        path = tmp_path / "u.xml"
        path.write_text("<us><u><id>1</id><n>a &amp; b</n></u><u><id>2</id></u></us>")
        df = read_file(spark, str(path), "xml", "id int, n string", row_tag="u")
        assert rows(df) == [(1, "a & b"), (2, None)]

    def test_rejected(self, spark):
        with pytest.raises(ValueError, match="path"):
            read_file(spark, "")
        with pytest.raises(ValueError, match="excel"):
            read_file(spark, "x", "excel")
        with pytest.raises(ValueError, match="row_tag"):
            read_file(spark, "x", "xml")

    def test_seed(self, spark, tmp_path, rows):
        path = tmp_path / "s.csv"
        path.write_text("k,day\n1,2024-01-02\n")
        target = str(tmp_path / "seed")
        for _ in range(2):
            table = seed_table(spark, str(path), "k int, day date", target)
        assert rows(table) == [(1, date(2024, 1, 2))]


class TestDatabase:
    """Options only: no database may be started here."""

    URL = "jdbc:postgresql://db/x"

    def test_query(self):
        assert jdbc_read_options(self.URL, "SELECT 1", timeout=60) == {
            "url": self.URL,
            "fetchsize": "10000",
            "query": "SELECT 1",
            "queryTimeout": "60",
        }

    def test_table(self):
        options = jdbc_read_options(self.URL, table="t", properties={"user": "me"})
        assert options["dbtable"] == "t" and options["user"] == "me"

    def test_parallel_query_becomes_a_derived_table(self):
        options = jdbc_read_options(
            self.URL,
            "SELECT * FROM o; ",
            partition_column="id",
            lower_bound=0,
            upper_bound=100,
            num_partitions=8,
        )
        assert options["dbtable"] == "(SELECT * FROM o) source"
        assert "query" not in options
        assert options["numPartitions"] == "8" and options["partitionColumn"] == "id"

    @pytest.mark.parametrize(
        "arguments",
        [
            {"url": "", "query": "SELECT 1"},
            {"url": "u"},
            {"url": "u", "query": "SELECT 1", "table": "t"},
            {"url": "u", "query": "SELECT 1", "partition_column": "id"},
        ],
    )
    def test_rejected(self, spark, arguments):
        with pytest.raises(ValueError):
            read_db(spark, **arguments)


class TestApi:
    SCHEMA = "id bigint, name string"

    def test_one_request_per_row(self, spark, rows):
        requests = request_rows(spark, ["u/1", "u/2"], headers={"Accept": "application/json"})

        def fetch(request):
            assert request["headers"] == {"Accept": "application/json"}
            assert request["method"] == "GET" and request["body"] is None
            number = int(request["url"][-1])
            return json.dumps([{"id": number, "name": "a"}, {"id": number * 10}])

        result = api_source(requests, fetch, self.SCHEMA, parallelism=2)
        assert rows(result) == [(1, "a"), (10, None), (2, "a"), (20, None)]

    def test_single_object_and_empty_list(self, spark, rows):
        requests = request_rows(spark, ["one", "none"])
        answers = {"one": '{"id": 5, "name": "x"}', "none": "[]"}
        result = api_source(requests, lambda request: answers[request["url"]], self.SCHEMA)
        assert rows(result) == [(5, "x")]

    def test_malformed_payload_fails(self, spark):
        with pytest.raises(Exception, match="MALFORMED"):
            api_source(request_rows(spark, "u"), lambda request: "<html>", self.SCHEMA).collect()

    def test_standard_library_fetch(self, spark, tmp_path, rows):
        path = tmp_path / "users.json"
        path.write_text('[{"id": 1, "name": "é"}]')
        result = api_source(request_rows(spark, path.as_uri()), http_fetch(timeout=5), self.SCHEMA)
        assert rows(result) == [(1, "é")]

    def test_url_is_required(self, spark):
        with pytest.raises(ValueError):
            request_rows(spark, "")
        with pytest.raises(ValueError):
            api_source(spark.range(1), lambda request: "[]", self.SCHEMA)

    def test_parse_keeps_columns(self, spark, rows):
        df = spark.createDataFrame([(1, '[{"id": 2}, {"id": 3}]')], "key int, body string")
        assert rows(parse_payload(df, "body", "id int", keep="key")) == [(1, 2), (1, 3)]


class TestCustom:
    def test_one_task_per_spec(self, spark, rows):
        def read(spec):
            for number in range(spec["start"], spec["end"]):
                yield {"n": number}

        specs = [{"start": 0, "end": 3}, {"start": 10, "end": 12}]
        result = custom_source(spark, specs, read, "n bigint, other string")
        assert rows(result) == [(n, None) for n in (0, 1, 10, 11, 2)]
        assert result.rdd.getNumPartitions() == 2

    def test_specs_as_rows(self, spark):
        specs = spark.range(1, 5).withColumnRenamed("id", "size")
        result = custom_source(
            spark, specs, lambda spec: ({"n": i} for i in range(spec["size"])), "n int", parallelism=3
        )
        assert result.count() == 10

    def test_large_specs_leave_in_pieces(self, spark):
        result = custom_source(spark, [9_000], lambda size: ({"n": i} for i in range(size)), "n int")
        assert result.count() == 9_000

    def test_no_rows_keep_the_schema(self, spark):
        assert custom_source(spark, [], lambda spec: [], "n int").columns == ["n"]
        result = custom_source(spark, [1], lambda spec: [], "n int")
        assert result.columns == ["n"] and result.count() == 0


class TestVariables:
    def test_values(self):
        values = run_variables(ds="2024-02-28", variables={"k": 1}, params={"p": "x"})
        assert values == {
            "ds": date(2024, 2, 28),
            "next_ds": date(2024, 2, 29),
            "ts": "2024-02-28T00:00:00",
            "var.k": 1,
            "param.p": "x",
        }
        given = run_variables(date(2024, 1, 1), "2024-01-08", datetime(2024, 1, 1, 6))
        assert given["next_ds"] == date(2024, 1, 8) and given["ts"] == "2024-01-01T06:00:00"

    def test_paths(self):
        values = run_variables(ds="2024-01-15", params={"region": "eu"})
        path = render_text("/data/{{ param.region }}/output_{{ds}}.csv", values)
        assert path == "/data/eu/output_2024-01-15.csv"

    def test_unknown(self, spark):
        with pytest.raises(ValueError, match="secret.key"):
            render_text("{{ secret.key }}", {})
        with pytest.raises(ValueError, match="ds"):
            run_query(spark, "SELECT {{ ds }}")


class TestQuery:
    VALUES = run_variables(ds="2024-01-15", params={"low": 5, "name": "x' OR '1'='1", "n": "ab"})

    def one(self, spark, query, **frames):
        return run_query(spark, query, self.VALUES, **frames).first()[0]

    def test_typed_parameters(self, spark):
        day = date(2024, 1, 15)
        assert self.one(spark, "SELECT {{ ds }}") == day
        assert self.one(spark, "SELECT '{{ ds }}'") == day
        assert self.one(spark, "SELECT DATE '{{ ds }}'") == day
        assert self.one(spark, "SELECT {{ next_ds }} - {{ds}} = INTERVAL 1 DAY") is True
        assert self.one(spark, "SELECT TIMESTAMP '{{ ts }}' = timestamp '2024-01-15'") is True
        assert self.one(spark, "SELECT {{ param.low }} + 1") == 6

    def test_inside_longer_text(self, spark):
        assert self.one(spark, "SELECT 'a {{ ds }} b'") == "a 2024-01-15 b"
        assert self.one(spark, "SELECT 'abc' LIKE '{{ param.n }}%'") is True
        assert self.one(spark, "SELECT 'it''s {{ ds }}'") == "it's 2024-01-15"

    def test_comments_and_plain_text_stay(self, spark):
        query = "SELECT 'x' /* it's {{ nothing }} */ -- don't {{ know }}\n"
        assert self.one(spark, query) == "x"

    def test_values_cannot_change_the_statement(self, spark):
        query = "SELECT count(*) FROM {d} WHERE s = '{{ param.name }}'"
        assert self.one(spark, query, d=spark.sql("SELECT 'y' AS s")) == 0

    def test_frames_and_arguments(self, spark, rows):
        df = spark.createDataFrame([(1, 10), (1, 5), (2, 7)], "k int, v int")
        query = "SELECT k, sum(v) AS s FROM {df} WHERE v > :least GROUP BY k"
        assert rows(run_query(spark, query, args={"least": 6}, df=df)) == [(1, 10), (2, 7)]

    def test_other_braces_are_text(self, spark, rows):
        df = spark.createDataFrame([("AAB",), ("AB",)], "s string")
        assert rows(run_query(spark, "SELECT s FROM {df} WHERE s RLIKE '^A{2}'", df=df)) == [("AAB",)]
        assert self.one(spark, "SELECT '{\"k\": {}}' AS j FROM {df}", df=df) == '{"k": {}}'

    def test_partition_pruning(self, spark, tmp_path):
        path = str(tmp_path / "days")
        df = spark.sql("SELECT explode(sequence(date '2024-01-10', date '2024-01-20')) AS day, 1 AS v")
        df.write.partitionBy("day").parquet(path)
        result = run_query(
            spark, "SELECT * FROM {days} WHERE day = '{{ ds }}'", self.VALUES, days=spark.read.parquet(path)
        )
        assert len(result.inputFiles()) == 1 or "day" in result._jdf.queryExecution().toString()
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(day" in plan
        assert result.count() == 1

    def test_empty(self, spark):
        with pytest.raises(ValueError):
            run_query(spark, " ")


OPEN = [(1, '{"a": 1, "b": {"c": ["x", "y"]}}'), (2, '{"a": "text"}'), (3, None), (4, '{"b": {"c": []}}'), (5, "[1]"), (6, '{"a": 2.5}')]


def test_open_payload(spark, rows):
    df = spark.createDataFrame(OPEN, "id int, p string")
    fields = {"a": ("$.a", "int"), "text": ("$.a", "string"), "second": ("$.b.c[1]", "string"), "b": ("$.b", "struct<c: array<string>>")}
    got = {r.id: (r.a, r.text, r.second, r.b and r.b.c) for r in open_payload(df, "p", fields, keep="id").collect()}
    assert got == {
        1: (1, "1", "y", ["x", "y"]),
        2: (None, "text", None, None),
        3: (None, None, None, None),
        4: (None, None, None, []),
        5: (None, None, None, None),
        6: (2, "2.5", None, None),
    }
    shape = payload_shape(df.where("id <> 5"), "p")
    assert "a:" in shape.replace(" ", "") and "ARRAY<STRING>" in shape
    assert payload_shape(df.where("id = 3"), "p") == "VOID"


def test_open_payload_that_does_not_fit(spark, rows):
    df = spark.createDataFrame([(1, '{"a": "x"}'), (2, "{oh")], "id int, p string")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        open_payload(df, "p", {"a": ("$.a", "string")}).collect()
    assert rows(open_payload(df, "p", {"a": ("$.a", "string")}, malformed="null")) == sorted([("x",), (None,)], key=repr)
    with pytest.raises(Exception, match="(?i)cast"):
        open_payload(df, "p", {"a": ("$.a", "int")}, malformed="null", strict=True).collect()
    with pytest.raises(ValueError, match="two columns"):
        open_payload(df, "p", {"ID": ("$.a", "int")}, keep="id")
