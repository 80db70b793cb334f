import json
import os
import urllib.parse
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from rowloom import (
    custom_sink,
    deliver,
    materialize,
    migrate,
    read_file,
    render_requests,
    upsert_table,
    write_db,
    write_file,
)
from rowloom.session import new_path, shared_dir
from rowloom.sinks.database import upsert_statement

SCHEMA = "id bigint, text string, t timestamp_ntz, z timestamp, x double"


@pytest.fixture
def data(spark):
    moment = datetime(2024, 1, 1, 1, 2, 3, 456789)
    rows = [
        (1, 'a "quoted", text', moment, moment, 1.5),
        (2, "", moment, None, None),
        (3, None, None, moment, -0.1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


class TestFiles:
    @pytest.mark.parametrize(
        "format, compress",
        [
            ("csv", ""),
            ("csv", "gzip"),
            ("csv", "snappy"),
            ("json", ""),
            ("json", "gzip"),
            ("parquet", ""),
            ("parquet", "snappy"),
            ("parquet", "gzip"),
        ],
    )
    def test_round_trip(self, spark, data, rows, tmp_path, format, compress):
        path = str(tmp_path / "out")
        options = {"nullValue": "\\N"} if format == "csv" else {}
        assert write_file(data, path, format, compress, options=options) is data
        assert rows(read_file(spark, path, format, SCHEMA, options=options)) == rows(data)
        if compress:
            ending = {"gzip": ".gz", "snappy": ".snappy"}[compress]
            names = [n for n in os.listdir(path) if n.startswith("part-")]
            assert names and all(ending in name for name in names)

    def test_xml(self, spark, data, rows, tmp_path):
        path = str(tmp_path / "out")
        write_file(data.select("id", "x"), path, "xml", row_tag="r")
        assert rows(read_file(spark, path, "xml", "id bigint, x double", row_tag="r")) == rows(
            data.select("id", "x")
        )

    def test_xml_files_do_not_grow_with_the_rows_of_a_task(self, spark, rows, tmp_path, monkeypatch):
        monkeypatch.setattr("rowloom.sinks.files.WHOLE_FILE_BYTES", 20_000, raising=False)
        schema = "id bigint, s string, p struct<a:array<int>,b:date>"
        for number in (1_000, 4_000):
            path = str(tmp_path / f"out{number}")
            df = spark.range(0, number, 1, 1).selectExpr("id", "concat('t', id) AS s", "struct(array(1, 2) AS a, date'2024-01-01' AS b) AS p")
            write_file(df, path, "xml", row_tag="r")
            sizes = [os.path.getsize(f"{path}/{n}") for n in os.listdir(path) if n.startswith("part-")]
            assert max(sizes) <= 20_000 and len(sizes) <= number / 20
            assert rows(read_file(spark, path, "xml", schema, row_tag="r")) == rows(df)

    @pytest.mark.parametrize(("format", "codec", "several"), [("csv", "gzip", True), ("json", "gzip", True), ("xml", "gzip", True), ("csv", "", False), ("json", "bzip2", False), ("parquet", "gzip", False)])
    def test_compressed_files_do_not_grow_with_the_rows_of_a_task(self, spark, rows, tmp_path, monkeypatch, format, codec, several):
        monkeypatch.setattr("rowloom.sinks.files.COMPRESSED_FILE_BYTES", 50_000, raising=False)
        path, df, tag = str(tmp_path / "out"), spark.range(0, 5_000, 1, 1).selectExpr("id", "concat('t', id) AS s"), {"row_tag": "r"} if format == "xml" else {}
        write_file(df, path, format, codec, **tag)
        assert (len([n for n in os.listdir(path) if n.startswith("part-")]) > 10) == several
        assert rows(read_file(spark, path, format, "id bigint, s string", **tag)) == rows(df)

    def test_xml_keeps_a_smaller_number_of_rows(self, spark, tmp_path):
        path, df = str(tmp_path / "out"), spark.range(0, 100, 1, 1)
        write_file(df, path, "xml", row_tag="r", options={"maxRecordsPerFile": 20})
        spark.conf.set("spark.sql.files.maxRecordsPerFile", 10)
        try:
            write_file(df, path, "xml", row_tag="r", mode="append")
        finally:
            spark.conf.unset("spark.sql.files.maxRecordsPerFile")
        assert len([n for n in os.listdir(path) if n.startswith("part-")]) == 5 + 10

    def test_line_breaks(self, spark, rows, tmp_path):
        path = str(tmp_path / "out")
        df = spark.createDataFrame([(1, 'two\nlines, "x"\\')], "id int, s string")
        write_file(df, path, "csv")
        assert rows(read_file(spark, path, "csv", "id int, s string", multi_line=True)) == rows(df)

    def test_csv_reads_empty_text_as_null(self, spark, data, rows, tmp_path):
        path = str(tmp_path / "out")
        write_file(data, path, "csv")
        expected = data.withColumn("text", F.expr("nullif(text, '')"))
        assert rows(read_file(spark, path, "csv", SCHEMA)) == rows(expected)

    def test_json_keeps_null_fields(self, data, tmp_path):
        path = str(tmp_path / "out")
        write_file(data.filter("id = 3").coalesce(1), path, "json")
        (name,) = [n for n in os.listdir(path) if n.startswith("part-")]
        with open(os.path.join(path, name)) as lines:
            assert json.loads(lines.readline())["text"] is None

    def test_modes(self, spark, data, tmp_path):
        path = str(tmp_path / "out")
        write_file(data, path, "parquet")
        with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
            write_file(data, path, "parquet")
        write_file(data, path, "parquet", mode="append")
        assert spark.read.parquet(path).count() == 6

    def test_partition_overwrite_replaces_only_what_occurs(self, spark, rows, tmp_path):
        path = str(tmp_path / "out")
        first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "v int, day string")
        write_file(first, path, "parquet", partition_by="day")
        again = spark.createDataFrame([(9, "b")], "v int, day string")
        for _ in range(2):
            write_file(again, path, "parquet", mode="overwrite", partition_by="day")
        assert rows(read_file(spark, path, "parquet", "v int, day string")) == [(1, "a"), (9, "b")]

    def test_partitioned_write_makes_few_files(self, spark, tmp_path):
        path = str(tmp_path / "out")
        df = spark.range(0, 4000, 1, 16).withColumn("part", F.col("id") % 5)
        write_file(df, path, "parquet", partition_by="part")
        assert len(spark.read.parquet(path).inputFiles()) < 16

    def test_rejected(self, data):
        with pytest.raises(ValueError, match="path"):
            write_file(data, "")
        with pytest.raises(ValueError, match="avro"):
            write_file(data, "x", "avro")
        with pytest.raises(ValueError, match="row_tag"):
            write_file(data, "x", "xml")


class TestUpsertTable:
    def test_only_touched_partitions_are_rewritten(self, spark, rows, tmp_path):
        path = str(tmp_path / "table")
        schema = "id int, v string, day string, kind string"
        old = [(1, "a", "d1", "x"), (2, "b", "d1", "y"), (3, "c", "d2", "x"), (4, "d", "d3", "x")]
        keys = ["day", "kind"]
        write_file(spark.createDataFrame(old, schema), path, "parquet", partition_by=keys)
        before = {f: os.stat(f).st_mtime_ns for f in self.files(path)}
        changes = [(1, "A", "d1", "x"), (9, "new", "d2", "x"), (5, "e", "d9", "y")]
        upsert_table(spark.createDataFrame(changes, schema), path, ["id", *keys], keys)
        result = read_file(spark, path, "parquet", schema)
        assert rows(result.select("id", "v", "day", "kind")) == [
            (1, "A", "d1", "x"),
            (2, "b", "d1", "y"),
            (3, "c", "d2", "x"),
            (4, "d", "d3", "x"),
            (5, "e", "d9", "y"),
            (9, "new", "d2", "x"),
        ]
        kept = [f for f in self.files(path) if f in before]
        assert any("day=d3" in f for f in kept) and any("kind=y" in f and "d1" in f for f in kept)

    @staticmethod
    def files(path):
        return [
            os.path.join(folder, name)
            for folder, _, names in os.walk(path)
            for name in names
            if name.endswith(".parquet")
        ]

    def test_partitions_belong_to_the_key(self, spark):
        df = spark.createDataFrame([(1, "a")], "id int, day string")
        with pytest.raises(ValueError, match="part of the key"):
            upsert_table(df, "x", "id", "day")


class Recorder:
    """Stands in for a DataFrame whose JDBC writes are only recorded."""

    def __init__(self):
        self.calls = []
        self.columns = ["id", "v"]

    @property
    def write(self):
        return self

    def format(self, name):
        self.calls.append(("format", name))
        return self

    def mode(self, name):
        self.calls.append(("mode", name))
        return self

    def options(self, **options):
        self.calls.append(("options", options))
        return self

    def save(self):
        self.calls.append(("save",))


class TestDatabase:
    """Options and statements only: no database may be started here."""

    def test_append(self):
        df = Recorder()
        write_db(df, "jdbc:x", "t", num_partitions=4, properties={"user": "me"})
        assert df.calls == [
            ("format", "jdbc"),
            ("mode", "append"),
            (
                "options",
                {
                    "url": "jdbc:x",
                    "batchsize": "10000",
                    "user": "me",
                    "numPartitions": "4",
                    "dbtable": "t",
                },
            ),
            ("save",),
        ]

    @pytest.mark.parametrize(
        "arguments",
        [
            {"url": "", "table": "t"},
            {"url": "u", "table": ""},
            {"url": "u", "table": "t", "mode": "merge"},
            {"url": "u", "table": "t", "mode": "upsert"},
            {"url": "u", "table": "t", "mode": "upsert", "keys": "id"},
        ],
    )
    def test_rejected(self, spark, arguments):
        with pytest.raises(ValueError):
            write_db(spark.range(1), **arguments)

    @pytest.mark.parametrize("missing", ["source_url", "target_url", "query", "table"])
    def test_migrate_needs_both_ends(self, spark, missing):
        arguments = dict(source_url="a", target_url="b", query="SELECT 1", table="t")
        with pytest.raises(ValueError):
            migrate(spark, **{**arguments, missing: ""})

    @pytest.mark.parametrize("dialect", ["merge", "conflict"])
    def test_statement_updates_and_inserts(self, dialect):
        connection = duckdb.connect()
        connection.execute('CREATE TABLE t (id INT PRIMARY KEY, "a b" INT)')
        connection.execute('CREATE TABLE s (id INT, "a b" INT)')
        connection.execute("INSERT INTO t VALUES (1, 2), (5, 5)")
        connection.execute("INSERT INTO s VALUES (1, 9), (2, 3)")
        connection.execute(upsert_statement("t", "s", ["id"], ["id", "a b"], dialect))
        assert sorted(connection.execute("SELECT * FROM t").fetchall()) == [(1, 9), (2, 3), (5, 5)]

    def test_statement_of_keys_only(self):
        connection = duckdb.connect()
        connection.execute("CREATE TABLE t (id INT PRIMARY KEY)")
        connection.execute("CREATE TABLE s AS SELECT 1 AS id")
        for dialect in ("merge", "conflict", "merge"):
            connection.execute(upsert_statement("t", "s", ["id"], ["id"], dialect))
        assert connection.execute("SELECT * FROM t").fetchall() == [(1,)]

    def test_mysql_form(self):
        assert upsert_statement("t", "s", ["id"], ["id", "v"], "duplicate") == (
            "INSERT INTO t (`id`, `v`) SELECT `id`, `v` FROM s"
            " ON DUPLICATE KEY UPDATE `v` = VALUES(`v`)"
        )

    def test_unknown_dialect(self):
        with pytest.raises(ValueError):
            upsert_statement("t", "s", ["id"], ["id"], "oracle")


class TestRequests:
    @pytest.fixture
    def people(self, spark):
        return spark.createDataFrame([(1, "Ann"), (2, None)], "id int, name string")

    def test_default_body_keeps_nulls(self, people):
        requests = render_requests(people, "http://x", headers={"A": "b"}).orderBy("body").collect()
        assert [json.loads(r.body) for r in requests] == [
            {"id": 1, "name": "Ann"},
            {"id": 2, "name": None},
        ]
        assert requests[0].method == "POST" and requests[0].headers == {"A": "b"}

    def test_templates(self, people, rows):
        requests = render_requests(people, "http://x/{{id}}", "PUT", "<{{ name }}|{{ id }}>")
        assert rows(requests.select("url", "method", "body")) == [
            ("http://x/1", "PUT", "<Ann|1>"),
            ("http://x/2", "PUT", "<|2>"),
        ]

    def test_batches(self, spark):
        requests = render_requests(spark.range(0, 25, 1, 2), "http://x", batch_size=10)
        bodies = [json.loads(r.body) for r in requests.collect()]
        assert sorted(len(b) for b in bodies) == [2, 3, 10, 10]
        assert sorted(row["id"] for b in bodies for row in b) == list(range(25))

    def test_rejected(self, people):
        with pytest.raises(ValueError, match="url"):
            render_requests(people, "")
        with pytest.raises(ValueError, match="zzz"):
            render_requests(people, "http://x", body_template="{{ zzz }}")
        with pytest.raises(ValueError, match="per row"):
            render_requests(people, "http://x/{{id}}", batch_size=2)
        with pytest.raises(ValueError, match="batch_size"):
            render_requests(people, "http://x", batch_size=0)

    def test_delivery(self, people, tmp_path):
        folder = str(tmp_path)

        def transport(request):
            name = urllib.parse.quote(request["url"], safe="")
            with open(os.path.join(folder, name), "w") as target:
                target.write(request["body"])

        deliver(render_requests(people, "http://x/{{id}}"), transport)
        assert len(os.listdir(folder)) == 2

    def test_failed_delivery_fails_the_job(self, people):
        def transport(request):
            raise OSError("refused")

        with pytest.raises(Exception, match="refused"):
            deliver(render_requests(people, "http://x"), transport)


class TestCustomSink:
    def test_all_rows_in_bounded_batches(self, spark, tmp_path):
        folder = str(tmp_path)

        def store(rows):
            assert len(rows) <= 2048
            with open(os.path.join(folder, f"{rows[0]['id']}"), "w") as target:
                json.dump(rows, target)

        df = spark.range(0, 10_000, 1, 3)
        assert custom_sink(df, store) is df
        seen = []
        for name in os.listdir(folder):
            with open(os.path.join(folder, name)) as source:
                seen += [row["id"] for row in json.load(source)]
        assert sorted(seen) == list(range(10_000))

    def test_empty_input(self, spark):
        def store(rows):
            raise AssertionError("called without rows")

        custom_sink(spark.range(0), store)


class TestShared:
    def test_configured_folder_is_used(self, spark):
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            assert shared_dir(spark) == configured.rstrip("/")
        assert new_path(spark, "x") != new_path(spark, "x")

    def test_materialize(self, spark, data, rows):
        copy = materialize(data)
        assert rows(copy) == rows(data)
        assert "FileScan parquet" in copy._jdf.queryExecution().toString()
