import json
import os
import random
from datetime import date, timedelta

import pytest

from rowloom import (
    batch_reports,
    checked_batches,
    ingest_new_files,
    map_rows,
    missing_run_dates,
    quality_report,
    snapshot,
    sql_models,
    transform,
)
from rowloom.plans import jobs
from rowloom.errors import ValidationError


class TestMissingDates:
    @pytest.fixture
    def target(self, spark):
        return spark.createDataFrame([("2024-01-01",), ("2024-01-03",), ("2024-01-03",), (None,)], "d string")

    def test_between(self, target, rows):
        result = missing_run_dates(target, "d", "2023-12-31", date(2024, 1, 4))
        assert rows(result) == [(date(2023, 12, 31),), (date(2024, 1, 2),), (date(2024, 1, 4),)]

    def test_bounds_from_the_data(self, target, rows):
        assert rows(missing_run_dates(target, "d")) == [(date(2024, 1, 2),)]

    def test_empty(self, target):
        assert missing_run_dates(target.limit(0), "d").count() == 0
        assert missing_run_dates(target, "d", "2024-02-01", "2024-01-01").count() == 0
        assert missing_run_dates(target.limit(0), "d", "2024-01-01", "2024-01-02").count() == 2


class TestSnapshot:
    def test_close_and_open(self, spark, rows):
        history = spark.sql(
            "SELECT * FROM VALUES (1, 'a', date '2024-01-01', CAST(NULL AS date)), "
            "(2, 'b', date '2024-01-01', NULL), (3, 'c', date '2024-01-01', NULL), "
            "(1, 'z', date '2023-01-01', date '2024-01-01') AS t(k, v, valid_from, valid_to)"
        )
        source = spark.createDataFrame([(1, "a"), (2, None), (4, "d")], "k int, v string")
        first, second = date(2024, 1, 1), date(2024, 2, 1)
        assert rows(snapshot(history, source, "k", "2024-02-01")) == sorted(
            [
                (1, "z", date(2023, 1, 1), first),
                (1, "a", first, None),
                (2, "b", first, second),
                (2, None, second, None),
                (3, "c", first, None),
                (4, "d", second, None),
            ],
            key=repr,
        )

    def test_repeat_changes_nothing(self, spark, rows):
        history = spark.sql(
            "SELECT 1 AS k, 'a' AS v, date '2024-01-01' AS valid_from, CAST(NULL AS date) AS valid_to"
        )
        source = spark.createDataFrame([(1, "b"), (None, "n")], "k int, v string")
        once = snapshot(history, source, "k", "2024-02-01")
        twice = snapshot(once, source, "k", "2024-03-01")
        assert rows(twice) == rows(once)

    def test_against_python(self, spark, rows):
        rng = random.Random(9)
        day = date(2024, 1, 1)
        open_rows, closed = {}, []
        df = spark.createDataFrame([], "k int, v int, valid_from date, valid_to date")
        for step in range(3):
            moment = day + timedelta(days=step)
            source = {rng.randrange(12): rng.randrange(3) for _ in range(8)}
            for k, v in source.items():
                if k in open_rows and open_rows[k][0] != v:
                    closed.append((k, *open_rows.pop(k), moment))
                open_rows.setdefault(k, (v, moment))
            frame = spark.createDataFrame(list(source.items()), "k int, v int")
            df = snapshot(df, frame, "k", moment)
        expected = closed + [(k, *value, None) for k, value in open_rows.items()]
        assert rows(df) == sorted(expected, key=repr)

    def test_history_columns(self, spark):
        df = spark.createDataFrame([(1, "a")], "k int, v string")
        with pytest.raises(ValueError, match="valid_from"):
            snapshot(df, df, "k", "2024-01-01")


class TestModels:
    MODELS = {
        "clean": "SELECT k, v FROM {raw} WHERE v IS NOT NULL",
        "totals": "SELECT k, sum(v) AS total FROM {clean} GROUP BY k",
        "top": "SELECT * FROM {totals} WHERE total > {{ param.least }}",
    }

    @pytest.fixture
    def raw(self, spark):
        return spark.createDataFrame([(1, 5), (1, 6), (2, 1), (3, None)], "k int, v int")

    @pytest.mark.parametrize("tables", [(), ("clean",)])
    def test_chain(self, spark, raw, rows, tables):
        models = sql_models(spark, self.MODELS, {"raw": raw}, tables=tables, values={"param.least": 2})
        assert list(models) == ["clean", "totals", "top"]
        assert rows(models["top"]) == [(1, 11)]
        report = quality_report(models["totals"], ["unique(k)", "row_count(min=2)"])
        assert report.filter("passed").count() == 2

    def test_select(self, spark, raw):
        values = {"param.least": 1}
        models = sql_models(spark, self.MODELS, {"raw": raw}, select=["top"], values=values)
        assert list(models) == ["top"]

    def test_rejected(self, spark, raw):
        with pytest.raises(ValueError):
            sql_models(spark, {}, {"raw": raw})
        with pytest.raises(ValueError, match="nope"):
            sql_models(spark, {"a": "SELECT 1"}, {}, select=["nope"])
        with pytest.raises(ValueError, match="twice"):
            sql_models(spark, {"raw": "SELECT 1"}, {"raw": raw})


class TestIngest:
    SCHEMA = "id int, v string"

    @staticmethod
    def drop(folder, name, count, start=0):
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, name), "w") as target:
            target.write("id,v\n" + "".join(f"{start + i},x{i}\n" for i in range(count)))

    def test_only_new_files(self, spark, tmp_path):
        incoming, table, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
        totals = []
        self.drop(incoming, "a.csv", 5)
        for run in range(3):
            if run == 2:
                self.drop(incoming, "b.csv", 7, 100)
            ingest_new_files(spark, incoming, self.SCHEMA, table, mark)
            totals.append(spark.read.parquet(table).count())
        assert totals == [5, 5, 12]

    def test_row_wise_operators_and_batch_sink(self, spark, tmp_path):
        incoming, mark = str(tmp_path / "in"), str(tmp_path / "mark")
        for number in range(3):
            self.drop(incoming, f"{number}.csv", 4, number * 10)
        seen = []

        def sink(batch, batch_id):
            report = quality_report(batch, ["unique(id)"]).first()
            seen.append((batch_id, batch.count(), report.passed, batch.columns))

        def clean(stream):
            stream = transform(stream, ["FILTER id > 0", {"type": "rename", "from": "v", "to": "w"}])
            return map_rows(stream, lambda row: {"id": row["id"], "n": len(row["w"])}, "id int, n int")

        ingest_new_files(
            spark, incoming, self.SCHEMA, sink, mark, transform=clean, max_files=2
        )
        assert [count for _, count, _, _ in seen] == [7, 4] or sum(c for _, c, _, _ in seen) == 11
        assert len(seen) == 2
        assert all(passed and columns == ["id", "n"] for _, _, passed, columns in seen)

    def test_nothing_there(self, spark, tmp_path):
        incoming = tmp_path / "in"
        incoming.mkdir()
        calls = []
        ingest_new_files(
            spark, str(incoming), self.SCHEMA, lambda df, n: calls.append(n), str(tmp_path / "m")
        )
        assert calls == []

    def test_rejected(self, spark):
        with pytest.raises(ValueError):
            ingest_new_files(spark, "", self.SCHEMA, "x", "y")
        with pytest.raises(ValueError):
            ingest_new_files(spark, "x", self.SCHEMA, "x", "")


class TestJobs:
    def test_lead_cleanup(self, spark, rows):
        data = [
            ("\t A@X.ORG \n", "o'neil anne-marie", "555-12 34"),
            ("no at sign.org", "b", "1"),
            ("", "c", ""),
            (None, None, None),
            ("a@b@c.de", " d ", "-"),
            ("a.b@nodot", "e", "2"),
        ]
        leads = spark.createDataFrame(data, jobs.LEAD_SCHEMA)
        assert rows(jobs.clean_leads(leads)) == [
            ("a@b@c.de", "D", ""),
            ("a@x.org", "O'neil Anne-marie", "5551234"),
        ]

    def test_too_few_leads_go_to_quarantine(self, spark, tmp_path, caplog):
        incoming = tmp_path / "in"
        incoming.mkdir()
        (incoming / "a.csv").write_text("email,name,phone\na@b.c,a,1\n")
        paths = [str(tmp_path / name) for name in ("table", "mark")]
        assert jobs.ingest_leads(spark, str(incoming), *paths, lambda rows: None).collect() == []
        assert spark.read.parquet(paths[0] + "-quarantine").count() == 1
        assert "got 1 leads" in caplog.text

    def test_leads_arrive_in_batches(self, spark, tmp_path):
        incoming, outbox = tmp_path / "in", tmp_path / "outbox"
        for folder in (incoming, outbox):
            folder.mkdir()
        target = str(outbox)

        def push(rows):
            for row in rows:
                with open(os.path.join(target, row["email"]), "w") as out:
                    json.dump(row, out)

        def run():
            paths = [str(tmp_path / name) for name in ("table", "mark")]
            return jobs.ingest_leads(spark, str(incoming), *paths, push, minimum=2)

        assert run().count() == 0
        (incoming / "a.csv").write_text("email,name,phone\na@b.c,a,1\nB@b.c,b,2\nbad,c,3\n")
        assert run().count() == 2 and run().count() == 2
        (incoming / "b.csv").write_text("email,name,phone\nx@b.c,x,1\ny@b.c,y,2\n")
        assert sorted(row.batch for row in run().collect()) == [0, 0, 1, 1]
        assert sorted(os.listdir(target)) == ["a@b.c", "b@b.c", "x@b.c", "y@b.c"]

    def test_customer_360(self, spark, rows):
        customers = spark.createDataFrame(
            [(1, "a", "S"), (2, "b", "S"), (3, "c", "T")],
            "c_custkey bigint, c_name string, c_mktsegment string",
        )
        orders = spark.createDataFrame(
            [(1, 100.0), (1, 300.5), (2, 3_000_000.0)], "o_custkey bigint, o_totalprice double"
        )
        for reuse in (None, "table"):
            assert rows(jobs.customer_360(customers, orders, reuse=reuse, silver=250)) == [
                (1, "a", "S", 400.5, 2, 260.3, "silver"),
                (2, "b", "S", 3_000_000.0, 1, 1_800_010.0, "gold"),
                (3, "c", "T", 0.0, 0, 0.0, "bronze"),
            ]

    def test_empty_events_are_refused(self, spark):
        events = spark.createDataFrame(
            [],
            "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
            "value double, props string",
        )
        with pytest.raises(ValidationError, match="received 0 events"):
            jobs.load_events(events, lambda df: None)


def test_unique_across_files_and_runs(spark, rows, tmp_path):
    """Repeats in one file, in the next file and in the next run go; a late row goes; NULL is a key."""
    incoming, table, checkpoint = (str(tmp_path / name) for name in ("in", "out", "state"))
    schema = "id long, at timestamp, v string"

    def run(*data):
        for k, (ident, hour, v) in enumerate(data):
            frame = spark.createDataFrame([(ident, f"2024-05-{1 + hour // 24:02d} {hour % 24:02d}:00:00", v)], "id long, at string, v string")
            frame.selectExpr("id", "CAST(at AS TIMESTAMP) AS at", "v").coalesce(1).write.mode("append").parquet(incoming)
        ingest_new_files(spark, incoming, schema, table, checkpoint, format="parquet", watermark=("at", "10 hours"), unique="id")
        return sorted(r.v for r in spark.read.parquet(table).collect())

    assert run((1, 50, "a"), (2, 55, "b"), (None, 55, "n")) == ["a", "b", "n"]
    assert run((1, 50, "again"), (2, 56, "again"), (None, 56, "again"), (3, 56, "c")) == ["a", "b", "c", "n"]
    assert run((4, 100, "d")) == ["a", "b", "c", "d", "n"]
    assert run((5, 60, "late"), (4, 100, "again"), (6, 95, "e")) == ["a", "b", "c", "d", "e", "n"]
    assert run() == ["a", "b", "c", "d", "e", "n"]
    with pytest.raises(ValueError, match="watermark"):
        ingest_new_files(spark, incoming, schema, table, checkpoint, format="parquet", unique="id")


def test_checked_batches(spark, rows, tmp_path):
    """Two files, the second breaks a rule; a repeated batch goes where it went."""
    incoming, table, state, history = (str(tmp_path / name) for name in ("in", "out", "state", "history"))
    sink = checked_batches(table, ["not_null(v)", "unique(id)"], history)
    schema = "id int, v int"
    assert batch_reports(spark, history).count() == 0
    for data in ([(1, 1), (2, 2)], [(3, None), (3, 4)], [(5, 5)]):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(incoming)
        ingest_new_files(spark, incoming, schema, sink, state, format="parquet")
    told = batch_reports(spark, history).select("batch", "rule", "total_rows", "failed_rows", "passed")
    assert rows(told) == sorted(
        [(b, r, n, f, f == 0) for b, n, *failed in [(0, 2, 0, 0), (1, 2, 1, 1), (2, 1, 0, 0)] for r, f in zip(("not_null", "unique"), failed, strict=True)],
        key=repr,
    )
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == [1, 2, 5]
    assert sorted(r.id for r in spark.read.parquet(f"{table}-quarantine").collect()) == [3, 3]
    # Batch 1 again, now with rows that would pass: history decides, and nothing is stored twice.
    sink(spark.createDataFrame([(3, 3), (4, 4)], schema), 1)
    assert spark.read.parquet(table).count() == 3 and spark.read.parquet(f"{table}-quarantine").count() == 2
    with pytest.raises(Exception, match="rule"):
        checked_batches(table, ["no such rule(v)"], history)
