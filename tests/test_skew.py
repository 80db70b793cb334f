"""Inputs in which one key holds a large share of the rows."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from rowloom import deduplicate, join, quality_report, task_groups, upsert, write_file


@contextmanager
def settings(spark, **values):
    names = {"spark.sql." + name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def small_splits(spark):
    return settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        shuffle__partitions="8",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="60KB",
    )


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def hot(spark, rows, name):
    """A third of the rows has key 7, the others are spread."""
    return spark.range(0, rows, 1, 8).selectExpr(
        f"if(id % 3 = 0, 7, id + 100) AS {name}", f"hex(hash(id)) || hex(hash(-id)) AS t_{name}"
    )


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("side", ["left", "right"])
@pytest.mark.parametrize("matched", [True, False])
def test_hot_key_is_split_on_either_side(spark, how, side, matched):
    big = hot(spark, 60_000, "k" if side == "left" else "j")
    start = 5 if matched else 50
    other = spark.range(0, 60_000, 1, 8).selectExpr(
        f"id + {start} AS {'j' if side == 'left' else 'k'}", "id AS v"
    )
    left, right = (big, other) if side == "left" else (other, big)
    with small_splits(spark):
        result = join(left, right, "k=j", how, split_skew=True)
        joins = [line for line in executed(result).splitlines() if "SortMergeJoin" in line]
        count = result.count()

    keys = [7 if i % 3 == 0 else i + 100 for i in range(60_000)]
    pairs = sum(start <= key < 60_000 + start for key in keys)
    alone = {side: 60_000 - pairs}
    alone["right" if side == "left" else "left"] = 60_000 - len(
        {key for key in keys if start <= key < 60_000 + start}
    )
    kept = {"inner": [], "left": ["left"], "right": ["right"], "full": ["left", "right"]}[how]
    assert count == pairs + sum(alone[name] for name in kept)

    inner = [line for line in joins if "Inner" in line]
    assert any("skew=true" in line for line in inner)
    if side in kept:
        anti = [line for line in joins if "LeftAnti" in line]
        assert any("skew=true" in line for line in anti)


def test_null_keys_of_a_split_outer_join(spark):
    left = spark.range(0, 30_000, 1, 4).selectExpr("if(id % 3 = 0, NULL, id) AS k", "id AS v")
    right = spark.range(0, 1000, 1, 4).selectExpr("id AS j")
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        result = join(left, right, "k=j", "full", split_skew=True)
        counts = result.agg(F.count("*"), F.count("k"), F.count("j")).first()
    matched = sum(1 for i in range(1000) if i % 3)
    assert tuple(counts) == (30_000 + 1000 - matched, 20_000, 1000)


def test_grouped_operators_condense_before_the_shuffle(spark):
    df = hot(spark, 30_000, "k")
    for result in (
        deduplicate(df, "k"),
        deduplicate(df, "k", order_by="t_k"),
        deduplicate(df, "k", order_by=F.col("t_k").desc()),
        quality_report(df, ["unique(k)"]),
    ):
        plan = result._jdf.queryExecution().executedPlan().toString()
        shuffle = plan.index("Exchange hashpartitioning")
        assert "artial" in plan[shuffle:]


def test_upsert_into_a_hot_target(spark):
    target = hot(spark, 60_000, "k").withColumnRenamed("t_k", "t")
    source = spark.range(0, 40_000, 1, 8).selectExpr("id + 50000 AS k", "'new' AS t")
    with small_splits(spark):
        result = upsert(target, source, "k")
        plan = executed(result)
        assert "skew=true" in plan
        total, new = result.agg(F.count("*"), F.count_if(F.col("t") == "new")).first()
    replaced = sum(1 for i in range(60_000) if i % 3 and 50_000 <= i + 100 < 90_000)
    assert (total, new) == (60_000 - replaced + 40_000, 40_000)


def test_hot_folder_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "out")
    df = hot(spark, 60_000, "k").selectExpr("if(k = 7, 'hot', 'cold') AS part", "k", "t_k")
    with settings(spark, adaptive__advisoryPartitionSizeInBytes="200KB"):
        write_file(df, path, "parquet", partition_by="part")
    files = spark.read.parquet(path).inputFiles()
    assert sum("part=cold" in name for name in files) > 1
    assert spark.read.parquet(path).count() == 60_000


def test_merge_frames_do_not_grow_with_tasks(spark):
    """The largest number of pieces that one merge got, with 16 and with 64 input tasks."""

    def condense(frame):
        return frame.groupby("k", as_index=False).agg(pieces=("v", "size"), most=("v", "size")).assign(pieces=1, most=1)

    def merge(frame):
        return frame.groupby("k", as_index=False).agg(pieces=("pieces", "sum"), most=("most", "max"), rows=("k", "size")).assign(
            most=lambda f: f[["most", "rows"]].max(axis=1)
        )[["k", "pieces", "most"]]

    largest = []
    for tasks in (64, 256):
        df = spark.range(0, 4096, 1, tasks).selectExpr("7 AS k", "id AS v")
        (row,) = task_groups(df, "k", condense, merge, "k int, pieces long, most long").collect()
        assert row.pieces == tasks
        largest.append(row.most)
    assert largest == [16, 16]
