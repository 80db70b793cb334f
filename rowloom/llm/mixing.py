"""Mix sources to target weights by cutting hash-random orders at exact budgets.

Each document gets a random key from the digest of its id.  Equal ranges of
the keys cut every source into pieces of a few thousand documents; the words
are summed by piece, the sums are added up over the pieces of a source, and a
running sum inside each piece completes the prefix sum of every document.  The
part of the order below the source's budget is taken; a budget beyond the
source starts the order anew (an epoch).  No source meets in one task: pieces
follow the number of documents in theirs.  Rows of one id share a key, and so
do all rows without an id: those alike in size as well go through the pieces as
runs of up to ``piece`` rows, and become rows again after the runs have been
spread, so that a piece holds the different sizes of an id and not its rows.

Defined cases.  NULL texts have no words and give nothing.  A NULL source is a
source of its own, the last one.  Ties of the key are ordered by id and size,
and rows alike in all three are interchangeable.  Sources without words have a
target of 0.  An empty table gives an empty result.  Other columns are never
read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.common import free_names, whole_text, word_count
from rowloom.session import materialize

#: Keys are the first 15 hexadecimal digits of a digest.
KEY_BITS = 60


def random_key(ident: Column) -> Column:
    digest = F.md5(F.coalesce(ident.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row per source: source, source_size and target.

    Sources in the order of their code points share ``share`` times all words
    by the repeating ``weights``; none gets more than ``most`` times its size,
    and what is beyond goes to the others by weight.  Only the level of the
    shares, one number, is found on the driver.
    """
    spark = sized.sparkSession
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    ordered = sums.orderBy(F.col("source").asc_nulls_last())
    schema = T.StructType([*ordered.schema.fields, T.StructField("place", T.LongType())])
    placed = spark.createDataFrame(ordered.rdd.zipWithIndex().map(lambda x: (*x[0], x[1])), schema)
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    placed = placed.withColumn("weight", F.get(cycle, (F.col("place") % len(weights)).cast("int")))
    placed = materialize(placed, "sources")
    cap, weight = F.col("source_size") * F.lit(float(most)), F.col("weight")
    total, level = placed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share, 0.0
    while True:
        above = cap < weight * level
        held, free = placed.agg(F.sum(F.when(above, cap).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(weight))).first()
        found = (total - held) / free if free else level
        if found <= level:
            break
        level = found
    return placed.select("source", "source_size", "documents", F.least(cap, weight * level).alias("target"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    piece: int = 2_000,
) -> DataFrame:
    """Return doc_id, source, size, source_size, target and taken, one row per document.

    ``taken`` counts the words of the document in the mix, each epoch's anew;
    over a source they sum up to its target, rounded to a whole word.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(whole_text(text_col)).alias("size"),
        random_key(F.col(id_col)).alias("key"),
    )
    return _taken(materialize(sized, "sizes"), weights, share, most, piece)


def _taken(sized: DataFrame, weights: Sequence[float], share: float, most: float, piece: int) -> DataFrame:
    targets = materialize(source_targets(sized, weights, share, most), "targets")
    rows = targets.agg(F.coalesce(F.sum("documents"), F.lit(0))).first()[0]
    runs = _runs(sized, rows, piece)
    sums = runs.groupBy("source", "piece").agg(F.sum("words").alias("piece_size"))
    earlier = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("piece_size").over(earlier), F.lit(0)))
    starts = starts.select(F.col("source").alias("s"), F.col("piece").alias("p"), "start")
    budgets = targets.select(F.col("source").alias("t"), "source_size", "target")
    starts = starts.join(budgets, F.col("s").eqNullSafe(F.col("t")), "left").drop("t")
    inside = Window.partitionBy("source", "piece").orderBy("key", "doc_id", "size", "run").rowsBetween(Window.unboundedPreceding, -1)
    running = runs.withColumn("before", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    placed = running.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("piece") == F.col("p")))
    placed = placed.repartition("source", "key", "size", "run").withColumn("row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target + 0.5) div source_size")).otherwise(0)
    rest = budget - epochs * F.col("source_size") - F.col("start") - F.col("before") - F.col("row") * F.col("size")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def _runs(sized: DataFrame, rows: int, piece: int) -> DataFrame:
    """source, piece, key, doc_id, size, run, rows and words: up to ``piece`` rows alike each, of ``rows`` in all."""
    width = -(-(2**KEY_BITS) // max(1, -(-rows // piece)))
    alike = sized.groupBy("source", "key", "doc_id", "size").agg(F.count(F.lit(1)).alias("alike"))
    runs = alike.withColumn("run", F.explode(F.sequence(F.lit(0), F.expr(f"(alike - 1) div {piece}"))))
    runs = runs.withColumn("rows", F.least(F.lit(piece), F.col("alike") - F.col("run") * piece).cast("int"))
    return runs.select("source", F.expr(f"key div {width}L").alias("piece"), "key", "doc_id", "size", "run", "rows", (F.col("size") * F.col("rows")).alias("words"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """The mix as documents: one row, with all columns, for each epoch that takes from a document.

    The document at a budget's end is given whole.  Rows alike in id, source
    and size are given as often as the one among them that is taken most.
    """
    s, n, c = free_names(docs, "source_", "size_", "copies_")
    taken = mix_sources(docs, id_col, text_col, source_col, **settings).where("taken > 0")
    copies = taken.groupBy(F.col("doc_id").alias("i_"), F.col("source").alias("s_"), F.col("size").alias("n_")).agg(
        F.ceil(F.max(F.col("taken") / F.col("size"))).cast("int").alias("c_")
    )
    rows = docs.withColumns({s: F.col(source_col).cast("string"), n: word_count(whole_text(text_col))}).alias("d")
    same = [F.col(f"d.`{id_col}`").eqNullSafe(F.col("m.i_")), F.col(f"d.`{s}`").eqNullSafe(F.col("m.s_")), F.col(f"d.`{n}`") == F.col("m.n_")]
    chosen = rows.join(copies.alias("m"), same[0] & same[1] & same[2])
    columns = [F.col(f"d.`{x}`") for x in docs.columns]
    return chosen.select(*columns, F.explode(F.sequence(F.lit(1), F.col("m.c_"))).alias(c)).drop(c)
