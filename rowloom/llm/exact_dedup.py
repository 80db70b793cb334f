"""Exact deduplication in three skew-safe steps, on DataFrame functions only.

Equal texts meet first inside their task, then within their digest and salt,
and at last the winners of the salts meet.  Every step groups by the whole
text beside its digest, so a collision of digests never joins two texts.  The
decisions return to the documents through rows without text, again by digest
and salt: a text that a third of all rows share is spread over SALTS tasks.

Defined cases.  NULL texts are empty texts, and all of them are one group.  A
NULL id ranks below every other id.  Rows that repeat id and text are one
group and only one of them is kept (which one is open when their other columns
differ).  Empty tables give empty results.  Other columns are never touched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import each_salt, free_names, salt_of, salts_seen, whole_text
from rowloom.session import materialize


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def text_groups(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per different text: digest, text, keep_id, group_size and the mask of its salts."""
    text = whole_text(text_col)
    keyed = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"), digest(text).alias("digest"), salt_of(F.col(id_col)).alias("salt")
    )
    merged = keyed.groupBy("digest", "salt", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    return merged.groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"), salts_seen().alias("salts")
    )


def _joined(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column], want: list[str]) -> DataFrame:
    """``docs`` with the columns ``want`` (digest, salt, keep_id, group_size), found by value."""
    d, s, k, n = want
    groups = text_groups(docs, id_col, text_col, digest)
    light = materialize(groups.select("digest", "keep_id", "group_size", "salts"), "text-groups")
    shared = light.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest")
    rows = docs.withColumns({d: digest(whole_text(text_col)), s: salt_of(F.col(id_col))})
    named = {"digest": d, "keep_id": k, "group_size": n}
    spread = light.select("digest", "keep_id", "group_size", each_salt("salts").alias(s)).withColumnsRenamed(named)
    if shared.isEmpty():
        return rows.join(spread, [d, s])
    # Different texts behind one digest: those rows alone are compared by text once more.
    clash = materialize(shared, "clashing-digests").withColumnRenamed("digest", d)
    whole = groups.join(clash.withColumnRenamed(d, "digest"), "digest", "left_semi")
    whole = whole.select(F.col("digest").alias(d), F.col("text").alias("_whole"), F.col("keep_id").alias(k), F.col("group_size").alias(n), each_salt("salts").alias(s))
    odd = rows.join(clash, d, "left_semi").alias("a").join(
        whole.alias("b"),
        (F.col(f"a.`{d}`") == F.col(f"b.`{d}`"))
        & (F.col(f"a.`{s}`") == F.col(f"b.`{s}`"))
        & (F.coalesce(F.col(f"a.`{text_col}`"), F.lit("")) == F.col("b._whole")),
    ).select("a.*", F.col(f"b.`{k}`"), F.col(f"b.`{n}`"))
    plain = rows.join(clash, d, "left_anti").join(spread, [d, s])
    columns = [*docs.columns, d, s, k, n]
    return plain.select(*(F.col(f"`{c}`") for c in columns)).unionByName(odd.select(*(F.col(f"`{c}`") for c in columns)))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept and digest.

    Of equal texts the row with the largest id stays.  The whole text is
    shuffled once per merging step, copies having met in their task before.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = _joined(slim, "doc_id", "text", digest, ["digest", "salt", "keep_id", "group_size"])
    again = Window.partitionBy("digest", "salt", "keep_id", "doc_id").orderBy("group_size")
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.row_number().over(again) == 1)).alias("kept"),
        "digest",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The documents of which ``mark_copies`` says ``kept``, with all their columns."""
    d, s, k, n, r = free_names(docs, "digest_", "salt_", "keep_id_", "group_size_", "repeat_")
    rows = _joined(docs, id_col, text_col, digest, [d, s, k, n])
    winners = rows.where(F.col(f"`{id_col}`").eqNullSafe(F.col(k)))
    again = Window.partitionBy(d, s, k).orderBy(n)
    return winners.withColumn(r, F.row_number().over(again)).where(F.col(r) == 1).select(*(F.col(f"`{c}`") for c in docs.columns))
