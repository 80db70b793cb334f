"""Drop lines that other documents have too.

The documents are exploded into normalised lines; a line is known by two
64-bit hashes of its key, so two keys meet by chance with a probability near
pairs / 2**128.  Tasks combine what they have of a hash before it is shuffled,
and the lines come back to the hashes by a salt, which spreads a line that
every document has.  The positions to drop return to the documents, which are cut between them and joined again
in the order of the lines; texts are shuffled once, lines never.

Defined cases.  A NULL or empty text has one empty line.  A NULL id is a
document of its own that ranks behind all others.  Rows that repeat an id are
one document when it comes to counting, and each row is reassembled by its own
text.  Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import BLANKS, ascii_lower, each_salt, salt_of, salts_seen, whole_text
from rowloom.session import materialize


def line_key(line: Column) -> Column:
    """A line as it is compared: blanks stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def line_hashes(docs: DataFrame, min_length: int) -> DataFrame:
    """doc_id, row_key, position and the two hashes of every line that is long enough."""
    lines = docs.select("doc_id", "row_key", F.posexplode(F.split("text", "\n", -1)).alias("position", "line"))
    keys = lines.select("doc_id", "row_key", "position", line_key(F.col("line")).alias("key"))
    return keys.where(F.char_length("key") >= min_length).select(
        "doc_id", "row_key", "position", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), salt_of(F.col("doc_id")).alias("salt")
    )


def shared_lines(lines: DataFrame) -> DataFrame:
    """The lines of at least two documents: h1, h2, salt and keeper, the smallest id that has it."""
    facts = [F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("doc_id").alias("ids"), F.count(F.lit(1)).alias("n")]
    whole = lines.groupBy("h1", "h2").agg(*facts, salts_seen().alias("salts"))
    several = (F.col("low") < F.col("high")) | ((F.col("ids") > 0) & (F.col("ids") < F.col("n")))
    return whole.where(several).select("h1", "h2", F.col("low").alias("keeper"), each_salt("salts").alias("salt"))


def drop_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 10) -> DataFrame:
    """Return doc_id, text (what is left), n_lines and n_dropped, one row per document.

    A line key of at least ``min_length`` code points that two or more
    documents hold loses all its lines but those of the smallest id.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("row_key", F.xxhash64("text"))
    lines = materialize(line_hashes(rows, min_length), "line-hashes")
    found = lines.join(shared_lines(lines), ["h1", "h2", "salt"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    drops = found.groupBy(F.col("doc_id").alias("id"), F.col("row_key").alias("key")).agg(
        F.sort_array(F.collect_set("position")).alias("drops")
    )
    joined = rows.join(drops, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row_key") == F.col("key")), "left")
    parts = joined.select("doc_id", "text", "drops", F.split("text", "\n", -1).alias("lines"))
    bounds = F.concat(F.array(F.lit(-1)), F.col("drops"), F.array(F.size("lines")))
    parts = parts.withColumn("bounds", bounds)
    pieces = F.transform(
        F.sequence(F.lit(1), F.size("bounds") - 1),
        lambda i: F.slice("lines", F.element_at("bounds", i) + 2, F.element_at("bounds", i + 1) - F.element_at("bounds", i) - 1),
    )
    left = F.when(F.col("drops").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(pieces), "\n"))
    return parts.select(
        "doc_id",
        left.alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
    )
