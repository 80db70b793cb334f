"""Keyed joins, fan-in and fan-out."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.columns import (
    any_null,
    column,
    free_name,
    require,
    require_columns,
    require_unique_names,
)
from rowloom.session import materialize, release

JOIN_TYPES = ("inner", "left", "right", "full")


def parse_join_keys(on: str | Sequence[str]) -> list[tuple[str, str]]:
    """Read join keys: ``"k"``, ``"a=b"`` (split at the first ``=``) or a list of them."""
    pairs = []
    for text in [on] if isinstance(on, str) else list(on or []):
        left, found, right = text.partition("=")
        pair = (left.strip(), right.strip() if found else left.strip())
        if not all(pair):
            raise ValueError(f"join: empty key in {text!r}")
        pairs.append(pair)
    require(pairs, "join: needs a key")
    return pairs


def join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    *,
    left_unique: bool = False,
    right_unique: bool = False,
    split_skew: bool = False,
) -> DataFrame:
    """Equi-join on one key, or on a list of keys.

    ``on="k"`` gives a single key column, taken from whichever side has it;
    ``on="a=b"`` keeps both.  A NULL key never matches.  Other right columns
    whose name is taken get the suffix ``_right``.  ``how`` is inner, left,
    right or full.

    Each side is read once and Spark picks the join.  Skew: at run time Spark
    splits an oversized partition of an inner join on either side, of an outer
    join only on the preserved side, and of a full join on neither.  For a hot
    key on such a side say ``split_skew=True``: both inputs are then written
    once to the shared folder, which keeps several reads of them equal, and
    the join becomes the inner join plus the unmatched rows (an anti join
    against the other side's keys), which may be split everywhere.  With
    ``left_unique`` / ``right_unique``, said of a side that holds each key once
    (NULL aside), ``split_skew`` leaves joins plain that are safe because of
    it.  Streams always get Spark's own join.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"join: how must be one of {JOIN_TYPES}, not {how!r}")
    keys = parse_join_keys(on)
    require_columns(left, [name for name, _ in keys], "join (left)")
    require_columns(right, [name for _, name in keys], "join (right)")

    shared = {name for name, other in keys if name == other}
    kept_right = [name for name in right.columns if name not in shared]
    taken = {name.lower() for name in left.columns}
    outputs = {name: name + "_right" if name.lower() in taken else name for name in kept_right}
    require_unique_names([*left.columns, *outputs.values()], "join")

    # Fresh names on the right make self joins and collisions unambiguous.
    inside = {name: free_name(f"right_{index}", left) for index, name in enumerate(right.columns)}
    other = right.select(*[column(name).alias(inside[name]) for name in right.columns])
    matches = [column(a) == column(inside[b]) for a, b in keys]
    condition = reduce(lambda first, second: first & second, matches)

    def shape(frame: DataFrame, key_from: str) -> DataFrame:
        """Order and name the output; ``key_from`` names the sides that hold rows."""
        has_left, has_right = key_from != "right", key_from != "left"
        selected = []
        for field in left.schema:
            ours = column(field.name)
            if field.name in shared and key_from == "right":
                value = column(inside[field.name])
            elif field.name in shared and key_from == "either":
                value = F.coalesce(ours, column(inside[field.name]))
            else:
                value = ours if has_left else F.lit(None).cast(field.dataType)
            selected.append(value.alias(field.name))
        for name in kept_right:
            theirs = column(inside[name])
            value = theirs if has_right else F.lit(None).cast(right.schema[name].dataType)
            selected.append(value.alias(outputs[name]))
        return frame.select(*selected)

    plain = (
        not split_skew
        or how == "inner"
        or (how == "left" and right_unique)
        or (how == "right" and left_unique)
        or (how == "full" and left_unique and right_unique)
        or left.isStreaming
        or right.isStreaming
    )
    if plain:
        key_from = "both" if how in ("inner", "left") else "either"
        return shape(left.join(other, condition, how), key_from)

    left_names = [a for a, _ in keys]
    right_names = [inside[b] for _, b in keys]
    # Read several times, so both must hold the same rows each time.
    left, other = materialize(left, "left"), materialize(other, "right")
    parts = [shape(left.join(other, condition, "inner"), "both")]
    # Anti joins keep the rows whose key is NULL.
    if how in ("left", "full"):
        present = key_set(other, right_names)
        parts.append(shape(left.join(present, condition, "left_anti"), "left"))
    if how in ("right", "full"):
        present = key_set(left, left_names)
        parts.append(shape(other.join(present, condition, "left_anti"), "right"))
    return reduce(DataFrame.unionAll, parts)


def key_set(df: DataFrame, names: Sequence[str], spread: int = 32) -> DataFrame:
    """The keys of ``df`` as the right side of a semi or anti join.

    Each key is kept up to ``spread`` times, once per salt.  A plain
    ``distinct`` would leave the keys grouped as the join wants them, without
    a shuffle next to the join, and Spark splits an oversized partition of the
    other side only between two shuffles.
    """
    salt = free_name("salt", df)
    keyed = df.filter(~any_null(names)).select(*[column(name) for name in names])
    salted = keyed.withColumn(salt, F.pmod(F.spark_partition_id(), F.lit(spread)))
    return salted.distinct().drop(salt)


def fan_in(*frames: DataFrame) -> DataFrame:
    """Put the rows of several inputs under each other.

    A bag union by column name: duplicates stay, and a column that an input
    lacks is NULL there.  No shuffle.
    """
    require(frames, "fan_in: needs at least one input")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def fan_out(
    df: DataFrame,
    consumers: Sequence[Callable[[DataFrame], object]],
    *,
    reuse: str | None = "table",
) -> list:
    """Feed one input to several consumers and return their results.

    ``reuse="table"`` writes the input once to the shared folder while the
    consumers run; ``"persist"`` keeps it on the executors (memory, then disk),
    for inputs known to be small; ``None`` recomputes it.  The copy is removed
    at the end, so consumers must be actions such as writes.
    """
    require(consumers, "fan_out: needs at least one consumer")
    source = reusable(df, reuse)
    try:
        return [consumer(source) for consumer in consumers]
    finally:
        if reuse == "persist":
            source.unpersist()
        if reuse == "table":
            release(source)


def reusable(df: DataFrame, reuse: str | None) -> DataFrame:
    """Prepare ``df`` to be read more than once: ``persist``, ``table`` or ``None``."""
    if reuse is None:
        return df
    if reuse == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if reuse == "table":
        return materialize(df)
    raise ValueError(f"reuse must be 'persist', 'table' or None, not {reuse!r}")
