"""Small pieces that several text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The characters that separate words and are stripped from lines.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
#: A word in the syntax of Java, RE2 and Python expressions.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Salts by which the rows of one key are spread; they fit the bits of a bigint.
SALTS = 60


def free_names(df: DataFrame, *stems: str) -> list[str]:
    """Names that no column of ``df`` has, whatever their case."""
    taken = {name.lower() for name in df.columns}
    found = []
    for stem in stems:
        name = stem
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found


def whole_text(name: str) -> Column:
    """The text column; a missing text counts as an empty one."""
    return F.coalesce(F.col(name), F.lit(""))


def raw_text(name: str) -> Column:
    """The bytes of a text for Python code, which splits and folds ASCII on bytes."""
    return whole_text(name).cast("binary")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; texts of ASCII take the faster built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def salt_of(*columns: Column) -> Column:
    """A salt from 0 to SALTS - 1 that depends on the row's values only."""
    return F.pmod(F.xxhash64(F.lit("salt"), *columns), F.lit(SALTS)).cast("int")


def salts_seen() -> Column:
    """Aggregate: the salts of a group as the bits of one number."""
    return F.bit_or(F.expr("shiftleft(1L, salt)"))


def each_salt(mask: str) -> Column:
    """One row for each salt in the mask that ``salts_seen`` made."""
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    return F.explode(F.filter(every, lambda s: F.getbit(F.col(mask), s) == 1))


def crc_mod(ident: Column, of: int) -> Column:
    """crc32 of an id written as text, modulo ``of``; NULL ids count as remainder -1."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % of, F.lit(-1))
