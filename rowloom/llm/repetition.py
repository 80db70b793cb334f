"""Quality rules on repetition inside a document, from suffix arrays.

The words of a slice of documents become one array of numbers, and the
suffixes of all its documents are sorted at once by doubling the compared
length; suffixes that are already alone in their group drop out.  The longest
common prefixes of neighbours in that order come from the stored rounds.  An
interval of neighbours that share at least k words is a repeated substring;
each suffix lies in nested intervals, and the deepest one gives the longest
repeat that begins there.  The union of these spans is what repeats cover.

Defined cases.  A NULL text counts as empty: no words, ``base_failed``.  Words
are what lies between the blanks 0x20 and 0x09-0x0D, compared byte by byte, so
invalid UTF-8 does no harm.  Ties and repeated rows are judged alike, each row
by itself.  A text of any length is judged whole; memory grows with the words
of a slice (see ``SLICE_WORDS``) or of the one longest text.  Other columns
are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from rowloom.llm.common import free_names, raw_text

#: Documents are sorted together until their words exceed this number.
SLICE_WORDS = 60_000
SYMBOLS = b"#*$%&|<>"
#: Blanks and the bytes that continue a code point.
NOT_COUNTED = b"\x20\x09\x0a\x0b\x0c\x0d" + bytes(range(0x80, 0xC0))
FIELDS = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "covered_words": pa.int64(),
    "longest_repeat": pa.int64(),
    "spans": pa.list_(pa.list_(pa.int64())),
}


def longest_repeats(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position the length of the longest substring from there that recurs in its document.

    ``ends`` holds for each position the end of its document.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    places = np.arange(n)
    order = np.lexsort((words, ends))
    first = np.ones(n, bool)
    first[1:] = (words[order][1:] != words[order][:-1]) | (ends[order][1:] != ends[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, places, 0))
    rounds, length = [], 1
    active = order[~(first & np.append(first[1:], True))]
    while len(active):
        rounds.append(rank.astype(np.int32))
        after = active + length
        tail = np.where(after < ends[active], rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + tail
        by_key = np.argsort(key, kind="stable")
        active, key = active[by_key], key[by_key]
        old = rank[active]
        at = np.arange(len(active))
        opens = np.append(True, key[1:] != key[:-1])
        group = np.append(True, old[1:] != old[:-1])
        rank[active] = old + np.maximum.accumulate(np.where(opens, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        active = active[~(opens & np.append(opens[1:], True))]
        length *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = places
    left, right = suffixes[:-1], suffixes[1:]
    same = ends[left] == ends[right]
    common = np.zeros(n - 1, np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        a, b = left + common, right + common
        inside = same & (np.maximum(a, b) < ends[left])
        equal = inside & (rounds[k][np.minimum(a, n - 1)] == rounds[k][np.minimum(b, n - 1)])
        common += equal.astype(np.int64) << k
    deepest = np.zeros(n, np.int64)
    deepest[suffixes] = np.maximum(np.append(0, common), np.append(common, 0))
    return deepest


def covered(deepest: np.ndarray, least: int, exact: int | None = None) -> np.ndarray:
    """Which words lie in the union of the repeats of at least ``least`` words.

    With ``exact`` each repeat counts with its first ``exact`` words only.
    """
    starts = np.flatnonzero(deepest >= least)
    n = len(deepest)
    stops = starts + (deepest[starts] if exact is None else exact)
    return np.cumsum(np.bincount(starts, minlength=n + 1) - np.bincount(stops, minlength=n + 1))[:n] > 0


def _slices(texts: list[bytes]) -> Iterator[tuple[list[bytes], list[list[bytes]]]]:
    held, split, total = [], [], 0
    for text in texts:
        words = text.split()
        held.append(text)
        split.append(words)
        total += len(words)
        if total >= SLICE_WORDS:
            yield held, split
            held, split, total = [], [], 0
    if held:
        yield held, split


def _spans(marks: np.ndarray) -> list[list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marks.view(np.int8), [0]))))
    return edges.reshape(-1, 2).tolist()


def measure(texts: list[bytes], min_repeat: int, want_spans: bool = True) -> dict[str, list]:
    """The columns ``FIELDS`` of some texts."""
    found: dict[str, list] = {name: [] for name in FIELDS}
    for held, split in _slices(texts):
        numbers: dict[bytes, int] = {}
        sizes = np.array([len(words) for words in split], np.int64)
        words = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in split for w in ws), np.int64, int(sizes.sum()))
        stops = np.cumsum(sizes)
        deepest = longest_repeats(words, np.repeat(stops, sizes))
        wide, narrow = covered(deepest, min_repeat), covered(deepest, 3, 3)
        for text, size, stop in zip(held, sizes.tolist(), stops.tolist(), strict=True):
            own = slice(stop - size, stop)
            lines = [line for line in text.split(b"\n") if line.strip()]
            found["n_words"].append(size)
            found["word_chars"].append(len(text.translate(None, NOT_COUNTED)))
            found["n_symbols"].append(len(text) - len(text.translate(None, SYMBOLS)))
            found["n_dup_lines"].append(len(lines) - len(set(lines)))
            found["n_repeat_words"].append(int(narrow[own].sum()))
            found["covered_words"].append(int(wide[own].sum()))
            found["longest_repeat"].append(int(deepest[own].max(initial=0)))
            found["spans"].append(_spans(wide[own]) if want_spans else [])
    return found


def repetition(text_col: str, min_repeat: int = 8, spans: bool = True) -> Column:
    """A struct with the measures of a text; ``spans`` are [start, stop) in words, merged and in order."""

    def run(batch: pa.Array) -> pa.Array:
        found = measure(batch.to_pylist(), min_repeat, spans)
        return pa.StructArray.from_arrays([pa.array(found[k], t) for k, t in FIELDS.items()], names=list(FIELDS))

    kinds = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    kinds += ", covered_words long, longest_repeat long, spans array<array<long>>"
    return arrow_udf(run, kinds)(raw_text(text_col))


def verdict(
    measures: Column, min_words: int = 50, max_repeat_share: float = 0.5, max_covered: float = 0.45, max_longest: int = 50
) -> tuple[Column, Column]:
    """``base_failed`` and ``kept`` from the measures.

    The base fails a text of fewer than ``min_words`` words or with more than
    ``max_repeat_share`` of its words in repeated windows of three.  The suffix
    array fails it when repeats of the measured length cover more than
    ``max_covered`` of its words or one is longer than ``max_longest`` words.
    """
    size = measures["n_words"]
    base = (size < min_words) | (measures["n_repeat_words"] > size * F.lit(max_repeat_share))
    odd = (measures["covered_words"] > size * F.lit(max_covered)) | (measures["longest_repeat"] > max_longest)
    return base, ~base & ~odd


def judge_repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_repeat: int = 8, **limits) -> DataFrame:
    """doc_id, all measures, base_failed and kept, one row per document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), repetition(text_col, min_repeat).alias("m"))
    base, kept = verdict(F.col("m"), **limits)
    return rows.select("doc_id", "m.*", base.alias("base_failed"), kept.alias("kept"))


def drop_repetitive(docs: DataFrame, text_col: str = "text", min_repeat: int = 8, **limits) -> DataFrame:
    """The documents that are kept, with all their columns."""
    (name,) = free_names(docs, "measures_")
    rows = docs.withColumn(name, repetition(text_col, min_repeat, spans=False))
    return rows.where(verdict(F.col(name), **limits)[1]).drop(name)
