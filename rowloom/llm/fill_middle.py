"""Fill-in-middle training texts, cut at unit borders that a wavelet matrix finds.

The bytes of a slice of texts become classes: inside a word, last of a word,
end of a sentence, blank, newline, and bytes that continue a code point.  One
wavelet matrix over the classes answers how often a class stands before a
place.  A unit (line, word or sentence) ends with one of some classes, so its
border count is a sum of ranks; bisection on that sum finds where the k-th
unit ends, for all texts of the slice at once.  Ranks of the continuing bytes
turn places in bytes into code points.

Units.  A unit ends at each border, and what follows the last border is a unit
too: lines are ``[^\\n]*\\n|[^\\n]+``, words take the blanks before them along.

Defined cases.  A NULL text is an empty one.  A text is left plain if it is
empty, holds one of the three marks, or falls outside ``rate``.  A NULL id
counts as an empty string in the digest that draws the cuts; rows that repeat
an id are cut by the same draw, each on its own text.  Texts of any length are
cut whole: memory grows with a slice or the one longest text (about four bytes
for each of its bytes).  Bytes that are not UTF-8 stay as they are.  Empty
tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from rowloom.llm.common import raw_text

#: Texts are indexed together until their bytes exceed this number.
SLICE_BYTES = 1 << 20
INSIDE, TAIL, LAST, LAST_TAIL, STOP, BLANK, NEWLINE = range(7)
#: The classes a unit ends with.
UNITS = {"line": (NEWLINE,), "word": (LAST, LAST_TAIL, STOP), "sentence": (STOP,)}
MARKS = ("<P>", "<S>", "<M>")
KIND = "n long, form string, prefix_chars long, middle_chars long, output binary"


class BitRank:
    """Bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(packed) // 8 + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    def ones(self, places: np.ndarray) -> np.ndarray:
        word, bit = places >> 6, (places & 63).astype(np.uint64)
        low = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Symbols of a few bits, sorted stably bit by bit from the highest."""

    def __init__(self, symbols: np.ndarray, width: int):
        self.levels: list[tuple[int, BitRank, int]] = []
        for bit in reversed(range(width)):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append((bit, BitRank(ones), int(len(symbols) - ones.sum())))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    def rank(self, symbol: int, places: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before each place."""
        low, high = np.zeros(1, np.int64), places
        for bit, ranks, zeros in self.levels:
            if symbol >> bit & 1:
                low, high = zeros + ranks.ones(low), zeros + ranks.ones(high)
            else:
                low, high = low - ranks.ones(low), high - ranks.ones(high)
        return high - low


def classes(data: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The class of each byte; ``stops`` are the ends of the texts that lie in ``data``."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    last = np.append(blank[1:], True)
    last[stops[stops > 0] - 1] = True
    last &= ~blank
    tail = (data & 0xC0) == 0x80
    found = np.where(tail, TAIL, INSIDE) + np.where(last, LAST, 0)
    found[last & np.isin(data, np.frombuffer(b".!?", np.uint8))] = STOP
    found[blank] = BLANK
    found[data == 10] = NEWLINE
    return found.astype(np.uint8)


class Borders:
    """Border counts and places of the k-th border in each text of a slice."""

    def __init__(self, texts: list[bytes], unit: str):
        sizes = np.array([len(text) for text in texts], np.int64)
        self.stops = np.cumsum(sizes)
        self.starts = self.stops - sizes
        self.ends = UNITS[unit]
        found = classes(np.frombuffer(b"".join(texts), np.uint8), self.stops)
        self.matrix = WaveletMatrix(found, 3)
        first = self.count(self.starts)
        open_end = np.zeros(len(texts), bool)
        filled = sizes > 0
        open_end[filled] = ~np.isin(found[self.stops[filled] - 1], self.ends)
        self.first, self.units = first, self.count(self.stops) - first + open_end

    def count(self, places: np.ndarray) -> np.ndarray:
        return sum(self.matrix.rank(symbol, places) for symbol in self.ends)

    def place(self, k: np.ndarray) -> np.ndarray:
        """Where the first ``k`` units of each text end, by bisection on the border count."""
        low, high = self.starts.copy(), self.stops.copy()
        while (low < high).any():
            middle = (low + high) >> 1
            enough = self.count(middle) >= self.first + k
            high = np.where(enough & (low < high), middle, high)
            low = np.where(~enough & (low < high), middle + 1, low)
        return high

    def chars(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Code points between places."""
        tails = sum(self.matrix.rank(s, high) - self.matrix.rank(s, low) for s in (TAIL, LAST_TAIL))
        return high - low - tails


def slices(texts: list[bytes]) -> Iterator[slice]:
    start, held = 0, 0
    for at, text in enumerate(texts):
        held += len(text)
        if held >= SLICE_BYTES:
            yield slice(start, at + 1)
            start, held = at + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def transform(texts: list[bytes], draws: np.ndarray, unit: str = "line", rate: int = 100, spm_rate: int = 50) -> Iterator[tuple]:
    """n, form, prefix_chars, middle_chars and output of each text.

    The four columns of ``draws`` choose the cuts, whether to cut, and the form.
    """
    marks = [mark.encode() for mark in MARKS]
    for part in slices(texts):
        held, drawn = texts[part], draws[part]
        borders = Borders(held, unit)
        n = borders.units
        one, two = drawn[:, 0] % (n + 1), drawn[:, 1] % (n + 1)
        cut, end = borders.place(np.minimum(one, two)), borders.place(np.maximum(one, two))
        plain = (drawn[:, 2] % 100 >= rate) | np.array([not text or any(mark in text for mark in marks) for text in held], bool)
        columns = [n, borders.chars(borders.starts, cut), borders.chars(cut, end), cut - borders.starts, end - borders.starts, plain, drawn[:, 3] % 100 < spm_rate]
        p, s, m = marks
        for text, (units, before, between, a, b, as_is, spm) in zip(held, zip(*(c.tolist() for c in columns), strict=True), strict=True):
            if as_is:
                yield units, "plain", None, None, text
            elif spm:
                yield units, "spm", before, between, b"".join((s, text[b:], p, text[:a], m, text[a:b]))
            else:
                yield units, "psm", before, between, b"".join((p, text[:a], s, text[b:], m, text[a:b]))


def draws_of(ident: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits from the digest of the seed and an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from.

    Plain outputs are texts already; in the others each mark stands once.
    """
    p, s, m = (F.lit(mark) for mark in MARKS)
    lead = len(MARKS[0]) + 1

    def after(column: Column) -> Column:
        return F.substring(column, lead, (1 << 31) - 1)

    def part(column: Column, mark: Column, number: int) -> Column:
        return F.split_part(column, mark, F.lit(number))

    psm_rest, spm_rest = part(output, s, 2), part(output, p, 2)
    psm = F.concat(after(part(output, s, 1)), part(psm_rest, m, 2), part(psm_rest, m, 1))
    spm = F.concat(part(spm_rest, m, 1), part(spm_rest, m, 2), after(part(output, p, 1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line", rate: int = 100, spm_rate: int = 50, seed: int = 7
) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output, one row per document."""
    if unit not in UNITS:
        raise ValueError(f"fill_in_middle: the unit is one of {sorted(UNITS)}, not {unit!r}")

    def run(text: pa.Array, *drawn: pa.Array) -> pa.Array:
        draws = np.stack([d.to_numpy(zero_copy_only=False) for d in drawn], axis=1).astype(np.int64)
        rows = list(transform(text.to_pylist(), draws, unit, rate, spm_rate))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["n", "form", "prefix_chars", "middle_chars", "output"])

    made = arrow_udf(run, KIND)(raw_text(text_col), *draws_of(F.col(id_col), seed))
    rows = docs.select(F.col(id_col).alias("doc_id"), made.alias("m"))
    return rows.select("doc_id", "m.n", "m.form", "m.prefix_chars", "m.middle_chars", F.col("m.output").cast("string").alias("output"))
