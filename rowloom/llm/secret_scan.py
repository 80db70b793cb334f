"""Secrets in texts: fixed patterns, and values in credential contexts that are hard to guess.

The patterns find assigned keys, access keys and long hexadecimal runs.  Beyond
them, a value that stands where a credential stands (after a name such as
``passphrase`` and a separator, or before the ``@`` of a URL) is judged by the
number of guesses it takes.  Dynamic programming over the places of the value
finds the segmentation with the fewest guesses, counted in decades: known
words (ranked, with case and letter-like digits), dates, repeated blocks, runs
on a keyboard or of an alphabet, letters that could be any word, and brute force.
A value that needs at least ``min_decades`` is a secret of kind ``guess``.

Each text is scanned whole in one pass over its bytes.  The work on a value
grows with its length times fixed numbers (longest word, longest block and the
shapes of dates), not with its square.

Defined cases.  A NULL text is an empty one without secrets.  Places count code
points and ends are exclusive.  Matches of one kind never overlap; spans of
different kinds may.  A value that a span of the patterns covers whole is not
reported again.  Repeated rows are scanned one by one, ties do not arise, empty
tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from rowloom.llm.common import raw_text

KINDS = ("assign", "access", "hex", "guess")
#: The three patterns; a match counts from so many characters on.
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ASSIGN_LENGTH = 12
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
HEX = re.compile(rb"[0-9a-f]{16,}")
#: Names before a credential.  A short name begins where no letter goes before.
NAMED = re.compile(
    rb"""(?:(?<![a-z])(?:pass|pwd|auth|bearer)|pass(?:word|wd|phrase|code)|secret|token|(?:api|access|private|signing)[_-]?key|credentials?|authorization)"""
    rb"""["']?[ \t]*(?::=|=>|[:=])[ \t]*(?:bearer |basic )?(?:"([^"\n]+)"|'([^'\n]+)'|["']?([^\s"']+))""",
    re.IGNORECASE,
)
IN_URL = re.compile(rb"://[^\s/:@]*:([^\s/@]+)@")
#: What a sentence puts behind a bare value.
TRAILING = b".,;:!?)]}>*#$%&"
CONTINUING = bytes(range(0x80, 0xC0))

#: Words of passwords and placeholders, the commonest first; the place in the list is the number of guesses.
WORDS = """password admin test secret example welcome user login letmein change changeme default root master hello
monkey dragon qwerty shadow sunshine princess football baseball iloveyou love star super batman summer winter spring
autumn monday friday january march april june july august october access guest demo sample temp temporary public private
secure server database db prod production dev staging local host token key api client service account email mail user
name your my the and for new old none null true false value here placeholder redacted hidden unknown insert replace
enter pass word phrase code auth bearer basic login company office home house family money power magic ninja mustang
hunter ranger tiger eagle killer soccer hockey george michael thomas jordan robert daniel andrew jessica ashley charlie
maggie pepper ginger cookie banana orange apple cheese coffee chocolate flower purple silver golden black white green
blue red yellow freedom whatever trust forever lucky please google internet computer windows linux system network"""
RANK = {word: rank for rank, word in reversed(list(enumerate(dict.fromkeys(WORDS.split()), 1)))}
LONGEST_WORD = max(map(len, RANK))
#: Digits and signs written for letters.
LIKE = str.maketrans("4@8301!65$7+2", "aabeoiigssttz")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertzuiop", "yxcvbnm", "azertyuiop", "qsdfghjklm", "wxcvbn", "abcdefghijklmnopqrstuvwxyz", "0123456789")
COLUMNS = ("1qaz", "2wsx", "3edc", "4rfv", "5tgb", "6yhn", "7ujm", "8ik", "9ol", "0p")
DATES = [
    re.compile(r"(?:19|20)\d\d(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])"),
    re.compile(r"(?:19|20)\d\d([-/._])(?:1[0-2]|0?[1-9])\1(?:3[01]|[12]\d|0?[1-9])"),
    re.compile(r"(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])(?:(?:19|20)\d\d|\d\d)"),
    re.compile(r"(?:3[01]|[12]\d|0?[1-9])([-/._])(?:1[0-2]|0?[1-9])\1(?:(?:19|20)\d\d|\d\d)"),
    re.compile(r"(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])(?:(?:19|20)\d\d|\d\d)"),
]
YEAR = re.compile(r"(?:19|20)\d\d")
#: Decades of guesses: a day in 200 years, a year, any word of a language, starting a walk.
DAY, ANY_YEAR, ANY_WORD, WALK = math.log10(365 * 200), math.log10(200), 5.0, math.log10(100)
#: The longest block that repeats are looked for.
LONGEST_BLOCK = 16
#: Letters that read as a word: no five consonants or vowels in a row.
WORDLIKE = re.compile(r"(?!.*[^aeiouyà-ÿ]{5})(?!.*[aeiouyà-ÿ]{5})[a-zß-ÿ]{3,24}\Z")
LETTERS = re.compile(r"[A-ZÀ-Þ]?[a-zß-ÿ]+|[A-ZÀ-Þ]+")


def steps() -> set[tuple[str, str]]:
    """Neighbouring keys, in both directions."""
    pairs = {(a, b) for row in (*ROWS, *COLUMNS) for a, b in zip(row, row[1:], strict=False)}
    return pairs | {(b, a) for a, b in pairs}


STEPS = steps()


def brute(char: str) -> float:
    """Decades of one unknown character."""
    if char.isdigit() or "a" <= char <= "z":
        return 1.0
    return 1.5


def word_cost(rank: int, piece: str, likened: int) -> float:
    """Rank, times two for capitals at all, times two for each letter-like sign."""
    return math.log10(rank) + math.log10(2) * ((piece != piece.lower()) + likened)


def longest_runs(value: str) -> Iterator[tuple[int, int, int]]:
    """(start, period, end) of the longest stretch from each place that repeats a block at least twice."""
    n = len(value)
    for period in range(1, min(LONGEST_BLOCK, n // 2) + 1):
        equal = 0
        for at in range(n - period - 1, -1, -1):
            equal = equal + 1 if value[at] == value[at + period] else 0
            if equal >= period and equal + period >= 3:
                yield at, period, at + period + equal // period * period


def segments(value: str, blocks: bool = True) -> Iterator[tuple[int, int, float, str]]:
    """(start, end, decades, kind) of every segment that is no brute force."""
    n, lower = len(value), value.lower()
    if len(lower) != n:
        lower = value
    plain = lower.translate(LIKE)
    for start in range(n):
        for end in range(start + 2, min(n, start + LONGEST_WORD) + 1):
            rank = RANK.get(plain[start:end])
            if rank:
                likened = sum(a != b for a, b in zip(lower[start:end], plain[start:end], strict=True))
                yield start, end, word_cost(rank, value[start:end], likened), "word"
        if value[start].isdigit():
            for shape in DATES:
                found = shape.match(value, start)
                if found:
                    yield start, found.end(), DAY + (0.6 if found.re.groups else 0), "date"
            found = YEAR.match(value, start)
            if found:
                yield start, found.end(), ANY_YEAR, "date"
    start = 0
    while start < n:
        end, turns, last = start + 1, 0, None
        while end < n and (lower[end - 1], lower[end]) in STEPS:
            step = ord(lower[end]) > ord(lower[end - 1])
            turns += last is not None and step != last
            last = step
            end += 1
        if end - start >= 3:
            yield start, end, WALK + math.log10(end - start) + 0.3 * (turns + (value[start:end] != lower[start:end])), "walk"
        start = max(end - 1, start + 1)
    for found in LETTERS.finditer(value):
        if WORDLIKE.match(found.group().lower()):
            yield found.start(), found.end(), ANY_WORD + math.log10(2) * (found.group() != found.group().lower()), "any word"
    if blocks:
        for start, period, end in longest_runs(value):
            yield start, end, decades(value[start : start + period]) + math.log10((end - start) // period), "repeat"


def cheapest(value: str, blocks: bool = True) -> tuple[float, list[tuple[int, int, str]]]:
    """The least decades of guesses for a value, and the segmentation that needs them."""
    n = len(value)
    ending: list[list[tuple[int, float, str]]] = [[] for _ in range(n + 1)]
    for start, end, cost, kind in segments(value, blocks):
        ending[end].append((start, cost, kind))
    best, came = [0.0] * (n + 1), [(0, "")] * (n + 1)
    for end in range(1, n + 1):
        best[end], came[end] = best[end - 1] + brute(value[end - 1]), (end - 1, "brute force")
        for start, cost, kind in ending[end]:
            if best[start] + cost < best[end]:
                best[end], came[end] = best[start] + cost, (start, kind)
    parts, at = [], n
    while at:
        start, kind = came[at]
        if kind == "brute force" and parts and parts[-1][2] == kind:
            parts[-1] = (start, parts[-1][1], kind)
        else:
            parts.append((start, at, kind))
        at = start
    return best[n], parts[::-1]


@lru_cache(maxsize=4096)
def decades(block: str) -> float:
    """The guesses for one block of a repeat, itself without repeats."""
    return cheapest(block, blocks=False)[0]


def pattern_spans(text: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes of the matches that are long enough."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LENGTH]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def values(text: bytes) -> Iterator[tuple[int, int]]:
    """The places of values in credential contexts."""
    for found in NAMED.finditer(text):
        group = found.lastindex
        start, end = found.span(group)
        if group == 3:
            end = start + len(text[start:end].rstrip(TRAILING))
        if start < end:
            yield start, end
    for found in IN_URL.finditer(text):
        yield found.span(1)


def scan(text: bytes, min_decades: float = 10.0) -> list[tuple[int, int, str, float | None]]:
    """(start, end, kind, decades) of all secrets of a text, places in code points, in order."""
    base = pattern_spans(text)
    found: dict[tuple[int, int, str], float | None] = dict.fromkeys(base)
    for start, end in values(text):
        if any(a <= start and end <= b for a, b, _ in base):
            continue
        cost = cheapest(text[start:end].decode("utf-8", "replace"))[0]
        if cost >= min_decades:
            found[start, end, "guess"] = cost
    if not found:
        return []
    ordered = sorted(found, key=lambda span: (span[0], KINDS.index(span[2]), span[1]))
    if not text.isascii():
        places = sorted({place for span in ordered for place in span[:2]})
        chars, at, count = {}, 0, 0
        for place in places:
            count += len(text[at:place].translate(None, CONTINUING))
            chars[place], at = count, place
    else:
        chars = None
    return [(chars[a] if chars else a, chars[b] if chars else b, kind, found[a, b, kind]) for a, b, kind in ordered]


def secrets(text_col: str, min_decades: float = 10.0) -> Column:
    """An array of structs: start, end, kind and, for guessed values, decades."""
    row = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("decades", pa.float64())])

    def run(batch: pa.Array) -> pa.Array:
        return pa.array([[dict(zip(("start", "end", "kind", "decades"), s, strict=True)) for s in scan(text, min_decades)] for text in batch.to_pylist()], pa.list_(row))

    return arrow_udf(run, "array<struct<start: long, end: long, kind: string, decades: double>>")(raw_text(text_col))


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_decades: float = 10.0) -> DataFrame:
    """doc_id and secrets, an array of start, end, kind and decades, one row per document."""
    return docs.select(F.col(id_col).alias("doc_id"), secrets(text_col, min_decades).alias("secrets"))
