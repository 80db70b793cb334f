"""Byte-pair encoding as a streaming transducer, and decoding as a state machine.

A merge list bounds how far to the left a later symbol can change tokens.  Let
x be a prefix of a word xy and compare the merging of both, rule by rule.  At
first they agree left of the end of x.  Rule (u, v) moves that frontier only by
joining u, left of it, with v, right of it; then it lies len(u) further left.
The next rule (u', v') that moves it comes later in the list, and v' begins
where u began, so u is a prefix of v'.  The frontier thus moves by at most the
largest sum of len(u) over chains of rules in list order in which every u is a
prefix of the next v.  ``sufficient_lookahead`` computes this; a token that
ends so many symbols before the end of what was read is final.  The encoder
keeps a window of that length and a bounded memo of words, nothing else.

Text is normalised, split and encoded as the tokenizers library does for a
word-end vocabulary: special tokens first, then NFC, lower case, the split
expression, the byte alphabet and the merges.

Defined cases.  A NULL text is empty and has no tokens; its decoded text is
empty.  Texts of any length are encoded whole, piece by piece between blanks,
long words in windows.  Repeated rows give equal results.  Other columns are
kept as they are.
"""

from __future__ import annotations

import codecs
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from rowloom.llm.common import raw_text

END = "</w>"
#: Characters read at once; a piece ends at the next blank.
PIECE = 1 << 15
#: Words remembered per worker, and as many from before; one is shorter than any window.
MEMO = 100_000
WORD_MEMO_LENGTH = 48
#: A merge is one number: its place in the list above these bits, its token in them.
TOKEN_BITS = 24
TOKEN_MASK = (1 << TOKEN_BITS) - 1
NO_RULE = sys.maxsize
#: Letters and digits that ``regex`` knows and the library's older tables do not.  Fixed values.
LATER_LETTERS = (
    r"\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce\ua7cf\ua7d2\ua7d4\ua7e2\ua7f1\uab6c\uab6d"
    r"\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb\U00011df1"
    r"\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2\U00016ff3\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    r"\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    r"\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2"
    r"\U0001e6e4\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e"
    r"\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: its own if it has one, else those from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


def sufficient_lookahead(merges: Iterable[tuple[str, str]]) -> int:
    """How many symbols right of a token suffice to know that it is final (see the module's text)."""
    furthest: dict[str, int] = {}
    most = 0
    for left, right in merges:
        plain = right.removesuffix(END)
        longest = len(plain) - (plain != right)
        before = max((furthest.get(plain[:k], 0) for k in range(1, longest + 1)), default=0)
        reach = len(left) + before
        furthest[left] = max(furthest.get(left, 0), reach)
        most = max(most, reach)
    return most


class Vocabulary:
    """A tokenizer file with word ends: its tokens, merges, split expression and special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        if model.get("end_of_word_suffix") != END or told.get("decoder"):
            raise ValueError("a vocabulary with word ends and without a decoder is expected")
        ids = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # Of each pair the place in the list, which decides, and the token that it makes.
        self.merges = {(ids[a], ids[b]): rank << TOKEN_BITS | ids[a + b] for rank, (a, b) in enumerate(pairs)}
        alphabet = byte_alphabet()
        self.inner = [ids[c] for c in alphabet]
        self.final = [ids[c + END] for c in alphabet]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.tokens = {number: text for text, number in [*ids.items(), *self.special.items()]}
        split = next(p for p in told["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        said = split["pattern"]["Regex"]
        late = LATER_LETTERS
        letters, digits = rf"[\p{{L}}--[{late}]]", rf"[\p{{N}}--[{late}]]"
        known = {r"[\p{L}]": letters, r"[\p{N}]": digits, r"[^\s\p{L}\p{N}]": rf"[^\s{letters}{digits}]"}
        exact = said
        for written, meant in known.items():
            exact = exact.replace(written, meant)
        self.split = regex.compile("(?V1)" + exact)
        # The same expression for lower-case ASCII, where it is faster.
        self.split_ascii = re.compile(said.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9").replace(r"\s", r"\t-\r "))
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.lookahead = sufficient_lookahead(pairs)
        self.sizes = {number: len(text.removesuffix(END)) for number, text in self.tokens.items()}
        self.window = self.lookahead + max(len(text) for text in ids) + 64
        to_byte = {c: b for b, c in enumerate(alphabet)}
        self.bytes = {
            number: bytes(to_byte[c] for c in text.removesuffix(END)) + b" " * text.endswith(END) if number not in self.special.values() else text.encode()
            for number, text in self.tokens.items()
        }


def merge(symbols: list[int], merges: dict[tuple[int, int], int]) -> list[int]:
    """Join the pair that comes first in the merge list, leftmost first, until none is left."""
    look = merges.get
    ranks = [look(pair, NO_RULE) for pair in pairwise(symbols)]
    while ranks:
        best = min(ranks)
        if best == NO_RULE:
            break
        i = ranks.index(best)
        joined = best & TOKEN_MASK
        symbols[i : i + 2] = (joined,)
        del ranks[i]
        if i < len(ranks):
            ranks[i] = look((joined, symbols[i + 1]), NO_RULE)
        if i:
            ranks[i - 1] = look((symbols[i - 1], joined), NO_RULE)
    return symbols


class WordTransducer(dict):
    """Words to token ids; remembers short words, streams long ones through a window."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(word) > WORD_MEMO_LENGTH:
            return tuple(self.stream(word))
        found = self.older.get(word)
        if found is None:
            v = self.vocabulary
            raw = word.encode()
            symbols = [v.inner[b] for b in raw]
            symbols[-1] = v.final[raw[-1]]
            found = tuple(merge(symbols, v.merges))
        if len(self) >= MEMO:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found

    def stream(self, word: str) -> Iterator[int]:
        """Emit the tokens of a word as soon as the lookahead makes them final."""
        v = self.vocabulary
        raw = word.encode()
        window: list[int] = []
        for at in range(0, len(raw), v.window):
            part = raw[at : at + v.window]
            window.extend(v.inner[b] for b in part)
            if at + v.window >= len(raw):
                window[-1] = v.final[raw[-1]]
                yield from merge(window, v.merges)
                return
            known, used = len(window) - v.lookahead, 0
            for token in merge(list(window), v.merges):
                if used + v.sizes[token] > known:
                    break
                used += v.sizes[token]
                yield token
            window = window[used:]


class Encoder:
    """Text to token ids, piece by piece."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.words = WordTransducer(vocabulary)

    def pieces(self, text: str) -> Iterator[str]:
        """Parts of a text that no token or composition crosses: they end before a blank."""
        start = 0
        while len(text) - start > PIECE:
            stop = min((p for p in (text.find(" ", start + PIECE), text.find("\n", start + PIECE)) if p >= 0), default=len(text))
            yield text[start:stop]
            start = stop
        yield text[start:]

    def encode(self, text: str) -> Iterator[array]:
        v = self.vocabulary
        for piece in self.pieces(text):
            if not any(special in piece for special in v.special):
                yield self.plain(piece)
                continue
            for part in v.specials.split(piece):
                yield array("I", [v.special[part]]) if part in v.special else self.plain(part)

    def plain(self, text: str) -> array:
        if text.isascii():
            found = self.vocabulary.split_ascii.findall(text.lower())
        else:
            # One character at a time, the sigma has no final form.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            found = self.vocabulary.split.findall(text.lower())
        return array("I", chain.from_iterable(map(self.words.__getitem__, found)))


class TokenDecoder:
    """Token ids to the library's text: for a vocabulary without a decoder, tokens with blanks between."""

    def __init__(self, vocabulary: Vocabulary):
        self.tokens, self.begun = vocabulary.tokens, False

    def feed(self, ids: Iterable[int]) -> str:
        text = " ".join(map(self.tokens.__getitem__, ids))
        if text and self.begun:
            text = " " + text
        self.begun |= bool(text)
        return text

    def finish(self) -> str:
        return ""


class TextDecoder:
    """Token ids to readable text: bytes go through an incremental UTF-8 state machine, word ends become blanks."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes = vocabulary.bytes
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.bytes.__getitem__, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(Vocabulary(path))


def encode_decode(text: str, using: Encoder, decoders=(TokenDecoder,)) -> tuple[bytes, list[str]]:
    """The ids of a text as little-endian 32-bit numbers, and what each decoder makes of them, piece by piece."""
    machines, ids = [(kind(using.vocabulary), []) for kind in decoders], []
    for part in using.encode(text):
        for machine, decoded in machines:
            decoded.append(machine.feed(part))
        if sys.byteorder == "big":
            part.byteswap()
        ids.append(part.tobytes())
    return b"".join(ids), ["".join(decoded) + machine.finish() for machine, decoded in machines]


def tokens(text_col: str, path: str, readable: bool = False) -> Column:
    """A struct of a text's token ids, packed as little-endian 32-bit numbers, and the decoded text.

    With ``readable`` also the text that the byte-to-text state machine reads
    from the same tokens.
    """
    decoders = (TokenDecoder, TextDecoder) if readable else (TokenDecoder,)
    names = ["ids", "decoded", "readable"][: 1 + len(decoders)]

    def run(batch: pa.Array) -> pa.Array:
        using = encoder(path)
        rows = [encode_decode(raw.decode("utf-8", "replace"), using, decoders) for raw in batch.to_pylist()]
        texts = [pa.array([texts[k] for _, texts in rows], pa.string()) for k in range(len(decoders))]
        return pa.StructArray.from_arrays([pa.array([ids for ids, _ in rows], pa.binary()), *texts], names=names)

    return arrow_udf(run, "ids binary, " + ", ".join(f"{name} string" for name in names[1:]))(raw_text(text_col))


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (packed), decoded and readable, one row per document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), tokens(text_col, path, readable=True).alias("t"))
    return rows.select("doc_id", (F.octet_length("t.ids") / 4).cast("long").alias("n_tokens"), "t.ids", "t.decoded", "t.readable")
