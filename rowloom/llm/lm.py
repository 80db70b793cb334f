"""Score texts with a smoothed n-gram model held as a weighted backoff automaton.

The n-grams of the learning texts are the model; it is never gathered in one
place.  Texts are dealt to blocks of a bounded size.  A block lists its
different n-grams with their own counts, cut into ranges of their hashes; a
range adds up the counts of all blocks and answers each block with the totals
of what it listed, in the same order.  There are as many ranges as the n-grams
need, whatever the number of blocks, and a block lists no empty range, so there
are never more rows than n-grams listed.  A block then builds the part of the
automaton that its texts can reach and walks them through it.  Both shuffles
carry one entry per block and different n-gram, so a frequent one is no hot
key, and blocks and ranges grow in number, not in size.

States are histories of up to ``order - 1`` words that occur in the learning
texts.  An arc (history, word) exists where the n-gram occurs and weighs the
logarithm of (c + m p) / (n + m): c and n count the n-gram and its history, p
is the probability of the word after the history without its first word, and m
is ``prior``.  A failure arc leads to that shorter history and weighs m /
(n + m), so the probabilities after every history sum up to 1.  After no
history a known word has (c - d) / N, and all unknown words together have what
the discounts d leave.

Words are known by 63-bit hashes; two of w different n-grams meet by chance
with a probability near w * w / 2**64.

Defined cases.  A NULL text is empty and has one token, the end.  Rows with a
NULL id are learned from.  Repeated rows count as often as they stand.  With
nothing to learn from every token has probability 1.  An empty table gives an
empty result.  Other columns are never read.  Memory grows with a block, or
with the one longest text if that is more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.common import crc_mod, raw_text, whole_text, word_count
from rowloom.session import materialize

#: Bytes of text per block.
BLOCK_BYTES = 8_000_000
#: N-grams of all texts for each range of hashes (blocks list each once, so a range gets far fewer), and the fewest ranges.
RANGE_GRAMS, RANGES = 2_500_000, 16
START, END = b"\x20", b"\x20\x20"  # no words, as they hold blanks
MIX_1, MIX_2, MIX_3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash pairs of numbers; the lowest bit is 0, which no single word has."""
    x = (a * MIX_1) ^ (b + MIX_2)
    x = (x ^ (x >> np.uint64(30))) * MIX_2
    x = (x ^ (x >> np.uint64(27))) * MIX_3
    return (x ^ (x >> np.uint64(31))) & ~np.uint64(1)


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) | 1


class Grams:
    """The tokens of some texts and their different n-grams of each order.

    ``at[k]`` holds for each token which (k+1)-gram ends there, or -1 where the
    text has begun too late; ``history[k]`` and ``suffix[k]`` lead from a
    (k+1)-gram to the k-grams without its last and without its first word.
    """

    def __init__(self, texts: list[bytes], order: int):
        numbers: dict[bytes, int] = {START: 0, END: 1}
        flow: list[int] = []
        sizes = []
        for text in texts:
            words = text.lower().split()
            flow.append(0)
            flow.extend([numbers.setdefault(w, len(numbers)) for w in words])
            flow.append(1)
            sizes.append(len(words) + 2)
        self.sizes = np.array(sizes, np.int64)
        self.text = np.repeat(np.arange(len(texts)), self.sizes)
        begin = np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        depth = np.arange(len(flow)) - begin
        words = np.array(flow, np.int64)
        hashes = np.fromiter(map(word_hash, numbers), np.uint64, len(numbers))
        self.at, self.keys, self.history, self.suffix = [words], [hashes], [None], [None]
        for k in range(1, order):
            inside = np.flatnonzero(depth >= k)
            last = self.at[k - 1]
            pairs = last[inside - 1] * len(numbers) + words[inside]
            distinct, where, index = np.unique(pairs, return_index=True, return_inverse=True)
            place = np.full(len(flow), -1, np.int64)
            place[inside] = index
            self.at.append(place)
            self.history.append(last[inside[where] - 1])
            self.suffix.append(last[inside[where]])
            self.keys.append(_mixed(self.keys[k - 1][self.history[k]], hashes[words[inside[where]]]))
        everything = np.concatenate(self.keys)
        self.order_of = np.argsort(everything, kind="stable")
        self.sorted_keys = everything[self.order_of]

    def counts(self, learn: np.ndarray) -> np.ndarray:
        """How often each n-gram stands in the texts to learn from, in the order of the keys."""
        use = learn[self.text]
        found = [np.bincount(at[use & (at >= 0)], minlength=len(keys)) for at, keys in zip(self.at, self.keys, strict=True)]
        return np.concatenate(found)[self.order_of]

    def by_order(self, totals: np.ndarray) -> list[np.ndarray]:
        plain = np.empty(len(totals), np.float64)
        plain[self.order_of] = totals
        return np.split(plain, np.cumsum([len(k) for k in self.keys])[:-1])


class BackoffAutomaton:
    """The states and arcs that some texts can reach; weights are logarithms to base 10."""

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, prior: float, discount: float):
        self.grams, self.counts = grams, counts
        known = counts[0] > 0
        chance = np.where(known, np.maximum(counts[0] - discount, 0) / max(tokens, 1), discount / max(tokens, 1) if tokens else 1.0)
        self.arcs, self.fails = [np.log10(chance)], []
        for k in range(1, len(counts)):
            n = counts[k - 1][grams.history[k]]
            chance = (counts[k] + prior * chance[grams.suffix[k]]) / (n + prior)
            self.arcs.append(np.log10(chance))
            self.fails.append(np.log10(prior / (counts[k - 1] + prior)))

    def walk(self) -> np.ndarray:
        """The weight of each token, from left to right through all texts at once.

        The state before a token is its longest history that occurs in the
        learning texts.  Where it has no arc for the token, failure arcs are
        taken until a state has one; the empty history has one for every word.
        Unknown words still lack the number of known ones (see ``score_texts``).
        """
        at, counts = self.grams.at, self.counts
        weight = np.zeros(len(at[0]))
        waiting = np.ones(len(weight), bool)
        for k in range(len(counts) - 1, 0, -1):
            before = np.where(at[k] >= 0, np.append(-1, at[k - 1][:-1]), -1)
            here = waiting & (before >= 0)
            here[here] = counts[k - 1][before[here]] > 0
            arc = here.copy()
            arc[arc] = counts[k][at[k][arc]] > 0
            weight[arc] += self.arcs[k][at[k][arc]]
            fail = here & ~arc
            weight[fail] += self.fails[k - 1][before[fail]]
            waiting &= ~arc
        weight[waiting] += self.arcs[0][at[0][waiting]]
        return weight


def pack(numbers: np.ndarray) -> bytes:
    """64-bit numbers by byte planes, which the shuffle compresses."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _texts(table: pa.Table, order: int) -> Grams:
    return Grams(table.column("text").to_pylist(), order)


def _dealt(docs: DataFrame, id_col: str, text_col: str, learn, blocks: int) -> DataFrame:
    ident = F.col(id_col)
    return docs.select(
        F.pmod(F.xxhash64(ident, F.xxhash64(whole_text(text_col))), F.lit(blocks)).cast("int").alias("block"),
        ident.alias("doc_id"),
        learn.alias("learn"),
        raw_text(text_col).alias("text"),
    )


def range_count(tokens: int, order: int) -> int:
    return max(RANGES, -(-tokens * order // RANGE_GRAMS))


def listed_ngrams(dealt: DataFrame, order: int, ranges: int) -> DataFrame:
    """One row per block and range of hashes that it has n-grams in: which, and how often in learning texts."""
    starts = np.array([(1 << 64) * k // ranges for k in range(1, ranges)], np.uint64)

    def listed(table: pa.Table) -> pa.Table:
        grams = _texts(table, order)
        keys, counts = grams.sorted_keys, grams.counts(np.array(table.column("learn").to_pylist(), bool))
        cuts = np.searchsorted(keys, starts)
        parts, amounts = np.split(keys, cuts), np.split(counts, cuts)
        filled = [number for number, part in enumerate(parts) if len(part)]
        steps = [pack(np.diff(parts[number], prepend=np.uint64(0))) for number in filled]
        block = table.column("block")[0].as_py()
        rows = {"range": filled, "block": [block] * len(filled), "keys": steps, "counts": [pack(amounts[number]) for number in filled]}
        return pa.table(rows, pa.schema([("range", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))

    return dealt.groupBy("block").applyInArrow(listed, "range int, block int, keys binary, counts binary")


def total_counts(listed: DataFrame) -> DataFrame:
    """Answer each block: the totals of the n-grams that it listed in a range; ``known`` counts words once."""
    start = np.uint64(word_hash(START))

    def totals(table: pa.Table) -> pa.Table:
        parts = [np.cumsum(unpack(raw), dtype=np.uint64) for raw in table.column("keys").to_pylist()]
        counts = np.concatenate([unpack(raw) for raw in table.column("counts").to_pylist()])
        distinct, index = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(index, weights=counts, minlength=len(distinct))
        word = (distinct & np.uint64(1)).astype(bool) & (distinct != start)
        answers = np.split(total[index].astype(np.uint64), np.cumsum([len(p) for p in parts])[:-1])
        known = [int((word & (total > 0)).sum())] + [0] * (len(parts) - 1)
        rows = {"block": table.column("block"), "range": table.column("range"), "totals": [pack(a) for a in answers], "known": known}
        return pa.table(rows, pa.schema([("block", pa.int32()), ("range", pa.int32()), ("totals", pa.binary()), ("known", pa.int64())]))

    return listed.groupBy("range").applyInArrow(totals, "block int, range int, totals binary, known long")


def score_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    learn=None,
    order: int = 2,
    prior: float = 100.0,
    discount: float = 0.75,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Return doc_id, learned, n_tokens, n_known, train_tokens, base_score and score, one row per document.

    ``learn`` is a condition that picks the texts to learn from; by default
    those whose crc32 of the id as text leaves no remainder of 1 by 5.
    ``base_score`` is the add-half unigram score over the same tokens.  Higher
    orders shuffle more: nearly every trigram of a large corpus is new.
    """
    learn = crc_mod(F.col(id_col), 5) != 1 if learn is None else learn
    counted = docs.select(F.octet_length(raw_text(text_col)).alias("b"), word_count(whole_text(text_col)).alias("w"), learn.alias("learn"))
    facts = counted.select("b", "w", F.when(F.col("learn"), F.col("w") + 1).alias("t"))
    words_all = F.coalesce(F.sum("w"), F.lit(0)) + 2 * F.count(F.lit(1))
    size, tokens, entries = facts.agg(F.coalesce(F.sum("b"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0)), words_all).first()
    blocks = max(1, -(-size // block_bytes))
    dealt = _dealt(docs, id_col, text_col, learn, blocks)
    answers = total_counts(listed_ngrams(dealt, order, range_count(entries, order)))
    kind = docs.schema[docs.select(F.col(id_col)).columns[0]].dataType
    schema = T.StructType().add("doc_id", kind).add("learned", "boolean").add("n_tokens", "long").add("n_known", "long")
    schema = schema.add("base_part", "double").add("score_part", "double").add("known_words", "long")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        grams = _texts(left, order)
        right = right.sort_by("range")
        counts = grams.by_order(np.concatenate([unpack(raw) for raw in right.column("totals").to_pylist()]))
        weight = BackoffAutomaton(grams, counts, tokens, prior, discount).walk()
        token = grams.at[0] != 0  # all but the start
        text, seen = grams.text[token], counts[0][grams.at[0][token]]
        add = lambda x: np.bincount(text, weights=x, minlength=len(grams.sizes))
        rows = {
            "doc_id": left.column("doc_id"),
            "learned": left.column("learn"),
            "n_tokens": grams.sizes - 1,
            "n_known": add(seen > 0).astype(np.int64),
            "base_part": add(np.log10(seen + 0.5)),
            "score_part": add(weight[token]),
            "known_words": [sum(right.column("known").to_pylist())] + [0] * (len(grams.sizes) - 1),
        }
        return pa.table(rows)

    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema)
    scored = materialize(scored, "lm-scores")
    words = scored.agg(F.coalesce(F.sum("known_words"), F.lit(0))).first()[0]
    unknown = F.col("n_tokens") - F.col("n_known")
    return scored.select(
        "doc_id",
        "learned",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_part") - F.col("n_tokens") * F.lit(float(np.log10(tokens + 0.5 * (words + 1))))).alias("base_score"),
        (F.col("score_part") + unknown * F.lit(float(np.log10(max(words, 1))))).alias("score"),
    )
