"""Score toxicity with a classifier learned from toxic examples and unlabelled text.

Non-negative positive-unlabelled learning: the confirmed toxic texts are the
positives, texts without regard to their label stand for all others.  With the
share of toxic texts, the class prior, as a known number, the risk on the
negatives is the risk on the unlabelled texts less the prior's share of the
risk that the positives would have as negatives.  Where this estimate falls
below zero the model has begun to fit the positives, and the step goes up that
part alone instead of down.

A text is a vector over hashed words and beginnings of words, present or not.
Spark's tasks count these buckets in all texts that may be learned from, and
those that tell toxic texts from texts in general, a few thousand at most in
practice, may have a weight.  A second pass reduces every text to its telling
buckets and writes them; texts with the same buckets become one pattern with a
number.  Each step of the descent sums risk and slope over all patterns in
numpy inside the tasks; two numbers a bucket come to the driver, however many
texts there are.  The unlabelled side is thus every permitted text.  The
positives are at most about ``max_positives`` labelled texts, chosen by a hash
of their ids.  Sums are of whole numbers, so reruns give the same model.

Defined cases.  A NULL text is empty and gets the score of the intercept.
Labels of unknown ids are ignored; an id that is labelled more than once is
toxic if one of its labels says so.  Rows with a NULL id have no label and are
not learned from.  Repeated rows count each time and are scored alike.
Without positives or unlabelled texts all scores are the prior.  Very long
texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.common import crc_mod, raw_text
from rowloom.session import materialize, release

FEATURES = 1 << 18
#: Beginnings of words, in bytes, that are features beside the word.
BEGINNINGS = (4, 5, 6)
#: Parts by which the positives are thinned.
LOTS = 1 << 40
#: Probabilities and losses are summed as multiples of 1 / UNIT, which add up alike in any order.
UNIT = 1 << 20
#: Words remembered per worker.
MEMO = 200_000
#: Bytes that are no part of a word at its ends.
EDGES = bytes(b for b in range(128) if not chr(b).isalnum())


class WordBuckets(dict):
    """Words to the buckets of the word and of its beginnings; remembers a bounded number of words.

    With ``place``, to the places of those buckets that have one (not -1).
    """

    def __init__(self, place: np.ndarray | None = None):
        super().__init__()
        self.place = place

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        plain = word.strip(EDGES)
        parts = {plain, *(plain[:n] + b"*" for n in BEGINNINGS if len(plain) >= n)}
        found = tuple(xxhash.xxh3_64_intdigest(part) % FEATURES for part in parts) if plain else ()
        if self.place is not None:
            found = tuple(int(self.place[bucket]) for bucket in found if self.place[bucket] >= 0)
        if len(self) >= MEMO:
            self.clear()
        self[word] = found
        return found


def buckets_of(texts: list[bytes], known: WordBuckets) -> list[np.ndarray]:
    """The different buckets of each text."""
    return [np.fromiter(set(chain.from_iterable(map(known.__getitem__, set(text.lower().split())))), np.int64) for text in texts]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """A weight for each telling bucket, by its place, and the intercept."""

    weights: np.ndarray
    bias: float

    def scores(self, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        rows = np.repeat(np.arange(len(sizes)), sizes)
        return _sigmoid(np.bincount(rows, weights=self.weights[places], minlength=len(sizes)) + self.bias)


@dataclass
class Sums:
    """Over all texts and over the positives: probabilities by bucket, all of them, and losses as a negative, in units."""

    texts: np.ndarray
    positives: np.ndarray


def telling(positives: np.ndarray, n: int, counts: np.ndarray, texts: int, least: float) -> np.ndarray:
    """Which buckets more positives have than texts in general, by at least so many standard errors.

    ``positives`` of ``n`` toxic texts and ``counts`` of so many ``texts`` have
    each bucket.  The root of the likelihood ratio stands for standard errors:
    it holds for rare words too.
    """
    both = np.maximum(positives + counts, 1)
    ratio = lambda x, of: x * np.log(np.maximum(x, 1e-300) / (both * (of / (n + texts))))
    return (positives / n > counts / texts) & (2 * (ratio(positives, n) + ratio(counts, texts)) >= least**2) & (positives > 1)


def pattern_sums(model: Model, places: np.ndarray, sizes: np.ndarray, n: np.ndarray, p: np.ndarray) -> Sums:
    """The sums over some patterns, each of ``n`` texts of which ``p`` are positives."""
    score = model.scores(places, sizes)
    chance, loss = np.rint(score * UNIT), np.rint(-np.log1p(-np.minimum(score, 1 - 1e-12)) * UNIT)

    def added(by: np.ndarray) -> np.ndarray:
        of_bucket = np.bincount(places, weights=np.repeat(chance * by, sizes), minlength=len(model.weights))
        return np.append(of_bucket, [(chance * by).sum(), (loss * by).sum()]).astype(np.int64)

    return Sums(added(n), added(p))


def nnpu_slope(sums: Sums, texts: int, n: int, positives: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """The risk on the negatives, and the direction of the next step: weights, then the intercept.

    Logistic losses: -log s for the toxic class, -log(1 - s) for the other.
    Below zero the step leaves the positives alone and raises that risk.
    """
    u, p = sums.texts / (UNIT * texts), sums.positives / (UNIT * n)
    negative = float(u[-1] - prior * p[-1])
    downhill = u[:-1] - prior * p[:-1]
    return negative, prior * (p[:-1] - np.append(positives, n) / n) + downhill if negative >= 0 else -downhill


def fit_nnpu(
    sums: Callable[[Model], Sums],
    positives: np.ndarray,
    n: int,
    texts: int,
    prior: float,
    steps: int = 80,
    rate: float = 0.1,
    decay: float = 1e-3,
) -> Model:
    """Minimise the non-negative risk with the logistic loss by Adam, each step over all texts.

    ``sums`` gives the sums under a model; ``positives`` of ``n`` toxic texts
    have each telling bucket.
    """
    model = Model(np.zeros(len(positives)), float(np.log(prior / (1 - prior))))
    first, second = np.zeros(len(positives) + 1), np.zeros(len(positives) + 1)
    for step in range(1, steps + 1 if len(positives) else 1):
        _, change = nnpu_slope(sums(model), texts, n, positives, prior)
        change[:-1] += decay * model.weights
        first = 0.9 * first + 0.1 * change
        second = 0.999 * second + 0.001 * change**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        model = Model(model.weights - move[:-1], model.bias - float(move[-1]))
    return model


def share(most: int, of: int) -> int:
    """The lots, at least one, that hold about ``most`` of so many rows."""
    return min(LOTS, -(-most * LOTS // max(of, 1)))


def marked_texts(docs: DataFrame, positive: DataFrame, learn: Callable[[Column], Column], id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, used (may be learned from) and positive of every row."""
    ident = F.col(id_col)
    rows = docs.select(ident.alias("doc_id"), raw_text(text_col).alias("text"), (ident.isNotNull() & learn(ident)).alias("used"))
    # At most about max_positives ids, so every task can have them.
    return rows.join(F.broadcast(positive), F.col("used") & (F.col("doc_id") == F.col("l_")), "left").withColumn("positive", F.col("l_").isNotNull()).drop("l_")


def bucket_counts(marked: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How many of all texts that may be learned from, and how many positives, have each bucket; last, how many there are."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = WordBuckets(), np.zeros((2, FEATURES + 1), np.int64)
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("positive").to_pylist(), strict=True):
                (buckets,) = buckets_of([text], known)
                counts[0, buckets] += 1
                counts[0, FEATURES] += 1
                if toxic:
                    counts[1, buckets] += 1
                    counts[1, FEATURES] += 1
        which = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(which.astype(np.int32)), *(pa.array(c[which]) for c in counts)], names=["bucket", "n", "p"])

    rows = marked.where("used").select("text", "positive").mapInArrow(counted, "bucket int, n long, p long")
    found = rows.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).toArrow()
    counts = np.zeros((2, FEATURES + 1), np.int64)
    counts[:, found.column("bucket").to_numpy()] = found.column("n").to_numpy(), found.column("p").to_numpy()
    return counts[0], counts[1]


def telling_places(marked: DataFrame, useful: np.ndarray) -> DataFrame:
    """doc_id, used, positive and places: the telling buckets of each text, numbered, sorted and packed."""
    place = np.full(FEATURES, -1, np.int32)
    place[useful] = np.arange(useful.sum())

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordBuckets(place)
        for batch in batches:
            found = [np.sort(x).astype("<i4").tobytes() for x in buckets_of(batch.column("text").to_pylist(), known)]
            columns = [batch.column(c) for c in ("doc_id", "used", "positive")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary())], names=["doc_id", "used", "positive", "places"])

    schema = T.StructType([marked.schema[c] for c in ("doc_id", "used", "positive")]).add("places", "binary")
    return marked.select("doc_id", "used", "positive", "text").mapInArrow(packed, schema)


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The places of some texts as one array, and how many each has."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), "<i4"), np.array([len(r) // 4 for r in raw], np.int64)


def summed(patterns: DataFrame, model: Model) -> Sums:
    """The sums over all patterns, added up in the tasks and then by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(model.weights) + 2), np.int64)
        for batch in batches:
            n, p = (batch.column(c).to_numpy() for c in ("n", "p"))
            found = pattern_sums(model, *unpacked(batch.column("places")), n, p)
            total += found.texts, found.positives
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.shape[1], dtype=np.int32)), *map(pa.array, total)], names=["place", "n", "p"])

    rows = patterns.mapInArrow(run, "place int, n long, p long")
    found = rows.groupBy("place").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).toArrow()
    total = np.zeros((2, len(model.weights) + 2), np.int64)
    total[:, found.column("place").to_numpy()] = found.column("n").to_numpy(), found.column("p").to_numpy()
    return Sums(*total)


def toxicity(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id and score, the probability that a text with these places is toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(model.scores(*unpacked(batch.column("places"))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), score], names=["doc_id", "score"])

    schema = T.StructType([rows.schema["doc_id"]]).add("score", "double")
    return rows.select("doc_id", "places").mapInArrow(run, schema)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    learn: Callable[[Column], Column] = lambda ident: crc_mod(ident, 5) != 0,
    max_positives: int = 6_000,
    threshold: float = 0.5,
    least: float = 4.0,
) -> DataFrame:
    """Return doc_id, held_out, score and predicted, one row per document.

    Labels are read for ids that ``learn`` picks only; by default those whose
    crc32 of the id as text is no multiple of 5.  ``max_positives`` bounds, about,
    the labelled texts that are learned from; ``least`` is for ``telling``.
    """
    marked = labels.groupBy(F.col("doc_id").alias("l_")).agg(F.max("toxic").alias("toxic")).where(F.col("l_").isNotNull() & learn(F.col("l_")))
    toxic, total = marked.agg(F.count_if(F.col("toxic") == 1), F.count("toxic")).first()
    prior = min(max(toxic / max(total, 1), 1e-3), 0.999)
    lot = F.pmod(F.xxhash64(F.lit("lot"), "l_"), F.lit(LOTS))
    rows = marked_texts(docs, marked.where((F.col("toxic") == 1) & (lot < share(max_positives, toxic))).select("l_"), learn, id_col, text_col)
    counts, found = bucket_counts(rows)
    texts, n = int(counts[-1]), int(found[-1])
    useful = telling(found[:-1], n, counts[:-1], texts, least) if n else np.zeros(FEATURES, bool)
    places = materialize(telling_places(rows, useful), "telling-places")
    patterns = places.where("used").groupBy("places").agg(F.count(F.lit(1)).alias("n"), F.count_if("positive").alias("p"))
    patterns = materialize(patterns, "patterns")
    model = fit_nnpu(lambda at: summed(patterns, at), found[:-1][useful], n, texts, prior)
    release(patterns)
    scored = toxicity(places, model)
    return scored.select("doc_id", (~learn(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
