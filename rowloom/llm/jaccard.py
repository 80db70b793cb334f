"""Join documents whose sets of five-word shingles are similar, and group them.

Equal sets are one node from the start.  Every node gets MinHash values; bands
of them make buckets, and two sets with a similarity of 0.8 miss each other in
all 53 bands of 6 with a probability of 1e-7.  Buckets with the same members
are compared once.  A bucket is cut into blocks of a bounded number of
shingles, and a task compares two blocks: a pair belongs to the first band
that it shares, MinHash values are compared 32 at a time, and the pair is
dropped as soon as the posterior probability (uniform prior) that its
similarity reaches the threshold is below ``TOLERANCE``.  What is left is
verified on the sets.  A task returns a row per node, its number of links and
one edge of a spanning forest, never pairs.  The edges are joined to classes.

Defined cases.  NULL texts are empty; an empty set is similar to nothing, each
such document is a class of its own.  Texts of one to four words are one
shingle.  Words are compared byte by byte.  Rows that repeat an id are
compared by their own texts; ``class_id`` is the smallest id of the class, NULL
only if it has no other.  Empty tables give empty results.  Texts are read
whole; a task holds two blocks, or the two longest texts if they are more.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from rowloom.llm.common import each_salt, free_names, raw_text, salt_of, salts_seen, whole_text
from rowloom.session import materialize

WORDS = 5
BANDS, ROWS = 53, 6
#: Shingles per block, and as how many shingles the signature and band keys of a set count: a block takes about 8 MB.
BLOCK, SET = 1_000_000, 240
#: Posterior probability below which a pair is dropped, and MinHash values compared at a time.
TOLERANCE, STEP = 1e-7, 32
MEMO = 200_000
_rng = np.random.default_rng(20)
TIMES = _rng.integers(1, 2**31, BANDS * ROWS).astype(np.uint32) * np.uint32(2) + np.uint32(1)
PLUS = _rng.integers(0, 2**32, BANDS * ROWS).astype(np.uint32)
POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 2**64) for k in range(1, max(WORDS, ROWS) + 1)], np.uint64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes) -> np.ndarray:
    """The sorted hashes of the different shingles of a text."""
    words = text.split()
    hashes = np.fromiter(map(word_hashes().__getitem__, words), np.uint64, len(words))
    if not len(hashes):
        return hashes
    width = min(WORDS, len(hashes))
    count = len(hashes) - width + 1
    sums = np.full(count, width, np.uint64)
    for k in range(width):
        sums += hashes[k : k + count] * POWERS[k]
    return np.unique(_mixed(sums))


def signature(found: np.ndarray) -> np.ndarray:
    """The MinHash values of a set that is not empty."""
    low = np.full(BANDS * ROWS, 2**32 - 1, np.uint32)
    plain = (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(plain), 2048):
        low = np.minimum(low, (np.multiply.outer(TIMES, plain[at : at + 2048]) + PLUS[:, None]).min(axis=1))
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """Keys of the bands of one signature or of several; the band stands above a 56-bit hash, so keys sort by it."""
    parts = low.reshape(*low.shape[:-1], BANDS, ROWS).astype(np.uint64)
    hashed = _mixed((parts * POWERS[:ROWS]).sum(axis=-1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
    return ((np.arange(BANDS, dtype=np.uint64) << np.uint64(56)) | (hashed >> np.uint64(8))).astype(np.int64)


def set_digest(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def described(text_col: str) -> Column:
    """A struct of a text's set digest, number of shingles and band keys."""

    def run(batch: pa.Array) -> pa.Array:
        sets = [shingles(text) for text in batch.to_pylist()]
        keys = [band_keys(signature(s)) if len(s) else np.zeros(0, np.int64) for s in sets]
        ends = np.cumsum([0, *map(len, keys)])
        bands = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *keys])))
        parts = [pa.array([set_digest(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int32()), bands]
        return pa.StructArray.from_arrays(parts, names=["digest", "size", "bands"])

    return arrow_udf(run, "digest binary, size int, bands array<long>")(raw_text(text_col))


def needed_matches(threshold: float, tolerance: float = TOLERANCE) -> dict[int, int]:
    """The fewest matches among the first n MinHash values with which a pair stays.

    After m matches of n the similarity has a Beta(m + 1, n - m + 1)
    distribution; the chance that it reaches the threshold is that of at most
    m heads in n + 1 throws of a coin with that chance of a head.
    """
    needed = {}
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        chance = term = (1 - threshold) ** (n + 1)
        m = 0
        while chance < tolerance:
            m += 1
            term *= (n + 2 - m) / m * threshold / (1 - threshold)
            chance += term
        needed[n] = m
    return needed


class Forest:
    """Union of sets with the smallest number as root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = sorted((self.root(i), self.root(j)))
        self.up[j] = i


def compare_blocks(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray | None, band: int, threshold: float):
    """Yield (i, partners) for the similar pairs of two blocks, or inside one, that first meet in ``band``."""
    lows = np.stack([signature(s) for s in sets])
    keys, sizes = band_keys(lows), np.array([len(s) for s in sets])
    flat, ends = np.concatenate(sets), np.cumsum(sizes)
    needed = needed_matches(threshold)
    for place, i in enumerate(left):
        others = left[place + 1 :] if right is None else right
        smaller, larger = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[smaller >= threshold * larger - 1e-9]
        others = others[~(keys[others, :band] == keys[i, :band]).any(axis=1)]
        matches = np.zeros(len(others), np.int64)
        for n, least in needed.items():
            if not len(others):
                break
            matches += (lows[others, n - STEP : n] == lows[i, n - STEP : n]).sum(axis=1)
            stays = matches >= least
            others, matches = others[stays], matches[stays]
        if not len(others):
            continue
        own = sizes[others]
        at = np.repeat(ends[others] - np.cumsum(own), own) + np.arange(own.sum())
        places = np.minimum(np.searchsorted(sets[i], flat[at]), sizes[i] - 1)
        common = np.add.reduceat((sets[i][places] == flat[at]).astype(np.int64), np.cumsum(own) - own)
        found = others[common * (1 + threshold) >= threshold * (own + sizes[i]) - 1e-9]
        if len(found):
            yield i, found


def _linked(threshold: float):
    """Compare the texts of two blocks of a bucket; a row per node that has links."""

    def run(table: pa.Table) -> pa.Table:
        key, p, q = (table.column(c)[0].as_py() for c in ("key", "p", "q"))
        nodes: dict[bytes, tuple[np.ndarray, int, int]] = {}
        for digest, block, copies, text in zip(*(table.column(c).to_pylist() for c in ("digest", "block", "copies", "text")), strict=True):
            found = shingles(text)
            if set_digest(found) == digest:  # an id may stand for several texts
                nodes[digest] = (found, block, copies)
        digests = sorted(nodes)
        sets, blocks, copies = zip(*(nodes[d] for d in digests), strict=True) if nodes else ((), (), ())
        blocks, copies = np.array(blocks), np.array(copies, np.int64)
        texts, docs, forest = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64), Forest(len(sets))
        left, right = np.flatnonzero(blocks == p), None if p == q else np.flatnonzero(blocks == q)
        for i, partners in compare_blocks(list(sets), left, right, key >> 56, threshold) if len(left) and len(sets) > 1 else ():
            texts[i] += len(partners)
            docs[i] += copies[partners].sum()
            texts[partners] += 1
            docs[partners] += copies[i]
            for j in partners.tolist():
                forest.join(int(i), j)
        some = np.flatnonzero(texts).tolist()
        rows = {"node": [digests[i] for i in some], "root": [digests[forest.root(i)] for i in some], "texts": texts[some], "docs": docs[some]}
        return pa.table(rows, pa.schema([("node", pa.binary()), ("root", pa.binary()), ("texts", pa.int64()), ("docs", pa.int64())]))

    return run


def components(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node of its component, for edges (node, root).

    Each round takes the smallest label among neighbours and follows labels
    once more; every round is written to the shared folder.
    """
    both = edges.select("node", F.col("root").alias("other")).union(edges.select(F.col("root").alias("node"), F.col("node").alias("other"))).distinct()
    both = materialize(both, "edges")
    labels = materialize(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("other"), "label"), "other").select("node", "label")
        nearest = seen.union(labels).groupBy("node").agg(F.min("label").alias("label"))
        follow = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        found = nearest.join(follow, "label").select("node", F.least("label", "next").alias("label"))
        found = materialize(found, "labels")
        changed = found.join(labels, ["node", "label"], "left_anti")
        if changed.isEmpty():
            return found
        labels = found


def _classes(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest, size) of every row, and the classes and links of every set of shingles that is not empty."""
    known = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(whole_text(text_col)).alias("text_key"), described(text_col).alias("d"))
    known = materialize(known.select("doc_id", "text_key", "d.*"), "shingle-sets")
    # A text stands for its set: that of the smallest id, and of rows without one that of the smallest hash.
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first")
    sets = known.where("size > 0").groupBy("digest").agg(
        first, F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("bands").alias("bands")
    )
    sets = sets.select("digest", F.col("first.doc_id").alias("rep"), F.col("first.text_key").alias("rep_key"), "copies", "size", "bands")
    nodes = _linked_nodes(docs, id_col, text_col, threshold, sets)
    return known.select("doc_id", "digest", "size"), nodes


def _linked_nodes(docs: DataFrame, id_col: str, text_col: str, threshold: float, sets: DataFrame) -> DataFrame:
    """digest, label, class_id, copies, n_links and n_text_links of each set; ``label`` names the class, whatever its ids."""
    sets = materialize(sets.withColumn("node", F.xxhash64("digest")), "distinct-sets")
    bands = sets.select("node", "size", F.explode("bands").alias("key"), salt_of(F.col("node")).alias("salt"))
    # Tasks combine their rows of a bucket before the shuffle; the members come back by key and salt.
    member = {"n": F.count(F.lit(1)), "f": F.bit_xor(F.xxhash64("node")), "g": F.bit_xor(F.xxhash64(F.lit(1), "node")), "total": F.sum(F.col("size") + SET)}
    buckets = bands.groupBy("key").agg(*(c.alias(n) for n, c in member.items()), salts_seen().alias("salts"))
    once = buckets.where("n > 1").groupBy("n", "f", "g", "total").agg(F.min("key").alias("key"), F.bit_or("salts").alias("salts"))
    once = once.select("key", F.ceil(F.col("total") / BLOCK).cast("int").alias("blocks"), each_salt("salts").alias("salt"))
    members = bands.join(once, ["key", "salt"]).withColumn("block", F.pmod(F.xxhash64(F.lit(2), "node"), F.col("blocks")).cast("int"))
    members = materialize(members.select("key", "node", "block", "blocks"), "bucket-members")
    wanted = sets.join(members.select("node").distinct(), "node").select("node", "digest", "rep", "rep_key", "copies")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(whole_text(text_col)).alias("text_key"), raw_text(text_col).alias("text"))
    texts = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("text_key") == F.col("rep_key")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("c")
    tasks = members.select("key", "node", "block", other)
    tasks = tasks.select("key", F.least("block", "c").alias("p"), F.greatest("block", "c").alias("q"), "node", "block")
    loaded = tasks.join(texts.select("node", "digest", "copies", "text"), "node").drop("node")
    links = loaded.groupBy("key", "p", "q").applyInArrow(_linked(threshold), "node binary, root binary, texts long, docs long")
    links = materialize(links, "links")
    labels = components(links.where("node != root").select("node", "root"))
    counts = links.groupBy(F.col("node").alias("digest")).agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    nodes = sets.select("digest", "rep", "copies").join(counts, "digest", "left").join(labels.withColumnRenamed("node", "digest"), "digest", "left")
    nodes = nodes.withColumn("label", F.coalesce("label", "digest"))
    classes = nodes.groupBy("label").agg(F.min("rep").alias("class_id"))
    nodes = nodes.join(classes, "label").select("digest", "label", "class_id", "copies", (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_text_links"))
    return materialize(nodes, "similar-nodes")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """Return doc_id, class_id, n_links, n_text_links and copies, one row per document.

    ``class_id`` names the class of documents that links connect, by its
    smallest id.  ``n_links`` counts the other documents whose similarity
    reaches ``threshold``, copies included; ``n_text_links`` counts the other
    sets among them, and ``copies`` the documents with the same set.
    """
    known, nodes = _classes(docs, id_col, text_col, threshold)
    found = known.join(nodes, "digest", "left")
    none = F.col("size") == 0
    return found.select(
        "doc_id",
        F.when(none, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_text_links", F.lit(0)).cast("long").alias("n_text_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
    )


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """The document with the smallest id of each class, with all its columns; rows that repeat an id stay together.

    Of a class of rows without an id one row stays.
    """
    known, nodes = _classes(docs, id_col, text_col, threshold)
    name, digest, size, label = free_names(docs, "kept_id", "digest_", "size_", "label_")
    found = known.where(F.col("doc_id").isNotNull()).join(nodes.select("digest", "class_id"), "digest", "left")
    own = (F.col("size") == 0) | (F.col("doc_id") == F.col("class_id"))
    kept = found.where(own).select(F.col("doc_id").alias(name)).distinct()
    named = docs.join(kept, F.col(id_col) == F.col(name), "left_semi")
    nameless = docs.where(F.col(id_col).isNull())
    if nameless.isEmpty():
        return named
    rows = nameless.withColumn(digest, described(text_col)).withColumns({size: F.col(f"{digest}.size"), digest: F.col(f"{digest}.digest")})
    classes = nodes.where(F.col("class_id").isNull()).select(F.col("digest").alias(digest), F.col("label").alias(label))
    first = Window.partitionBy(label).orderBy(digest, F.xxhash64(whole_text(text_col)))
    alone = rows.where(F.col(size) == 0).select(*(F.col(f"`{c}`") for c in docs.columns))
    one = rows.where(F.col(size) > 0).join(classes, digest).withColumn(name, F.row_number().over(first)).where(F.col(name) == 1)
    return named.unionAll(alone).unionAll(one.select(*(F.col(f"`{c}`") for c in docs.columns)))
