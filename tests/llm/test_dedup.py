"""Exact deduplication, line deduplication and the n-gram join."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rowloom.llm import exact_dedup, jaccard, line_dedup

from helpers import AWKWARD, awkward, words  # noqa: I001


def test_exact_awkward(spark):
    got = exact_dedup.mark_copies(awkward(spark, AWKWARD)).collect()
    assert len(got) == len(AWKWARD)
    by_text = collections.defaultdict(list)
    for i, t in AWKWARD:
        by_text[t or ""].append(i)
    for row in got:
        group = next(ids for t, ids in by_text.items() if hashlib.sha256(t.encode()).digest() == bytes(row.digest))
        assert row.group_size == len(group)
        assert row.keep_id == max((i for i in group if i is not None), default=None)
    assert sum(row.kept for row in got) == len(by_text)


def test_exact_keeps_columns_and_one_of_each(spark):
    docs = awkward(spark, AWKWARD)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted({t or "" for _, t in AWKWARD})


def test_exact_survives_colliding_digests(spark):
    docs = awkward(spark, [(1, "a"), (2, "b"), (3, "a"), (4, "c"), (5, "b")])
    clash = lambda text: F.when(text == "c", F.lit(b"1")).otherwise(F.lit(b"0"))
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.mark_copies(docs, digest=clash).collect()}
    assert got == {1: (3, 2, False), 3: (3, 2, True), 2: (5, 2, False), 5: (5, 2, True), 4: (4, 1, True)}
    assert sorted(r.doc_id for r in exact_dedup.drop_copies(docs, digest=clash).collect()) == [3, 4, 5]


def test_exact_hot_group(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_dedup.mark_copies(docs).where("group_size > 1").agg(F.count("*"), F.max("keep_id"), F.count_if("kept")).first()
    assert tuple(got) == (1000, 2997, 1)


@pytest.mark.parametrize("run", [exact_dedup.mark_copies, exact_dedup.drop_copies, line_dedup.drop_shared_lines, jaccard.similar_documents, jaccard.drop_similar])
def test_empty_tables(spark, run):
    assert run(awkward(spark, [])).collect() == []


def lines_by_hand(rows):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    order = lambda i: (i is None, i or 0)
    holders = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    result = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or i == min(holders[key(x)], key=order)]
        result.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(result, key=repr)


def test_lines_by_hand(spark, rows):
    texts = [*AWKWARD, (9, "  Shared LINE of text\nown line number nine\nshared line of text"), (10, "shared line of text \t\n\n"), (11, "shared line of text"), (None, "own line number nine\nÉCOLE une ligne"), (12, "école une ligne\nÉCOLE une ligne"), (12, "a second row of twelve\nécole une ligne")]
    got = line_dedup.drop_shared_lines(awkward(spark, texts)).select("doc_id", "text", "n_lines", "n_dropped")
    assert rows(got) == lines_by_hand(texts)


def similar_by_hand(rows, threshold=0.8):
    sets = []
    for i, t in rows:
        w = (t or "").encode().split()
        k = min(5, len(w))
        sets.append((i, frozenset(tuple(w[a : a + k]) for a in range(len(w) - k + 1)) if w else frozenset()))
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    links = collections.defaultdict(list)
    for a, (_, s) in enumerate(sets):
        for b, (_, t) in enumerate(sets):
            if a != b and s and len(s & t) >= threshold * len(s | t):
                links[a].append(b)
                up[root(a)] = root(b)
    result = []
    for a, (i, s) in enumerate(sets):
        group = [sets[b][0] for b in range(len(sets)) if root(b) == root(a)]
        known = [x for x in group if x is not None]
        result.append((i, min(known, default=None) if s else i, len(links[a]), len({sets[b][1] for b in links[a]} - {s})))
    return sorted(result, key=repr)


def families(seed, count, size):
    rng, rows = random.Random(seed), []
    for _ in range(count):
        base = [f"v{rng.randrange(4000)}" for _ in range(rng.choice([8, 40, 200]))]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                text[rng.randrange(len(text))] = f"n{rng.randrange(9)}"
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("texts", [AWKWARD, families(1, 12, 8), families(2, 2, 60)])
def test_similar_by_hand(spark, rows, texts):
    got = jaccard.similar_documents(awkward(spark, texts)).select("doc_id", "class_id", "n_links", "n_text_links")
    assert rows(got) == similar_by_hand(texts)


def test_similar_in_many_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 300)
    texts = families(3, 3, 40)
    got = jaccard.similar_documents(awkward(spark, texts)).select("doc_id", "class_id", "n_links", "n_text_links")
    assert rows(got) == similar_by_hand(texts)


def test_similar_keeps_one_per_class(spark):
    docs = awkward(spark, [*families(4, 3, 5), (90, ""), (91, None), (92, words(80, "z"))])
    kept = jaccard.drop_similar(docs)
    classes = {r.class_id for r in jaccard.similar_documents(docs).collect()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == classes


def test_pruning_bound():
    needed = jaccard.needed_matches(0.8)
    assert all(0 < m < 0.8 * n for n, m in needed.items())
    # The posterior after one match fewer is below the tolerance; by summing the binomial outright.
    from math import comb

    for n, m in needed.items():
        chance = lambda k, n=n: sum(comb(n + 1, i) * 0.8**i * 0.2 ** (n + 1 - i) for i in range(k + 1))
        assert chance(m - 1) < jaccard.TOLERANCE <= chance(m)


def test_components_of_chains(spark):
    edges = [(bytes([i]), bytes([i + 1])) for i in range(40)] + [(bytes([100]), bytes([101]))]
    got = jaccard.components(spark.createDataFrame(edges, "node binary, root binary")).collect()
    assert {(bytes(r.node)[0], bytes(r.label)[0]) for r in got} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}


def test_classes_without_ids(spark):
    """Rows without an id: one of each class stays, and texts meet their own set only."""
    base = words(40).split()
    near = " ".join([*base[:39], "other"])
    texts = [(None, " ".join(base)), (None, near), (None, near), (None, words(60, "q")), (7, words(60, "q")), (None, words(30, "z")), (None, ""), (None, None)]
    kept = jaccard.drop_similar(awkward(spark, texts)).collect()
    assert len(kept) == 5 and [r.text for r in kept if r.doc_id == 7] == [words(60, "q")]
    assert sum(1 for r in kept if r.text in (" ".join(base), near)) == 1
    assert sorted(r.text or "" for r in kept if r.doc_id is None)[:2] == ["", ""]
    many = awkward(spark, [(None, words(40, f"s{i}") + " tail") for i in range(300)] * 2)
    found = jaccard.similar_documents(many)
    assert found.where("copies = 2 AND n_links = 1").count() == 600
    assert len(jaccard.drop_similar(many).collect()) == 300
