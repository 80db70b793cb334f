"""Mixing, the pipeline, and the registered queries against SQL and by hand."""

import collections
import hashlib
import math

import corpus_pipeline
import numpy as np
import pytest
from compare import connect, duckdb_result, spark_result
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowloom.llm import mixing
from rowloom.llm.queries import ORACLE, QUERIES

from helpers import AWKWARD, awkward, words  # noqa: I001
from test_spelling import counts_by_hand, near

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_same_result_as_sql(spark, key):
    df = QUERIES[key](spark, FOLDER)
    assert spark_result(df) == duckdb_result(connect(FOLDER), ORACLE[key])


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE) - {"op11_spelling"}))
def test_whole_table(spark, key):
    table = "pages" if key in ("op7_html", "op10_url_filter") else "documents"
    df = QUERIES[key](spark, FOLDER)
    assert df.count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


def test_spelling_of_the_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    counts = counts_by_hand(docs, 97)
    got = QUERIES["op11_spelling"](spark, FOLDER).collect()
    assert {r.word: r.n for r in got} == counts
    known = {r.word: r for r in got}
    assert all(r.form is None or (known[r.form].n == r.form_n >= 2 * r.n and near(r.word, r.form)) for r in got)
    assert all(known[r.root].form is None for r in got)


def mixed(rows):
    return [(r.doc_id, r.source, r.size, r.target, r.taken) for r in rows]


def test_mix_targets(spark):
    sizes = {"a": 30, "b": 100, "c": 400, None: 1000}
    rows = [(k, words(1), "en", s, 1) for k, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame([*rows, (9000, None, "en", "empty", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mix_sources(docs, piece=50).collect()
    taken, target = collections.Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size
    # 2295 words; a and b stop at twice their size, c too: 5, 2, 1, 5 (empty), 2 are the weights.
    assert target["a"] == 60 and target["b"] == 200 and target["c"] <= 800 and target["empty"] == 0
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)
    assert abs(sum(target.values()) - 1.5 * 1530) < 1e-6
    assert sorted(mixed(got), key=repr) == sorted(mixed(mixing.mix_sources(docs, piece=7).repartition(5).collect()), key=repr)


def test_mix_many_rows_of_one_key(spark):
    """Rows without an id, and repeated rows, are cut like others; what is taken is that of the order by hand."""
    texts = [(None, words(1 + i % 50)) for i in range(20_000)] + [(7, words(3))] * 5_000 + [(i, words(4)) for i in range(100, 1_100)]
    docs = awkward(spark, texts)
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"), mixing.random_key(F.col("doc_id")).alias("key"))
    runs = mixing._runs(sized, len(texts), 2_000)
    assert runs.agg(F.sum("rows")).first()[0] == len(texts) and runs.agg(F.max("rows")).first()[0] <= 2_000
    assert runs.groupBy("source", "piece").count().agg(F.max("count")).first()[0] <= 4_000
    key = lambda i: int(hashlib.md5(str("" if i is None else i).encode()).hexdigest()[:15], 16)
    order = sorted(((key(i), -1 if i is None else i, len(t.split())) for i, t in texts))
    total = sum(n for _, _, n in order)
    budget, wanted, before = math.floor(1.5 * total + 0.5) - total, [], 0
    for _, i, n in order:
        wanted.append((i, n, n + max(0, min(n, budget - before))))
        before += n
    for got in (mixing.mix_sources(docs), mixing.mix_sources(docs, piece=300)):
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.taken) for r in got.collect()) == sorted(wanted)


def test_mix_awkward(spark):
    docs = awkward(spark, AWKWARD)
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(AWKWARD) and sum(r.taken for r in got) == round(1.5 * sum(r.size for r in got))
    rows = mixing.mixed_documents(docs)
    assert rows.columns == docs.columns
    copies = collections.Counter(r.doc_id for r in rows.collect())
    assert copies[6] in (1, 2) and max(copies.values()) <= 4 and 1 not in copies
    assert mixing.mix_sources(awkward(spark, [])).collect() == []
    assert mixing.mixed_documents(awkward(spark, [])).collect() == []


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs.columns
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == before, name
        seen.append(docs.count())
    assert seen[0] > seen[1] >= seen[2] >= seen[3] > 0
    library = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    wanted = sorted((i, hashlib.sha256(np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()).hexdigest()) for i, t in texts)
    run = corpus_pipeline.run(spark, FOLDER).collect()
    assert len(run) == seen[-1]
    assert sorted({(r.doc_id, hashlib.sha256(bytes(r.token_ids)).hexdigest()) for r in run}) == wanted


def test_pipeline_awkward(spark):
    for texts in (AWKWARD, []):
        docs = awkward(spark, texts)
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
            assert name == "bpe_encoding" or docs.columns == columns
        assert (docs.count() > 0) == bool(texts)
