"""The stages against plain versions, and what is registered."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from milepost.llm import gam
from milepost.llm.oracle import ORACLE
from milepost.llm.queries import REGISTERED, table
from tests.compare import connect, difference
from tests.llm.test_corpus import brute_hits
from tests.llm.test_jaccard import brute
from tests.llm.test_quality import brute as counts_of

FOLDER = "/root/testdata/sf0.01"


def test_registered():
    names = __spark_entry__.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in REGISTERED} and REGISTERED.keys() <= names.keys()
    assert "pipeline" in names and ORACLE.keys() <= REGISTERED.keys()


def test_stages_in_turn(spark):
    docs = before = table(spark, FOLDER, "documents")
    kept = {}
    for i, (name, step) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = step(spark, before, FOLDER).cache()
        assert docs.columns == table(spark, FOLDER, "documents").columns
        kept[i] = before.collect(), docs.collect()
        before = docs
    # rules: everything kept comes from the input, unchanged, and labelled good prose that passes the fixed base rule stays
    given, after = kept[0]
    ids = {r.doc_id for r in after}
    good = {r.doc_id for r in table(spark, FOLDER, "labels").where("quality = 1").collect()}
    passes = lambda n, *rest: n >= 10 and 100 * rest[3] <= 20 * n
    assert set(after) <= set(given) and all(r.doc_id in ids for r in given if r.doc_id in good and passes(*counts_of(r.text)))
    # classifier: the scores decide
    given, after = kept[1]
    model = gam.train(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    scores = gam.score(spark.createDataFrame(given), model, keep_text=False)
    assert {r.doc_id for r in scores.where("score >= 0.7").collect()} == {r.doc_id for r in after}
    # near copies: one of each component
    given, after = kept[2]
    assert {r.doc_id for r in after} == {least for _, _, least in brute([(r.doc_id, r.text) for r in given])}
    # benchmark passages
    given, after = kept[3]
    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    verdict = {r.doc_id: brute_hits(r.text, items) for r in given}
    assert {r.doc_id for r in after} == {k for k, v in verdict.items() if not v[4]}
    assert all(r.n_chars == len(r.text) for r in after if verdict[r.doc_id][1])
    # packing: every kept document once
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, FOLDER)
    assert pieces.select("doc_id").distinct().count() == len(after)
    assert corpus_pipeline.run(spark, FOLDER).count() == pieces.count()


def test_stages_on_an_empty_table(spark):
    docs = table(spark, FOLDER, "documents").limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, FOLDER).collect() == []


def test_stages_keep_clashing_columns(spark):
    given = table(spark, FOLDER, "documents").limit(150)
    names = ["_score", "score", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "_rest", "_k", "kept", "base_failed", "_g0", "hash"]
    docs = given.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names]).cache()
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, FOLDER)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names)
        assert {r.doc_id for r in rows} == {r.doc_id for r in step(spark, docs.select(given.columns), FOLDER).collect()}


def test_stages_on_nulls_and_repeats(spark):
    long = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    rows = [(None, None, None, None), (1, "", "en", None), (1, long, None, "s"), (1, long, None, "s"), (None, long, "en", "s"), (2, "x", "", "")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    counts = [step(spark, docs, FOLDER).count() for _, step in corpus_pipeline.STAGES[:-1]]
    assert counts[0] <= 3 and counts[2] == 4 and counts[3] == 6
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert pieces.groupBy("doc_id").sum("length").count() == 3


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    assert difference(REGISTERED[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) is None
