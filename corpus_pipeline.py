"""The corpus pipeline: from raw documents to packed token sequences.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept, which was
written as Parquet and read again. All but the last return the columns of `documents`, and
further columns of the input unchanged, whatever they are called. An empty table stays empty.
A null text fails the rules; handed to a later stage it counts as empty and is kept as it is,
unless its score is too low. Ties and repeated rows are judged alike, but of near copies one stays.
"""

from pyspark.sql import functions as F

from milepost.llm import decontaminate, gam, keep, packing, quality_rules
from milepost.llm.arrow import fresh, set_aside
from milepost.llm.queries import table, tokenizer
from milepost.session import stage

LEAST_SCORE = 0.7  # documents scored lower are rejected
END_ID = 1


def keep_by_rules(spark, docs, sf_dir):
    """Operator 3: documents that the base rules or the adaptive thresholds reject go."""
    return quality_rules.apply_rules(docs)


def keep_by_classifier(spark, docs, sf_dir):
    """Operator 10, fitted on the labelled documents: documents scored under LEAST_SCORE go."""
    model = gam.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    score = fresh("_score", docs.columns)
    scored = gam.score(docs, model, keep_text=True, name=score)
    return scored.where(F.col(score) >= LEAST_SCORE).select(docs.columns)


def keep_one_of_each_group(spark, docs, sf_dir):
    """Operator 2: of documents linked by near copies, the one with the smallest id stays."""
    return keep.keep_least(docs)


def without_benchmark(spark, docs, sf_dir):
    """Operator 7: contaminated documents go; hit spans below that limit are cut out."""
    safe, back = set_aside(docs, decontaminate.RESULTS)
    found = decontaminate.contamination(safe, table(spark, sf_dir, "benchmark"), cut_spans=True)
    kept = found.where(~F.col("contaminated"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("n_hit") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return kept.select(safe.columns).withColumnsRenamed(back)


def packed(spark, docs, sf_dir):
    """Operator 1: the pieces of the token sequences."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"), end_id=END_ID)


STAGES = [
    ("quality rules", keep_by_rules),
    ("quality classifier", keep_by_classifier),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]

ORACLE_SQL = None  # a trained classifier and a tokenizer; see tests/llm/test_pipeline.py


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
