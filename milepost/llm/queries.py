"""The operators over the given tables, as registered queries."""

from pyspark.sql import functions as F

from milepost.llm import decontaminate, divergence, gam, jaccard, lm, packing, passages, quality_rules, shards, token_counts, token_files, vector_codes, warc


def tokenizer(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_harmonic_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"), end_id=1)


def op2_jaccard_join(spark, folder):
    return jaccard.jaccard_components(table(spark, folder, "documents").select("doc_id", "text"))


def op3_quality_rules(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    judged = quality_rules.quality_rules(docs)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *base, "base_failed", "kept")


def op4_pfor_files(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    manifest = token_files.write_tokens(docs, tokenizer("byte_bpe_50k.json"), end_id=2)
    return token_files.read_tokens(manifest, "bigint")


def op5_token_counts(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, tokenizer("word_bpe_49k.json"))


def op6_warc_index(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    archive, index = warc.write_archive(pages)
    return warc.look_up(archive, index, pages)


def op7_decontamination(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.contamination(docs, table(spark, folder, "benchmark"))


def op8_deleted_interpolation(spark, folder):
    return lm.score(table(spark, folder, "documents").select("doc_id", "text"))


def op9_best_fit_shards(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    # A null text is equal to none.
    group = F.when(F.col("text").isNull(), F.xxhash64("doc_id", F.lit(1))).otherwise(F.xxhash64("text"))
    crc = F.crc32(F.coalesce("text", F.lit("")))
    placed = shards.shard_by_best_fit(docs, size, group, shards=40, more={"text_crc32": crc})
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_quality_classifier(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = gam.score(docs, gam.train(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", gam.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_prefix_doubling(spark, folder):
    return passages.remove_repeats(table(spark, folder, "documents")).drop("spans")


def op12_cover_tree_codes(spark, folder):
    return vector_codes.compress(table(spark, folder, "embeddings"))


def op13_source_audit(spark, folder):
    return divergence.audit_sources(table(spark, folder, "documents"))


REGISTERED = {
    f.__name__: f
    for f in (
        op1_harmonic_packing, op2_jaccard_join, op3_quality_rules, op4_pfor_files, op5_token_counts, op6_warc_index,
        op7_decontamination, op8_deleted_interpolation, op9_best_fit_shards, op10_quality_classifier, op11_prefix_doubling, op12_cover_tree_codes, op13_source_audit,
    )
}
