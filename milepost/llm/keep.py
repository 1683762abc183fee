"""One document of each group of near copies."""

from pyspark.sql import DataFrame, functions as F

from milepost.llm.arrow import fresh
from milepost.llm.jaccard import broadcast_if_small, jaccard_components
from milepost.session import stage


def keep_least(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component: the one with the smallest key.

    A document is its key and its text's hash, so a repeated key drops only the texts that are
    copies, and of copies without key one stays, if no copy has a key. The dropped ones are joined
    away (broadcast up to a counted size), so kept texts are not shuffled for few drops. Rows that
    repeat a key and its text stay once; null or blank texts without key are copies of nothing.
    """
    own = F.struct(F.col(f"`{key}`").isNull().alias("unkeyed"), F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("hash"))
    k = fresh("_k", docs.columns)
    found = jaccard_components(docs.select(own.alias(k), F.col(f"`{text}`").alias("_t")), k, "_t")
    found = stage(found.select(k, "component_id", (F.col("n_shingles") > 0).alias("full")), "components")
    same = own.eqNullSafe(F.col(k))
    dropped = stage(found.where(~F.col("component_id").eqNullSafe(F.col(k))).select(k).distinct(), "dropped")
    dropped = broadcast_if_small(dropped, k)
    kept = docs.join(dropped, same, "left_anti")
    again = found.where(F.col("full") | ~F.col(f"{k}.unkeyed")).groupBy(k).count().where("count > 1").select(k)
    again = stage(again, "again")
    if again.isEmpty():
        return kept
    return kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates([key, text]))
