"""Joins whose left side may hold very many rows of one key."""

from pyspark.sql import DataFrame, functions as F

HOT_KEYS = 10_000  # keys that are split at most; the list of them is broadcast
HOT_ROWS = 100_000  # rows of a key from which it is split, and rows per part


def most_frequent(counts: DataFrame, on: list[str], keys: int, rows: int) -> DataFrame:
    """At most `keys` keys, those with the highest counts `n` of at least `rows`.

    Any other key has less than 1/keys of all rows, or less than `rows`. Mostly the
    list is empty, and runtime planning then drops the branches that depend on it.
    """
    return counts.filter(F.col("n") >= rows).orderBy(F.desc("n"), *on).limit(keys).select(*on, "n")


def count_keys(df: DataFrame, on: list[str]) -> DataFrame:
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    hot_keys: int = HOT_KEYS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi join that splits the most frequent keys of `left` over several tasks.

    The most frequent keys are found by counting; their list has at most
    `hot_keys` rows, so it can be broadcast. A key of n rows gets n / `hot_rows` salts, taken from
    the `spread_by` columns (not at random: a repeated task must repeat them);
    the matching right rows are copied once per salt. All other rows join as usual,
    and Spark still broadcasts `right` by itself if it turns out small.

    hot: (keys..., n) counts, when they are known already. how: inner or left.
    """
    counts = hot if hot is not None else count_keys(left, on)
    top = most_frequent(counts, on, hot_keys, hot_rows).select(*on, F.ceil(F.col("n") / hot_rows).cast("int").alias("_ways"))

    salt = F.pmod(F.xxhash64(*spread_by), F.coalesce("_ways", F.lit(1))).cast("int")
    salted = left.join(F.broadcast(top), on, "left").withColumn("_salt", salt).drop("_ways")
    salts = F.sequence(F.lit(0), F.coalesce("_ways", F.lit(1)) - 1)
    copied = right.join(F.broadcast(top), on, "left").withColumn("_salt", F.explode(salts)).drop("_ways")
    return salted.join(copied, [*on, "_salt"], how).drop("_salt")


def rows_without_match(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left rows whose key the right side lacks, copies included; a missing key matches nothing.

    One plain anti join: both sides come to it straight from their shuffles, so
    runtime planning splits a key with very many left rows. Distinct right keys would
    rule that out, and an anti join does not need them.
    """
    return left.join(right.select(*on), on, "left_anti")
