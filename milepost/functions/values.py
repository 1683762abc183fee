"""Scalar rules of the domain, all as built-in column expressions."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from milepost.schemas import DEFAULT_TIER, DEVICE_PREFIX, MAX_LEVEL, TIER_NAMES


def tier_name(code: Column, names: Mapping[str, str] = TIER_NAMES) -> Column:
    """Display name of a tier; unknown and missing codes get the lowest tier's."""
    default, *others = names.items()
    result = F.when(F.lit(False), default[1])
    for key, name in others:
        result = result.when(code == key, name)
    return result.otherwise(default[1])


def first_rule(rules: list[tuple[Column, str]], default: str = DEFAULT_TIER) -> Column:
    """Code of the first rule that holds."""
    return F.coalesce(*[F.when(holds, F.lit(code)) for holds, code in rules], F.lit(default))


def device_id(imei: Column, prefix: str = DEVICE_PREFIX) -> Column:
    """Number part of a prefixed IMEI without leading zeros, null for others."""
    return F.when(imei.startswith(prefix), F.ltrim(F.substring(imei, len(prefix) + 1, 2**31 - 1), F.lit("0")))


def whole_km(metres: Column) -> Column:
    """Whole kilometres as text; missing distances count as zero."""
    return F.coalesce((metres / 1000).cast("bigint").cast("string"), F.lit("0"))


def level_threshold(level: int) -> int:
    """Points needed for a level. 0, 50, then 150 x (n - 2) more for level n."""
    return 0 if level <= 1 else 50 + 75 * (level - 1) * (level - 2)


def level_for(points: Column, max_level: int = MAX_LEVEL) -> Column:
    """Highest level whose threshold is reached: the thresholds solved for n.

    The root only proposes a level; exact integer comparisons settle it.
    """
    points = F.coalesce(points, F.lit(0)).cast("bigint")
    capped = F.least(points, F.lit(level_threshold(max_level)).cast("bigint"))

    def needed(level):
        return 50 + 75 * (level - 1) * (level - 2)

    guess = F.floor((F.sqrt((capped - 50) / 18.75 + 1) + 3) / 2).cast("bigint")
    settled = F.when(needed(guess) > capped, guess - 1).when(needed(guess + 1) <= capped, guess + 1).otherwise(guess)
    return F.when(points < level_threshold(2), 1).otherwise(F.least(settled, F.lit(max_level))).cast("int")


def level_table(spark, max_level: int = MAX_LEVEL) -> DataFrame:
    """(level, points_from, points_below): the thresholds as rows."""
    n = F.col("id")
    low = F.when(n == 1, 0).otherwise(50 + 75 * (n - 1) * (n - 2))
    high = F.when(n < max_level, 50 + 75 * n * (n - 1))
    return spark.range(1, max_level + 1).select(
        n.cast("int").alias("level"), low.alias("points_from"), high.alias("points_below")
    )


def hashed_uuid(*parts: Column) -> Column:
    """UUID-shaped id that depends on its parts only, so replays repeat it."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.regexp_replace(F.md5(text), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def document_key(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.concat_ws(":", *parts))


def epoch_seconds(moment: Column, missing: Column) -> Column:
    return F.coalesce(F.unix_timestamp(moment), missing)


def lower_names(df: DataFrame) -> DataFrame:
    """All column names in lower case, in one projection."""
    return df.toDF(*[name.lower() for name in df.columns])


def tolerant(df: DataFrame, name: str, default) -> Column:
    """A column, or a default where the input lacks it or holds null."""
    known = {c.lower() for c in df.columns}
    default = F.lit(default)
    return (F.coalesce(F.col(name), default) if name.lower() in known else default).alias(name)
