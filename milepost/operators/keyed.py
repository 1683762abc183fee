"""Keyed tables: one survivor per key, and new table states after a change.

Every function returns the new state as a DataFrame; writing it is a separate
step. Keys are unique on both sides of a change, so these joins have no hot keys.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. `order` must be total for a repeatable survivor.

    Spark limits each key to its first row on the map side already
    (WindowGroupLimit), so a key with very many copies costs one row per task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def keep_latest(df: DataFrame, keys: list[str] = ("Id",), *moments: str) -> DataFrame:
    """Newest row per key by the given columns (TimeStamp if none); ties are settled by
    all other columns, so only equal rows are interchangeable."""
    moments = moments or ("TimeStamp",)
    used = {c.lower() for c in [*keys, *moments]}
    rest = [c for c in df.columns if c.lower() not in used]
    return keep_first(df, list(keys), [F.col(c).desc_nulls_last() for c in [*moments, *rest]])


def absent_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks. Copies in the target do no harm to an anti join, and
    without a fold under it runtime planning can split a key with very many source rows."""
    return source.join(target.select(*keys), keys, "left_anti")


def insert_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return target.unionByName(absent_rows(target, source, keys).select(*target.columns))


def replace_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows take the place of target rows with the same key."""
    return absent_rows(source, target, keys).unionByName(source.select(*target.columns))


def _matched(target: DataFrame, source: DataFrame, keys: list[str], how: str) -> DataFrame:
    values = [c for c in source.columns if c not in keys]
    renamed = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in values], F.lit(True).alias("_in_source"))
    return target.withColumn("_in_target", F.lit(True)).join(renamed, keys, how)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str] = (),
    add: list[str] = (),
    insert: dict[str, Column] | None = None,
) -> DataFrame:
    """Change matching rows and insert the others.

    update: columns taken from the source, on both kinds of rows
    add:    columns increased by the source (a missing side counts as zero)
    insert: values of other columns on inserted rows only; a source column of the
            same name is the default
    """
    insert = insert or {}
    joined = _matched(target, source, keys, "full_outer")

    def value(name):
        fresh = f"_new_{name}"
        if name in keys:
            return F.col(name)
        if name in update:
            return F.when(F.col("_in_source"), F.col(fresh)).otherwise(F.col(name))
        if name in add:
            return F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(fresh), F.lit(0))
        initial = insert.get(name, F.col(fresh) if name in source.columns else F.lit(None))
        return F.when(F.col("_in_target"), F.col(name)).otherwise(initial)

    return joined.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in target.schema])


def update_only(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str] = (),
    add: list[str] = (),
    touch: dict[str, Column] | None = None,
) -> DataFrame:
    """Change matching rows, insert nothing. `touch` sets audit columns on the changed rows."""
    touch = touch or {}
    joined = _matched(target, source.select(*keys, *update, *add), keys, "left")

    def value(field):
        name, hit = field.name, F.col("_in_source")
        if name in update:
            return F.when(hit, F.col(f"_new_{name}")).otherwise(F.col(name)).cast(field.dataType)
        if name in add:
            # A missing stored value stays missing, as in SQL.
            return (F.col(name) + F.coalesce(F.col(f"_new_{name}"), F.lit(0))).cast(field.dataType)
        if name in touch:
            return F.when(hit, touch[name]).otherwise(F.col(name)).cast(field.dataType)
        return F.col(name)

    return joined.select(*[value(f).alias(f.name) for f in target.schema])


def changed(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rows where the two columns differ, null counting as a value."""
    return df.filter(~F.col(new).eqNullSafe(F.col(old)))
