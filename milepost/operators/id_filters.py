"""Bloom filters of the Ids in each directory, so that a search of a whole table opens few files.

Any column can have filters, such as the phone for look-ups by member. They are written below
`<table>/_filters/<column>`, and from then on kept by every append.

The filters are rows beside the table: bitmaps of BITS bits per (directory, block). A block is
chosen by one hash of the Id, and PROBES of its bits by others, so looking up an Id
takes one bitmap per directory. They are made of Spark's bitmap aggregates: folded in each task, and no
directory gathers in one. Every write adds rows for what it adds; rows are written before the
data, so a filter may know an Id that is not there, but never the other way round.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from milepost.schemas import layout
from milepost.session import list_folder, write_parquet
from milepost.sources.tables import read_or_empty

BITS = 4096 * 8  # of one bitmap, as Spark's bitmap functions make them
PROBES = 6
IDS_PER_BLOCK = BITS // 16  # 16 bits per Id: about one Id in a thousand is taken for another
FIRST_KEYS = 50_000  # keys of a large batch that are put to all directories
_FIELDS = "_blocks int, _block int, _bits binary"


def filters_of(path: str, key: str) -> str:
    return f"{path}/_filters/{key}"


def filtered_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns of a table that have filters."""
    return [c for c in list_folder(spark, f"{path}/_filters") if not c.startswith((".", "_"))]


def _hash(key: str, kind: int) -> Column:
    return F.xxhash64(F.col(key), F.lit(kind))


def block_of(key: str, blocks: Column) -> Column:
    return F.pmod(_hash(key, 0), blocks).cast("int")


def probes(key: str) -> list[Column]:
    """Bit positions of an Id within its block: 15 bits each, four from a hash."""
    return [F.shiftrightunsigned(_hash(key, 1 + i // 4), 15 * (i % 4)).bitwiseAND(F.lit(BITS - 1)).cast("int") for i in range(PROBES)]


def filter_rows(rows: DataFrame, key: str, by: list[str]) -> DataFrame:
    """(by, _blocks, _block, _bits) of the Ids in `rows`; the number of blocks is a power of two that
    suits a directory's rows."""
    known = rows.select(key, *by).filter(F.col(key).isNotNull())
    # One row per directory: broadcast, so the Ids stay where they are.
    sizes = known.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).withColumnsRenamed({c: f"_of_{c}" for c in by})
    blocks = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.ceil(F.col("_n") / IDS_PER_BLOCK), F.lit(1))))).cast("int")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by])
    placed = known.join(F.broadcast(sizes.withColumn("_blocks", blocks)), same).select(key, *by, "_blocks")
    bits = placed.select(*by, "_blocks", block_of(key, F.col("_blocks")).alias("_block"), F.explode(F.array(*probes(key))).alias("_bit"))
    return bits.groupBy(*by, "_blocks", "_block").agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def add_filters(rows: DataFrame, path: str, key: str, by: list[str]) -> None:
    write_parquet(filter_rows(rows, key, by), filters_of(path, key), mode="append")


def has_bit(bits: str, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(at, F.lit(8))) == 1


def directories_with(keys: DataFrame, path: str, schema: StructType, key: str, by: list[str]) -> list[tuple]:
    """The directories (values of `by`) whose filters know one of the keys.

    The keys meet the bitmaps of their block: as many rows as keys and directories, each asked for
    single bits. So about FIRST_KEYS keys go first, and the rest only meets the directories that these
    have not named; what is named is the same.
    """
    spark = keys.sparkSession
    kinds = ", ".join(f"{c} {schema[c].dataType.simpleString()}" for c in by)
    filters = read_or_empty(spark, filters_of(path, key), layout(f"{kinds}, {_FIELDS}"))
    sizes = [r[0] for r in filters.select("_blocks").distinct().collect()]  # powers of two
    if not sizes:
        return []
    wanted = keys.select(F.col(key).alias("_key")).filter(F.col(key).isNotNull()).distinct()
    several = filters.select(*by).distinct().count() > 1
    parts = max(1, -(-wanted.count() // FIRST_KEYS)) if several else 1
    some = F.pmod(_hash("_key", 9), F.lit(parts)) == 0
    found = _meeting(filters, wanted.filter(some), sizes, by)
    if parts == 1:
        return found
    # The other keys are put to the directories that none of the first has met.
    hit = spark.createDataFrame(found, layout(kinds))
    same = reduce(Column.__and__, [F.col(f"f.{c}").eqNullSafe(F.col(f"h.{c}")) for c in by])
    left = filters.alias("f").join(F.broadcast(hit).alias("h"), same, "left_anti")
    return found + _meeting(left, wanted.filter(~some), sizes, by)


def _meeting(filters: DataFrame, wanted: DataFrame, sizes: list[int], by: list[str]) -> list[tuple]:
    """The directories of `filters` that know one of the keys."""
    wanted = wanted.select(F.explode(F.array(*map(F.lit, sizes))).alias("_of"), "_key", *[p.alias(f"_p{i}") for i, p in enumerate(probes("_key"))])
    wanted = wanted.withColumn("_in", block_of("_key", F.col("_of")))
    met = filters.join(wanted, (F.col("_blocks") == F.col("_of")) & (F.col("_block") == F.col("_in")))
    hit = reduce(Column.__and__, [has_bit("_bits", F.col(f"_p{i}")) for i in range(PROBES)])
    return [tuple(r) for r in met.filter(hit).select(*by).distinct().collect()]
