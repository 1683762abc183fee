"""Batch sources. All return plain DataFrames, so filters and column lists reach the scan."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

MISSING = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"}


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_path(spark: SparkSession, path: str, schema: StructType | None = None, format="parquet", **options):
    reader = spark.read.format(format).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType, format="parquet") -> DataFrame:
    """The table, or an empty one where none was written yet. Other errors stay errors."""
    try:
        return read_path(spark, path, schema, format)
    except AnalysisException as error:
        if error.getCondition() not in MISSING:
            raise
        return spark.createDataFrame([], schema)


def read_store(spark: SparkSession, format: str, **options) -> DataFrame:
    """Any connector on the class path (wide-column, document, Delta...)."""
    return spark.read.format(format).options(**options).load()


def read_jdbc(spark, url, table, key=None, lower=None, upper=None, partitions=None, **options) -> DataFrame:
    """Relational table; with a numeric `key` and its bounds it is read in parallel ranges."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if key:
        reader = reader.options(
            partitionColumn=key, lowerBound=lower, upperBound=upper, numPartitions=partitions
        )
    return reader.load()


def rows_to_df(spark: SparkSession, rows: list, schema: StructType) -> DataFrame:
    """Literal rows with a declared schema."""
    return spark.createDataFrame(rows, schema)


def pick(df: DataFrame, **wanted) -> DataFrame:
    """Rows equal to every given value; None leaves a column unrestricted.

    On partition columns this prunes directories.
    """
    return reduce(lambda kept, item: kept.filter(F.col(item[0]) == F.lit(item[1])),
                  [item for item in wanted.items() if item[1] is not None], df)


def union_periods(parts: list[DataFrame]) -> DataFrame:
    """One relation from per-period ones, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
