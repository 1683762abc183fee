"""Writing tables, slices of tables, messages and serving documents."""

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from milepost.operators.id_filters import add_filters, directories_with, filtered_columns
from milepost.session import folder_exists, list_folder, remove_folder, stage, staged, write_parquet
from milepost.sources.tables import read_or_empty

# Bytes of the keys of one batch that may be broadcast, measured before; rows count with ROW_BYTES besides.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 48
PART_ROWS = 2_000_000  # rows of a directory that one task gathers, about
PORTION_ROWS = 32_000_000  # rows that are shuffled at once where directories can be rewritten one after the other, about


def laid_out(df: DataFrame, by: list[str], sort: list[str] = ()) -> DataFrame:
    """Rows gathered by partition directory, so tasks do not each open every directory.

    The rebalance hint lets Spark split a directory that holds much of the rows
    and merge small ones; hashing on the directory alone would put a hot month on
    one task.
    """
    return df.hint("rebalance", *by).sortWithinPartitions(*by, *sort)


def deal(df: DataFrame, by: list[str], keys: list[str], sizes: dict[tuple, int]) -> tuple[DataFrame, list[str]]:
    """Rows gathered by directory, large ones in parts by hash of the key, so that rows of a key are together
    and a search for one row per key (grouped by `by`, `keys` and the named part column) needs no other shuffle.

    sizes: rows per directory (values of `by` as text). Returns the rows and the name of the part column, if there is one.
    """
    parts = [(*names, -(-n // PART_ROWS)) for names, n in sizes.items() if n > PART_ROWS]
    if not parts:
        return df.repartition(*by), []
    shape = StructType([*[StructField(c, StringType()) for c in by], StructField("_parts", LongType())])
    large = F.broadcast(df.sparkSession.createDataFrame(parts, shape))  # one row per large directory
    same = reduce(Column.__and__, [F.col(f"r.{c}").cast("string").eqNullSafe(F.col(f"p.{c}")) for c in by])
    part = F.pmod(F.xxhash64(*[F.col(f"r.{k}") for k in keys]), F.coalesce("_parts", F.lit(1))).cast("int")
    placed = df.alias("r").join(large.alias("p"), same, "left").select("r.*", part.alias("_part"))
    return placed.repartition(*by, "_part"), ["_part"]


def in_portions(sizes: dict, most: int | None = None) -> list[dict]:
    """Directories (or slots) with their rows, in portions of about PORTION_ROWS rows, at least one directory each."""
    portions, held = [], 0
    for name, rows in sizes.items():
        if not portions or held + rows > (most or PORTION_ROWS):
            portions, held = [*portions, {}], 0
        portions[-1][name] = rows
        held += rows
    return portions


def of_directories(by: list[str], sizes: dict[tuple, int]) -> Column:
    """Whether a row lies in one of the directories (values of `by` as text); prunes the others."""
    name = F.concat_ws("\x01", *[F.coalesce(F.col(c).cast("string"), F.lit("\x02")) for c in by])
    return name.isin(["\x01".join("\x02" if v is None else v for v in values) for values in sizes])


def append(df: DataFrame, path: str, by: list[str], sort: list[str] = ()) -> None:
    laid_out(df, by, sort).write.mode("append").partitionBy(*by).parquet(path)


def append_absent(
    df: DataFrame, path: str, schema: StructType, keys: list[str], by: list[str], scope: list[str], sort: list[str] = ()
) -> None:
    """Insert the rows whose key the table lacks. `df` must be unique by key.

    Doing it again adds nothing, which makes it safe under batch replay. See `keys_stored`
    for the search and its scope.
    """
    stored = keys_stored(df, path, schema, keys, by, scope)
    new = df.select(*schema.names)
    if stored is not None:
        new = new.join(stored, _same(stored, keys, scope), "left_anti")
    insert(laid_out(new, by, sort), path, by, keys, scope)


def keys_stored(df: DataFrame, path: str, schema: StructType, keys: list[str], by: list[str], scope: list[str]) -> DataFrame | None:
    """The keys of `df` that a table holds, once each, in columns `_<key>` and `_<scope>`; None if there are none.

    The keys of `df` go to the table's files (broadcast up to BROADCAST_BYTES, which is
    checked), so the table is not shuffled, and only its key columns are read.

    scope: leading partition columns that are a function of the key, such as the
    period of an activity. Then only the directories that occur in `df` are listed
    and read. With an empty scope the whole table is searched: Bloom filters of the keys
    (see id_filters), kept from the first write on or made by `id_filters.add_filters`, name the
    directories that may hold one; a table without filters is read whole.
    """
    spark = df.sparkSession
    if scope:
        table = _directories_of(df, path, schema, scope, by)
    elif keys[0] in filtered_columns(spark, path) or (len(keys) == 1 and not folder_exists(spark, path)):
        table = _read_directories(spark, path, schema, by, directories_with(df, path, schema, keys[0], by))
    else:
        table = read_or_empty(spark, path, schema)
    columns = _searched(keys, scope)
    wanted = df.select(*[F.col(c).alias(f"_{c}") for c in columns])
    if _size(wanted) <= BROADCAST_BYTES:
        wanted = F.broadcast(wanted)
    found = table.select(*columns).join(wanted, _same(wanted, keys, scope), "left_semi").distinct()
    # Staged: its size decides how it is joined, and a table that grows meanwhile changes nothing.
    stored = stage(found.toDF(*[f"_{c}" for c in columns]), "stored")
    if stored.isEmpty():
        return None
    return F.broadcast(stored) if _size(stored) <= BROADCAST_BYTES else stored


def rows_absent(rows: DataFrame, stored: DataFrame | None, key: str, by: list[str], sort: list[str] = ()) -> DataFrame:
    """The laid-out rows, unique by key, that are not among the keys `stored` (see `keys_stored`).

    Mostly no row has to move: nothing is stored, or all of it, or few keys on one of the sides. Only if there are many
    of both, rows are joined by key and laid out again.
    """
    if stored is None:
        return rows
    key_stored = stored.select(f"_{key}")
    if _size(key_stored) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(key_stored), F.col(key) == F.col(f"_{key}"), "left_anti")
    new = rows.select(F.col(key).alias("_new")).join(key_stored, F.col("_new") == F.col(f"_{key}"), "left_anti")
    new = stage(new, "new")
    if _size(new) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(new), F.col(key).eqNullSafe(F.col("_new")), "left_semi")  # a missing key is always new
    return laid_out(rows.join(key_stored, F.col(key) == F.col(f"_{key}"), "left_anti"), by, sort)


def _searched(keys: list[str], scope: list[str]) -> list[str]:
    return [*keys, *[c for c in scope if c not in keys]]


def _same(side: DataFrame, keys: list[str], scope: list[str]) -> Column:
    """A missing key matches nothing, a missing period is one of its own."""
    return reduce(
        Column.__and__, [F.col(c) == side[f"_{c}"] if c in keys else F.col(c).eqNullSafe(side[f"_{c}"]) for c in _searched(keys, scope)]
    )


def _size(keys: DataFrame) -> int:
    """Bytes of the keys of one batch, about."""
    text = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in keys.columns]
    rows, size = keys.agg(F.count(F.lit(1)), F.sum(reduce(Column.__add__, text))).first()
    return rows * ROW_BYTES + (size or 0)


def insert(rows: DataFrame, path: str, by: list[str], keys: list[str], scope: list[str], open_files: int = 0) -> None:
    """Append laid-out rows to a table and to its filters; a new table that is searched whole gets filters of its key.

    open_files: see `write_parquet`.
    """
    spark = rows.sparkSession
    filtered = filtered_columns(spark, path)
    if len(keys) == 1 and not scope and not folder_exists(spark, path):
        filtered = [keys[0]]
    if not filtered:
        return write_parquet(rows, path, by, "append", open_files)
    with staged(rows, "absent") as rows:
        if rows.isEmpty():
            return
        for column in filtered:
            add_filters(rows, path, column, by)  # before the rows themselves
        write_parquet(rows, path, by, "append", open_files)


def _directories_of(df: DataFrame, path: str, schema: StructType, scope: list[str], by: list[str]) -> DataFrame:
    """The part of a table in the directories that occur in `df`; only those are listed."""
    if list(scope) != list(by[: len(scope)]):
        raise ValueError(f"{scope} are not the leading partition columns of {by}")
    spark = df.sparkSession
    touched = df.select(*scope).distinct().collect()  # one row per directory
    return _read_directories(spark, path, schema, scope, [tuple(row) for row in touched])


def rows_with(spark: SparkSession, path: str, schema: StructType, by: list[str], key: str, value) -> DataFrame:
    """The rows of a stored table with one value of a column. If the column has filters, only the directories
    are listed and read whose filters know the value."""
    if key not in filtered_columns(spark, path):
        return read_or_empty(spark, path, schema).filter(F.col(key) == value)
    wanted = spark.createDataFrame([(value,)], StructType([schema[key]]))
    return _read_directories(spark, path, schema, by, directories_with(wanted, path, schema, key, by)).filter(F.col(key) == value)


def _read_directories(spark: SparkSession, path: str, schema: StructType, by: list[str], values: list[tuple]) -> DataFrame:
    """The rows in some directories; parents are listed once, not one by one."""
    folders = [partition_folder(path, zip(by, v)) for v in values]
    there = {parent: set(list_folder(spark, parent)) for parent in {f.rsplit("/", 1)[0] for f in folders}}
    present = [f for f in folders if f.rsplit("/", 1)[1] in there[f.rsplit("/", 1)[0]]]
    if not present:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*present)


def write_version(df: DataFrame, path: str, by: list[str], sort: list[str] = ()) -> None:
    """Whole-table rewrite into a new folder; fails if it exists. Readers keep the old one."""
    laid_out(df, by, sort).write.mode("errorifexists").partitionBy(*by).parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned table; `df` may be computed from it, as it is staged first."""
    stage(df, "table").write.mode("overwrite").parquet(path)


def point_table(spark: SparkSession, name: str, path: str) -> None:
    """Make a table read another folder: the switch after `write_version`."""
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def partition_folder(path: str, values: Iterable[tuple[str, object]]) -> str:
    names = [f"{name}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}" for name, value in values]
    return "/".join([path, *names])


def replace_slice(df: DataFrame, path: str, by: list[str], slice_filter: Column, sort: list[str] = ()) -> None:
    """Put `df` in place of the directories that `slice_filter` (on partition columns) selects.

    The new rows are staged first, so they may be computed from the table itself,
    and are still there if the swap is interrupted. Directories are then replaced
    one by one; those of the slice that have no rows any more are removed.
    """
    spark = df.sparkSession
    new = stage(df, "slice")
    kept = new.select(*by).distinct()
    before = read_or_empty(spark, path, new.schema).filter(slice_filter).select(*by).distinct()
    emptied = before.subtract(kept).collect()  # directories, not rows
    laid_out(new, by, sort).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    for row in emptied:
        remove_folder(spark, partition_folder(path, [(c, row[c]) for c in by]))


def rewrite_directories(
    table: DataFrame, path: str, by: list[str], directories: DataFrame, change: Callable[[DataFrame], DataFrame], sort: list[str] = ()
) -> int:
    """Put `change(rows)` in place of the rows in the given directories; the files of all others stay.

    directories: rows of `by`, listed on the driver (one per directory). Returns their number.
    """
    spark = table.sparkSession
    touched = [tuple(r) for r in directories.select(*by).collect()]
    if not touched:
        return 0
    folders = [partition_folder(path, zip(by, values)) for values in touched]
    rows = spark.read.schema(table.schema).option("basePath", path).parquet(*folders)
    new = stage(change(rows).select(*table.columns), "directories")
    left = {tuple(r) for r in new.select(*by).distinct().collect()}
    laid_out(new, by, sort).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    for folder, values in zip(folders, touched):
        if values not in left:
            remove_folder(spark, folder)
    return len(touched)


def delete_slice(spark: SparkSession, path: str, schema: StructType, slice_values: dict[str, object], dry_run: bool = False) -> DataFrame:
    """Drop the directories of leading partition columns; one row (matched, deleted, remaining)."""

    def count():
        rows = read_or_empty(spark, path, schema)
        for name, value in slice_values.items():
            rows = rows.filter(F.col(name) == value)
        return rows.count()

    matched = count()
    if matched and not dry_run:
        remove_folder(spark, partition_folder(path, slice_values.items()))
    remaining = count()
    return spark.createDataFrame(
        [(matched, matched - remaining, remaining)], "matched bigint, deleted bigint, remaining bigint"
    )


def send(messages: DataFrame, format: str = "kafka", **options) -> None:
    """Write (key, value) or (value) messages, to a topic by default."""
    messages.write.format(format).options(**options).mode("append").save()


def publish(documents: DataFrame, put: Callable[[list[Row]], None], batch: int = 1000) -> None:
    """Hand (doc_id, doc) rows to a serving store from the tasks, `batch` at a time.

    Documents are keyed, so a repeated task writes the same ones again.
    """

    def deliver(rows):
        chunk = []
        for row in rows:
            chunk.append(row)
            if len(chunk) == batch:
                put(chunk)
                chunk = []
        if chunk:
            put(chunk)

    documents.foreachPartition(deliver)


def create_table(spark: SparkSession, name: str, schema: StructType, by: list[str], location: str, format="parquet", comment="") -> None:
    """Empty partitioned table at a location."""
    ordered = [f for f in schema.fields if f.name not in by] + [schema[c] for c in by]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered)
    partitions = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in by)})" if by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {format} {partitions} "
        f"COMMENT '{comment}' LOCATION '{location}'"
    )


def audited(df: DataFrame, as_of: Column, by: str) -> DataFrame:
    """Created and last-modified columns of report rows."""
    return df.select(
        "*",
        as_of.alias("CreatedAt"),
        F.lit(by).alias("CreatedBy"),
        as_of.alias("LastModified"),
        F.lit(by).alias("LastModifiedBy"),
    )
