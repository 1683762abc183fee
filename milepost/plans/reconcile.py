"""Finding what a copy of a table lacks by comparing digests of its directories.

A digest is the number of rows of a directory and the sum of the hashes of their Ids. Digests are
remembered with the names, sizes and times of the files they were made of, so only
directories that changed since are read again. Two tables are compared as trees of their partition
columns, and just the directories that differ are compared row by row.
"""

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from milepost.functions.values import lower_names
from milepost.operators.joins import rows_without_match
from milepost.operators.sinks import partition_folder
from milepost.schemas import layout
from milepost.session import folder_exists
from milepost.sources.tables import read_or_empty

DIGEST = layout("folder string, files string, n bigint, total string")


def listed(spark: SparkSession, path: str) -> dict[str, str]:
    """The directories that hold files, relative to `path`, and a signature of the files of each."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, list] = {}
    if not system.exists(root):
        return {}
    top = system.getFileStatus(root).getPath().toString()
    files = system.listFiles(root, True)
    while files.hasNext():
        status = files.next()
        name = status.getPath().toString()[len(top) + 1 :]
        folder, _, file = name.rpartition("/")
        if not file.startswith(("_", ".")) and not any(part.startswith(("_", ".")) and "=" not in part for part in folder.split("/")):
            found.setdefault(folder, []).append(f"{file} {status.getLen()} {status.getModificationTime()}")
    return {f: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest() for f, names in found.items()}


def _read(spark: SparkSession, path: str, schema: StructType, folders: list[str]) -> DataFrame:
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*[f"{path}/{f}" if f else path for f in folders]) if folders else spark.createDataFrame([], schema)


def _narrow(schema: StructType, key: str, by: list[str]) -> StructType:
    return StructType([f for f in schema.fields if f.name in (key, *by)])


def digests(spark: SparkSession, path: str, schema: StructType, key: str, by: list[str], memory: str) -> tuple[dict[str, tuple], list[str]]:
    """(rows, sum of hashes) per directory, and the directories that had to be read for it.

    memory: folder of the remembered digests of this table.
    """
    signatures = listed(spark, path)
    known = {(r["folder"], r["files"]): (r["n"], int(r["total"])) for r in read_or_empty(spark, memory, DIGEST).collect()}  # a row per directory
    fresh = [f for f, s in signatures.items() if (f, s) not in known]
    rows = _read(spark, path, _narrow(schema, key, by), fresh)
    # A row without Id counts by its number alone.
    total = F.sum(F.coalesce(F.xxhash64(F.when(F.col(key).isNotNull(), F.col(key))), F.lit(0)).cast("decimal(38,0)"))
    made = []
    for r in rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), total.alias("total")).collect():
        folder = partition_folder("", [(c, r[c]) for c in by]).lstrip("/")
        made.append((folder, signatures[folder], r["n"], str(int(r["total"]))))
    empty = set(fresh) - {f for f, *_ in made}
    made += [(f, signatures[f], 0, "0") for f in sorted(empty)]
    if made:
        spark.createDataFrame(made, DIGEST).coalesce(1).write.mode("append").parquet(memory)
    known |= {(f, s): (n, int(t)) for f, s, n, t in made}
    return {f: known[f, s] for f, s in signatures.items()}, fresh


def differing(source: dict[str, tuple], target: dict[str, tuple]) -> list[str]:
    """The directories that differ, found level by level: where the sums of a parent agree, its
    children are not looked at."""
    depth = max((f.count("/") + 1 for f in [*source, *target] if f), default=0)

    def sums(side, level):
        out: dict[str, list] = {}
        for folder, (n, total) in side.items():
            node = out.setdefault("/".join(folder.split("/")[:level]), [0, 0])
            node[0] += n
            node[1] += total
        return out

    inside = {""}
    for level in range(1, depth + 1):
        a, b = sums(source, level), sums(target, level)
        nodes = {f for f in a.keys() | b.keys() if f.rpartition("/")[0] in inside}
        inside = {f for f in nodes if a.get(f) != b.get(f)}
    return sorted(inside) if depth else []


def _low(folder: str) -> str:
    """A directory with its column names in lower case."""
    return "/".join(f"{name.lower()}={value}" for name, _, value in (part.partition("=") for part in folder.split("/")))


def missing_rows(
    spark: SparkSession, source: str, source_schema: StructType, target: str, target_schema: StructType, by: list[str], memory: str, key: str = "Id"
) -> tuple[DataFrame, list[str]]:
    """Source rows whose Id the target lacks in the same directory, in lower-case columns, and the directories
    that were compared row by row.

    source, target: folders partitioned by `by`, in the target in lower case. memory: folder for the
    digests. An Id is looked for under its own date only. Rows without Id are missing wherever a directory differs.
    """
    low = [c.lower() for c in by]
    mine, _ = digests(spark, source, source_schema, key, by, f"{memory}/source")
    theirs, _ = digests(spark, target, target_schema, key.lower(), low, f"{memory}/target")
    lowered = {_low(f): f for f in mine}
    folders = differing({_low(f): d for f, d in mine.items()}, theirs)
    rows = lower_names(_read(spark, source, source_schema, [lowered[f] for f in folders if f in lowered]))
    there = [f for f in folders if f in theirs and folder_exists(spark, f"{target}/{f}")]
    known = _read(spark, target, _narrow(target_schema, key.lower(), low), there)
    return rows_without_match(rows, known, [key.lower(), *low]).select(*rows.columns), folders
