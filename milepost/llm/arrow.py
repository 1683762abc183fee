"""Arrow batches in, Arrow batches out: the frame that the text operators share."""

import ctypes
import inspect

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


def schema_of(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def utf8(column) -> list:
    """The texts of an Arrow column as UTF-8 bytes; None where null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def lower_words(texts: list) -> tuple[np.ndarray, pa.Array]:
    """The number of words of each text (UTF-8 bytes or None), and all words in a row:
    runs of anything but ASCII white space, with A-Z lower-cased."""
    # A fresh array: kernels for large strings misread arrays that begin at an offset.
    clean = pa.array([t.lower().strip() or None if t else None for t in texts], pa.large_string())
    split = pc.ascii_split_whitespace(clean)
    return pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64), split.flatten()


def slices(batches, rows: int = 1000):
    """The batches in smaller ones, for work that needs several times their size."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def by_bytes(batches, column: int, target: int):
    """The rows of the batches in tables whose texts take up to `target` bytes together, and nearly that
    much but for the last; a longer text is alone."""
    held, size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        upto, begin = np.cumsum(lengths), 0
        while begin < len(lengths):
            room = target - size + (int(upto[begin - 1]) if begin else 0)
            end = int(np.searchsorted(upto, room, side="right"))
            if end == begin and not held:
                end = begin + 1
            if end > begin:
                held.append(batch.slice(begin, end - begin))
                size += int(lengths[begin:end].sum())
            if end < len(lengths):
                yield pa.Table.from_batches(held)
                held, size = [], 0
            begin = end
    if held:
        yield pa.Table.from_batches(held)


def fresh(name: str, columns: list[str]) -> str:
    """`name`, or a longer one that no column has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def set_aside(df: DataFrame, names) -> tuple[DataFrame, dict[str, str]]:
    """`df` with those columns renamed that are called like one of `names`, and what to rename back."""
    taken = {n.lower() for n in names}
    clash = {c: fresh(f"_own_{c}", [*df.columns, *names]) for c in df.columns if c.lower() in taken}
    return df.withColumnsRenamed(clash), {v: k for k, v in clash.items()}


def _give_back() -> None:
    """Memory that the allocators hold but do not use goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def frugal(work):
    """`work`, a function of batches (mapInArrow) or of one group's table (applyInArrow), such that the
    worker process, which later stages use again, does not keep the memory of its largest task."""

    def each(batches):
        try:
            yield from work(batches)
        finally:
            _give_back()

    def once(table):
        try:
            return work(table)
        finally:
            _give_back()

    return each if inspect.isgeneratorfunction(work) else once


def add_columns(df: DataFrame, text: str, ddl: str, make, keep_text: bool = False) -> DataFrame:
    """`df` with the columns of `ddl`, made from the text column batch by batch.

    make:  called once per task, returns a function from a list of UTF-8 bytes
           (None for null) to a list of value lists, in the order of `ddl`
    Columns of `df` that are named like a new one are replaced. The text itself is
    only carried along with keep_text.
    """
    new = schema_of(ddl)
    names = {f.name.lower() for f in new.fields} | (set() if keep_text else {text.lower()})
    kept = [c for c in df.columns if c.lower() not in names]
    out = StructType([df.schema[c] for c in kept] + new.fields)
    columns = [f"`{c}`" for c in kept]
    at = kept.index(text) if text in kept else len(kept)
    if at == len(kept):
        columns.append(f"`{text}`")

    def run(batches):
        types = to_arrow_schema(new).types
        work = make()
        for batch in slices(batches):
            values = work(utf8(batch.column(at)))
            arrays = batch.columns[: len(kept)] + [pa.array(v, t) for v, t in zip(values, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    return df.select(columns).mapInArrow(frugal(run), out)
