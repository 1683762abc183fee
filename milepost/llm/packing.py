"""Harmonic packing of documents into sequences of a fixed number of tokens."""

import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from milepost.llm.arrow import frugal, slices, utf8
from milepost.llm.tokens import ROWS, encoder
from milepost.session import stage

FINEST = 16  # pieces above capacity / FINEST are cut to a reciprocal of the capacity
_LATE = 1 << 62  # sequence ids filled after the workers' own begin here
_CLASS_BITS, _TASK_BITS = 40, 33


def classes(capacity: int) -> dict[int, int]:
    """Largest piece of each class -> how many of them fill a sequence.

    The sizes are capacity/1, /2, ... /FINEST and a finer ladder below, so that a
    rest wastes a few tokens only.
    """
    sizes = {capacity // k: k for k in range(1, FINEST + 1) if capacity // k}
    least = max(capacity // FINEST, 1)
    for size in [s for s in (1, 2, 4) if s < least] + list(range(8, least, 8)):
        sizes.setdefault(size, capacity // size)
    return sizes


def cut(length: int, capacity: int, sizes: list[int]) -> list[tuple[int, int]]:
    """(piece length, class size) of a document of `length` tokens. `sizes` falls."""
    pieces, least = [], max(capacity // FINEST, 1)
    for size in sizes:
        if size < least:
            break
        while length >= size:
            pieces.append((size, size))
            length -= size
    if length:
        pieces.append((length, min(s for s in sizes if s >= length)))
    return pieces


def _fill(batches, path, end_id, capacity, keep_ids):
    """One worker: cuts its documents and fills the bins of every class on its own.
    Bins still open at the end are given out as rows without a sequence."""
    encode, ladder = encoder(path).encode, classes(capacity)
    sizes, task = sorted(ladder, reverse=True), TaskContext.get().partitionId()
    fills = np.zeros(capacity + 1, np.int64)
    fills[sizes] = [ladder[s] for s in sizes]
    end, made, waiting = end_id.to_bytes(4, "little"), 0, None
    for batch in slices(batches, ROWS):
        columns = {n: array("q") for n in ("owner", "start", "length", "ids_crc32", "doc_tokens", "size")}
        add = [c.append for c in columns.values()]
        kept = []
        for k, ids in enumerate(encode(utf8(batch.column(1)))):
            ids += end
            total, start = len(ids) // 4, 0
            for length, size in cut(total, capacity, sizes):
                part = ids[4 * start : 4 * (start + length)]
                for put, value in zip(add, (k, start, length, zlib.crc32(part), total, size)):
                    put(value)
                if keep_ids:
                    kept.append(part)
                start += length
        arrays = {n: pa.array(np.frombuffer(c, np.int64)) for n, c in columns.items()}
        arrays = {"key": batch.column(0).take(arrays.pop("owner")), **arrays}
        arrays["ids"] = pa.array(kept, pa.binary()) if keep_ids else pa.nulls(len(arrays["start"]), pa.binary())
        rows = pa.table(arrays)
        if waiting is not None:
            rows = pa.concat_tables([waiting, rows])
        # The pieces of a class, first come first served, in bins of its fixed number.
        size, length = rows["size"].to_numpy(), rows["length"].to_numpy()
        order = np.argsort(size, kind="stable")
        size, length = size[order], length[order]
        begin = np.searchsorted(size, size)
        at, fill = np.arange(len(size)) - begin, fills[size]
        full = at < (np.searchsorted(size, size, side="right") - begin) // fill * fill
        first = full & (at % fill == 0)
        number = made + np.cumsum(first)[full] - 1
        upto = np.cumsum(length[full]) - length[full]
        offset = upto - upto[first[full]][np.cumsum(first[full]) - 1] if full.any() else upto
        made += int(first.sum())
        yield _out(rows.take(pa.array(order[full])), task, None, task << _TASK_BITS | number, offset)
        waiting = rows.take(pa.array(np.sort(order[~full])))
    if waiting is not None:
        size = waiting["size"].to_numpy()
        order = np.argsort(size, kind="stable")
        at = np.arange(len(size)) - np.searchsorted(size[order], size[order])
        yield _out(waiting.take(pa.array(order)), task, at, None, None)


def _out(rows: pa.Table, task: int, at, sequence, offset) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    n = rows.num_rows
    column = lambda values, kind: pa.nulls(n, kind) if values is None else pa.array(values, kind)
    columns = {
        **{c: rows[c].combine_chunks() for c in ("key", "start", "length", "ids_crc32", "doc_tokens")},
        "size": rows["size"].combine_chunks().cast(pa.int32()), "task": pa.array(np.full(n, task), pa.int32()),
        "at": column(at, pa.int32()), "sequence_id": column(sequence, pa.int64()), "offset": column(offset, pa.int64()),
        "ids": rows["ids"].combine_chunks(),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _best_fit(rows: pa.Table, capacity: int) -> pa.Table:
    """The last, incomplete bin of every class together: longest first, each into the
    fullest sequence that still has room."""
    order = sorted(range(rows.num_rows), key=lambda i: (-rows["length"][i].as_py(), rows["index"][i].as_py()))
    room: list[int] = []
    sequence, offset = [0] * rows.num_rows, [0] * rows.num_rows
    for i in order:
        length = rows["length"][i].as_py()
        fits = [(free, b) for b, free in enumerate(room) if free >= length]
        b = min(fits)[1] if fits else len(room)
        if not fits:
            room.append(capacity)
        sequence[i], offset[i] = _LATE + b, capacity - room[b]
        room[b] -= length
    for name, values in (("sequence_id", sequence), ("offset", offset)):
        rows = rows.set_column(rows.schema.get_field_index(name), name, pa.array(values, pa.int64()))
    return rows


def pack(
    docs: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text", capacity: int = 2048, keep_ids: bool = False
) -> DataFrame:
    """Documents as pieces of token sequences of at most `capacity` tokens.

    Harmonic packing: a document (its ids and the end id) is cut at reciprocals of the
    capacity, and the rest falls into a class of nearly equal lengths. A class of
    capacity/k takes exactly k pieces per sequence, so every worker fills the bins of
    its classes without looking at another one. The bins left open by the workers
    are numbered class by class (counts per worker, not rows, are summed up) and
    filled in the same way; only the last bin of each class, fewer pieces than the
    classes have places at any size of the input, is packed by best fit.

    Returns key, start (ids of the document before the piece), length, ids_crc32 (of the
    ids as little-endian unsigned 32-bit integers), doc_tokens, sequence_id, offset
    (in the sequence, gapless from 0); with keep_ids also `ids`, those bytes. Every id is in
    one piece. A sequence shorter than `capacity` is padded to it by whoever writes it.

    A null or empty text is a document of the end id alone. Null and repeated keys are
    documents of their own; a document's pieces then share the key. Other columns are
    not carried, so their names cannot clash. An empty table has no pieces.
    """
    ladder = classes(capacity)
    kind = docs.schema[key].dataType.simpleString()
    ddl = (
        f"key {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, size int, task int, at int, "
        "sequence_id bigint, offset bigint, ids binary"
    )
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).mapInArrow(
        frugal(lambda batches: (yield from _fill(batches, path, end_id, capacity, keep_ids))), ddl
    )
    rows = stage(rows if keep_ids else rows.drop("ids"), "packed")
    full, left = rows.where("sequence_id is not null"), rows.where("sequence_id is null")

    # One row per class and worker.
    counts = left.groupBy("size", "task").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("size")
    earlier = whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    fills = F.create_map(*[F.lit(x) for pair in ladder.items() for x in pair])
    counts = counts.select(
        F.col("size").alias("c_size"),
        F.col("task").alias("c_task"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("of_class"),
        fills[F.col("size")].alias("fill"),
    )
    late = left.join(counts, (F.col("size") == F.col("c_size")) & (F.col("task") == F.col("c_task")))
    late = late.withColumn("index", F.col("before") + F.col("at")).withColumn("bin", F.expr("index div fill"))
    is_full = F.col("bin") < F.expr("of_class div fill")
    in_bin = Window.partitionBy("size", "bin").orderBy("index").rowsBetween(Window.unboundedPreceding, -1)
    again = late.where(is_full).withColumns(
        {
            "sequence_id": F.lit(_LATE) + F.shiftleft(F.col("size").cast("bigint"), _CLASS_BITS) + F.col("bin"),
            "offset": F.coalesce(F.sum("length").over(in_bin), F.lit(0)),
        }
    )
    last = late.where(~is_full).select(*rows.columns, "index", F.lit(1).alias("one"))
    last = last.groupBy("one").applyInArrow(lambda t: _best_fit(t, capacity), last.schema)
    names = [F.col("key").alias(key), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if keep_ids else [])]
    return full.select(*names).unionByName(again.select(*names)).unionByName(last.select(*names))
