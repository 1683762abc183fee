"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of consecutive documents. Layout, all numbers little-endian:

    blocks   of 256 ids (the last one fewer):
             u32 minimum, u16 ids, u16 exceptions, u8 width, 7 zero bytes,
             256 residuals (id - minimum), their low `width` bits packed in u64 words,
             u16 positions of the exceptions, u32 high bits of the exceptions
    index    u64 start of every block
    keys     an Arrow IPC stream: key and number of ids of every document
    end      u64 start of the index, u64 start of the keys, u64 blocks, 8 bytes "PFORIDS1"
"""

import io
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from milepost.llm.arrow import slices, utf8
from milepost.llm.files import open_folder, write_whole
from milepost.llm.tokens import ROWS, encoder
from milepost.session import new_folder, stage

BLOCK, MAGIC = 256, b"PFORIDS1"
PERCENTILE = 0.95  # of a block's residuals fit its width; the others are exceptions
CHUNK = 4096  # blocks that are packed or unpacked at once
_HEAD = np.dtype([("least", "<u4"), ("n", "<u2"), ("odd", "<u2"), ("width", "u1"), ("zero", "V7")])


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(rows, 64) numbers below 2**width -> (rows, width) u64 words."""
    out = np.zeros((width, len(values)), np.uint64)
    for i, column in enumerate(np.ascontiguousarray(values.T, np.uint64)):
        word, shift = divmod(i * width, 64)
        out[word] |= column << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= column >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    """The inverse of `_pack`."""
    columns, mask = np.ascontiguousarray(words.T), np.uint64((1 << width) - 1)
    out = np.empty((64, len(words)), np.uint32)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        value = columns[word] >> np.uint64(shift)
        if shift + width > 64:
            value |= columns[word + 1] << np.uint64(64 - shift)
        out[i] = value & mask
    return out.T


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """u32 ids as blocks."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return []
    padded = np.full(n * BLOCK, ids[-1], np.uint32)
    padded[: len(ids)] = ids
    rows = padded.reshape(n, BLOCK)
    least = rows.min(1)
    rest = rows - least[:, None]
    at = int(PERCENTILE * (BLOCK - 1))
    width = np.frexp(np.partition(rest, at, axis=1)[:, at].astype(float))[1].astype(np.uint8)
    high = rest >> width[:, None]
    heads = np.zeros(n, _HEAD)
    heads["least"], heads["n"], heads["width"], heads["odd"] = least, BLOCK, width, (high > 0).sum(1)
    heads["n"][-1] = len(ids) - (n - 1) * BLOCK
    bodies = [b""] * n
    for w in np.unique(width):
        if w:
            of = np.flatnonzero(width == w)
            low = rest[of] & np.uint32((1 << int(w)) - 1)
            packed = _pack(low.reshape(-1, 64), int(w)).reshape(len(of), -1)
            for i, row in zip(of, packed):
                bodies[i] = row.astype("<u8", copy=False).tobytes()
    row, position = np.nonzero(high)
    cuts = np.searchsorted(row, np.arange(n + 1))
    position, extra, heads_bytes, size = position.astype("<u2"), high[row, position].astype("<u4"), heads.tobytes(), _HEAD.itemsize
    out = []
    for i in range(n):
        a, b = cuts[i], cuts[i + 1]
        odd = position[a:b].tobytes() + extra[a:b].tobytes() if a < b else b""
        out.append(heads_bytes[i * size : (i + 1) * size] + bodies[i] + odd)
    return out


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at `starts` in `data`."""
    raw, size = np.frombuffer(data, np.uint8), _HEAD.itemsize
    heads = raw[starts[:, None] + np.arange(size)].view(_HEAD).reshape(-1)
    rows = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(heads["width"]):
        if w:
            of = np.flatnonzero(heads["width"] == w)
            span = starts[of][:, None] + size + np.arange(BLOCK // 8 * int(w))
            words = raw[span].view("<u8").reshape(-1, int(w))
            rows[of] = _unpack(words, int(w)).reshape(len(of), BLOCK)
    n = heads["odd"].astype(np.int64)
    if n.any():
        row = np.repeat(np.arange(len(starts)), n)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at = (starts + size + BLOCK // 8 * heads["width"].astype(np.int64))[row]
        position = raw[(at + 2 * nth)[:, None] + np.arange(2)].view("<u2")[:, 0]
        high = raw[(at + 2 * n[row] + 4 * nth)[:, None] + np.arange(4)].view("<u4")[:, 0]
        rows[row, position] |= high << heads["width"][row].astype(np.uint32)
    rows += heads["least"][:, None]
    return rows[np.arange(BLOCK) < heads["n"][:, None]]


class Writer:
    """Writes one file, holding CHUNK blocks of ids at most."""

    def __init__(self, stream):
        self.stream, self.at, self.starts, self.waiting, self.held = stream, 0, [], [], 0

    def add(self, ids: bytes) -> None:
        self.waiting.append(ids)
        self.held += len(ids) // 4
        if self.held >= CHUNK * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        n = len(ids) if last else len(ids) // BLOCK * BLOCK
        for block in encode_blocks(ids[:n]):
            self.starts.append(self.at)
            self.stream.write(block)
            self.at += len(block)
        self.waiting, self.held = [ids[n:].tobytes()], len(ids) - n

    def close(self, keys: pa.Table) -> None:
        self._flush(True)
        buffer = io.BytesIO()
        with pa.ipc.new_stream(buffer, keys.schema) as ipc:
            ipc.write_table(keys)
        index = np.array(self.starts, "<u8").tobytes()
        ends = np.array([self.at, self.at + len(index), len(self.starts)], "<u8").tobytes()
        self.stream.write(index + buffer.getvalue() + ends + MAGIC)


class Reader:
    """Opens a file by its end: block starts and document lengths; ids by range reads."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        end = source.read_at(32, size - 32)
        if end[24:] != MAGIC:
            raise ValueError("not a file of token ids")
        self.blocks_end, keys_at, n = np.frombuffer(end, "<u8", 3).tolist()
        self.starts = np.frombuffer(source.read_at(8 * n, self.blocks_end), "<u8").astype(np.int64)
        self.keys = pa.ipc.open_stream(source.read_at(size - 32 - keys_at, keys_at)).read_all()

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks first to last - 1."""
        if first >= last:
            return np.zeros(0, np.uint32)
        begin = int(self.starts[first])
        end = int(self.starts[last]) if last < len(self.starts) else self.blocks_end
        return decode_blocks(self.source.read_at(end - begin, begin), self.starts[first:last] - begin)

    def document(self, number: int) -> np.ndarray:
        """The ids of one document, reading only its blocks."""
        ends = np.cumsum(self.keys["n_tokens"].to_numpy())
        stop = int(ends[number])
        begin = stop - self.keys["n_tokens"][number].as_py()
        ids = self.blocks(begin // BLOCK, -(-stop // BLOCK))
        return ids[begin % BLOCK : begin % BLOCK + stop - begin]

    def documents(self):
        """(position, key, ids) in file order; holds CHUNK blocks and one document."""
        held, block, total = np.zeros(0, np.uint32), 0, len(self.starts)
        for i, (key, n) in enumerate(zip(self.keys["key"].to_pylist(), self.keys["n_tokens"].to_pylist())):
            parts, have = [held], len(held)
            while have < n and block < total:
                upto = min(block + CHUNK, total)
                parts.append(self.blocks(block, upto))
                have, block = have + len(parts[-1]), upto
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield i, key, held[:n]
            held = held[n:]


def write_tokens(docs: DataFrame, path: str, end_id: int, folder: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode the texts and write files in ascending key order; returns the manifest:
    shard (ascending), folder, file, n_docs, n_ids, and start (the ids of earlier shards).

    Each document is its ids and `end_id`. Rows are range-partitioned by key (equal keys
    by the checksum of their text), sorted, encoded and written by one task per range;
    a task holds a bounded number of ids, and its file appears whole. Only what the manifest
    names is valid. `folder` must be reachable by all executors; left out, it is a
    new one in the shared folder.

    A null or empty text is a document of the end id alone; null keys come first. Repeated
    keys and rows are documents of their own. No rows, no files. Other columns are not used.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("key", F.crc32("text")).sortWithinPartitions("key", "text")
    end = end_id.to_bytes(4, "little")

    def write(batches):
        shard = TaskContext.get().partitionId()
        batches = slices(batches, ROWS)
        first = next(batches, None)
        if first is None:
            return
        encode, keys, lengths = encoder(path).encode, [], []

        def fill(stream):
            writer, batch = Writer(stream), first
            while batch is not None:
                if batch.num_rows:
                    keys.append(batch.column(0))
                    for ids in encode(utf8(batch.column(1))):
                        writer.add(ids + end)
                        lengths.append(len(ids) // 4 + 1)
                batch = next(batches, None)
            column = pa.chunked_array(keys, first.column(0).type)
            writer.close(pa.table({"key": column, "n_tokens": pa.array(lengths, pa.int64())}))

        name = f"ids-{shard:06d}.pfor"
        write_whole(folder, name, fill)
        row = {"shard": [shard], "folder": [folder], "file": [name], "n_docs": [len(lengths)], "n_ids": [sum(lengths)]}
        yield pa.RecordBatch.from_pydict(row, pa.schema([("shard", pa.int32()), ("folder", pa.string()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    manifest = stage(rows.mapInArrow(write, "shard int, folder string, file string, n_docs bigint, n_ids bigint"), "manifest")
    # One row per file.
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))


def read_tokens(manifest: DataFrame, key_type: str, key: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """Documents from the files of a manifest, a file per task: key, start (ids of all
    documents before it), n_tokens, ids_crc32; with keep_ids also ids as array<int>."""
    files = max(manifest.count(), 1)

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                system, at = open_folder(row["folder"])
                with system.open_input_file(f"{at}/{row['file']}") as source:
                    yield from documents(Reader(source), row["start"])

    def documents(reader, start):
        rows, held = [], 0
        for _, name, ids in reader.documents():
            rows.append((name, start, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4")), ids.astype(np.int32) if keep_ids else None))
            start, held = start + len(ids), held + (len(ids) if keep_ids else 1)
            if held >= 1 << 20 or len(rows) >= 20_000:
                yield table(rows, reader)
                rows, held = [], 0
        yield table(rows, reader)

    def table(rows, reader):
        columns = list(zip(*rows)) if rows else [[]] * 5
        arrays = [pa.array(columns[0], reader.keys.schema.field("key").type), *[pa.array(c, pa.int64()) for c in columns[1:4]]]
        names = ["key", "start", "n_tokens", "ids_crc32"]
        if keep_ids:
            arrays.append(pa.array([list(map(int, c)) for c in columns[4]], pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names)

    ddl = f"key {key_type}, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if keep_ids else "")
    spread = manifest.select("shard", "folder", "file", "start").repartitionByRange(files, "shard")
    return spread.mapInArrow(read, ddl).withColumnRenamed("key", key)
