"""WARC archives with a two-level capture index.

Records are written as gzip members. The index sorts reversed-host keys into compressed
blocks, and every index file ends with a sparse directory: the first key and place of
each block. A look-up finds its file, its block and its entry by binary search, and then reads
only the byte range of the record.
"""

import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from milepost.llm.files import open_folder, write_whole
from milepost.operators.id_filters import block_of, has_bit, probes
from milepost.session import new_folder, stage

LEAST_PAYLOAD = 100  # bytes; smaller payloads are always stored whole
FILTER_BLOCKS = 2048  # bitmaps of 4 KB each that know the repeated digests
BLOCK_LINES = 1000  # entries in a block of the index
OPEN_FILES = 64  # archives a reading task keeps open
MAGIC = b"CAPIDX01"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the namespace of names that are URLs
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format


def capture_key(url: Column) -> Column:
    """Host labels reversed, then port, path and query: 'org,example)/a?b'. A URL without a
    host is its own key, null is empty. White space and control characters become %20."""
    clean = F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), r"[\x00-\x20\x7F]", "%20")
    head = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?"
    host = F.lower(F.regexp_extract(clean, head + r"([^/?#:]*)", 1))
    rest = F.regexp_extract(clean, head + r"[^/?#:]*(.*)$", 1)
    return F.when(host != "", F.concat(F.array_join(F.reverse(F.split(host, "[.]")), ","), F.lit(")"), rest)).otherwise(clean)


def _sort_key(url: Column, page: Column) -> Column:
    return F.concat(capture_key(url), F.lit(" "), F.coalesce(page.cast("string"), F.lit("")))


def record_id(page) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page:{page}')}>"


def record(page, url, payload: bytes, digest: str, first, date: str) -> bytes:
    """One WARC record as a gzip member: a response, or a revisit of page `first`."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = first is not None and first != page
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if page is not None:
        lines.append(f"X-Page-Id: {page}")
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first)}", f"X-Refers-To-Page: {first}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> dict:
    """The fields of a record; the digest of a response is that of the payload read."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    full = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: ")).split(": ")[1])
    kind = fields["WARC-Type"]
    if kind == "response" and len(payload) != full:
        raise ValueError(f"record of {len(payload)} bytes, {full} announced")
    return {
        "page_id": fields.get("X-Page-Id"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": full,
        "payload_digest": hashlib.sha256(payload).hexdigest() if kind == "response" else fields["WARC-Payload-Digest"].partition(":")[2],
        "record_type": kind,
        "refers_to": fields.get("X-Refers-To-Page"),
        "payload": payload if kind == "response" else None,
    }


def _write_records(folder: str, date: str):
    def write(batches):
        first = next(batches, None)
        if first is None:
            return
        name = f"part-{TaskContext.get().partitionId():06d}.warc.gz"
        out: dict[str, list] = {"sort_key": [], "file": [], "offset": [], "length": []}

        def fill(stream):
            batch, at = first, 0
            while batch is not None:
                for key, page, url, html, digest, seen in zip(*(c.to_pylist() for c in batch.columns)):
                    member = record(page, url, html, digest, seen, date)
                    stream.write(member)
                    for column, value in zip(out.values(), (key, name, at, len(member))):
                        column.append(value)
                    at += len(member)
                batch = next(batches, None)

        write_whole(folder, name, fill)
        yield pa.RecordBatch.from_pydict(out, pa.schema([("sort_key", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))

    return write


def _write_index(folder: str):
    def write(batches):
        lines = (
            (key.encode(), f"\t{file}\t{offset}\t{length}".encode())
            for batch in batches
            for key, file, offset, length in zip(*(c.to_pylist() for c in batch.columns))
        )
        head = next(lines, None)
        if head is None:
            return
        name, directory, last = f"index-{TaskContext.get().partitionId():06d}.cap", [], head[0]

        def fill(stream):
            nonlocal last
            at, block, line = 0, [], head
            while line is not None:
                block.append(line)
                following = next(lines, None)
                if len(block) == BLOCK_LINES or following is None:
                    packed = zlib.compress(b"\n".join(k + v for k, v in block))
                    stream.write(packed)
                    directory.append(block[0][0] + f"\t{at}\t{len(packed)}".encode())
                    at, last, block = at + len(packed), block[-1][0], []
                line = following
            packed = zlib.compress(b"\n".join(directory))
            stream.write(packed + len(packed).to_bytes(8, "little") + MAGIC)

        write_whole(folder, name, fill)
        yield pa.RecordBatch.from_pydict({"file": [name], "first": [head[0].decode()], "last": [last.decode()]})

    return write


class Index:
    """Look-ups in the index files of an archive: files by their key range, blocks by the sparse
    directory, entries by key. Holds one directory and one block at a time."""

    def __init__(self, folder: str, files: list[tuple[bytes, bytes, str]]):
        self.system, self.folder = open_folder(folder)
        self.files = files  # (first key, last key, name), ascending
        self.lasts = [f[1] for f in files]
        self.file = self.block = None

    def _open(self, number: int) -> None:
        if self.file != number:
            path = f"{self.folder}/{self.files[number][2]}"
            self.source, self.file, self.block = self.system.open_input_file(path), number, None
            size = self.source.size()
            end = self.source.read_at(16, size - 16)
            if end[8:] != MAGIC:
                raise ValueError(f"not a capture index: {path}")
            length = int.from_bytes(end[:8], "little")
            rows = [line.rsplit(b"\t", 2) for line in zlib.decompress(self.source.read_at(length, size - 16 - length)).split(b"\n")]
            self.directory = [(key, int(at), int(n)) for key, at, n in rows]
            self.firsts = [key for key, _, _ in self.directory]

    def _load(self, number: int) -> None:
        if self.block != number:
            _, at, n = self.directory[number]
            self.entries = [line.rsplit(b"\t", 3) for line in zlib.decompress(self.source.read_at(n, at)).split(b"\n")]
            self.keys, self.block = [e[0] for e in self.entries], number

    def find(self, key: bytes):
        """(file, offset, length) of every entry with that key, in index order."""
        number = bisect_left(self.lasts, key)
        while number < len(self.files) and self.files[number][0] <= key:
            self._open(number)
            block = max(bisect_left(self.firsts, key) - 1, 0)  # equal keys may begin in the block before
            while block < len(self.directory) and self.firsts[block] <= key:
                self._load(block)
                for i in range(bisect_left(self.keys, key), bisect_right(self.keys, key)):
                    _, file, offset, length = self.entries[i]
                    yield file.decode(), int(offset), int(length)
                block += 1
            number += 1


class Archives:
    """Range reads of records; keeps a bounded number of files open."""

    def __init__(self, folder: str):
        self.system, self.folder = open_folder(folder)
        self.open: OrderedDict = OrderedDict()

    def read(self, file: str, offset: int, length: int) -> dict:
        source = self.open.pop(file, None) or self.system.open_input_file(f"{self.folder}/{file}")
        self.open[file] = source
        if len(self.open) > OPEN_FILES:
            self.open.popitem(last=False)[1].close()
        return parse(source.read_at(length, offset))


def write_archive(
    pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z"
) -> tuple[str, DataFrame]:
    """Write a record per row and the capture index; returns the folder and the list of index
    files (file, first, last: keys), one row per file.

    Of equal payloads of LEAST_PAYLOAD bytes or more, the rows with the smallest id are stored and the
    others written as revisits of it. Only digests and ids are shuffled to find these. A Bloom filter of
    the repeated digests, of a fixed size, tells which rows to look up: all others are written where they
    are read, and payloads travel for repeated ones (and a few taken for them) at most. That
    join by digest is split at run time where a payload is very frequent.
    Archives are written as rows come; index entries alone are sorted, range-partitioned by
    key and id, so one URL with very many captures spreads over several files.

    A null html is an empty payload, a null url has the empty key. A null id is
    never the smallest; payloads under null ids alone are all stored. Repeated rows are records of their own.
    Other columns are not used. No rows, no files.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    page = F.col(f"`{key}`")
    rows = pages.select(
        _sort_key(F.col(f"`{url}`"), page).alias("sort_key"), page.alias("page"), F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("html"),
    ).withColumn("digest", F.sha2("html", 256))
    large = rows.where(F.octet_length("html") >= LEAST_PAYLOAD)
    repeated = large.groupBy(F.col("digest").alias("same")).agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = stage(repeated.select("same", "first"), "repeated")
    blocks = F.lit(FILTER_BLOCKS)
    bits = repeated.select(block_of("same", blocks).alias("_block"), F.explode(F.array(*probes("same"))).alias("_bit"))
    bits = bits.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    asked = rows.withColumns({"_in": block_of("digest", blocks)} | {f"_p{i}": p for i, p in enumerate(probes("digest"))})
    asked = asked.join(F.broadcast(bits), F.col("_in") == F.col("_block"), "left")  # FILTER_BLOCKS bitmaps of 4 KB
    maybe = F.coalesce(reduce(Column.__and__, [has_bit("_bits", F.col(f"_p{i}")) for i in range(len(probes("digest")))]), F.lit(False))
    names = ["sort_key", "page", "url", "html", "digest", "first"]
    once = asked.where(~maybe).withColumn("first", F.lit(None).cast(pages.schema[key].dataType)).select(names)
    again = asked.where(maybe).join(repeated, F.col("digest") == F.col("same"), "left").select(names)
    entries = once.unionByName(again).mapInArrow(_write_records(folder, date), "sort_key string, file string, offset bigint, length bigint")
    entries = stage(entries, "entries").repartitionByRange("sort_key").sortWithinPartitions("sort_key", "file", "offset")
    return folder, stage(entries.mapInArrow(_write_index(folder), "file string, first string, last string"), "index")


def look_up(folder: str, index: DataFrame, captures: DataFrame, key: str = "page_id", url: str = "url", keep_payload: bool = False) -> DataFrame:
    """The records of captures, given as (key, url): page_id, payload_bytes,
    payload_digest, record_type, refers_to; with keep_payload also the payload of responses.

    Captures are made distinct, sorted and range-partitioned, so a task walks along a stretch of
    the index. The list of index files (one row each) is broadcast. A capture that is not
    in the archive gives no row; several records of one capture give a row each.
    """
    spark, kind = captures.sparkSession, captures.schema[key].dataType.simpleString()
    files = sorted((r["first"].encode(), r["last"].encode(), r["file"]) for r in index.toLocalIterator())
    shared = spark.sparkContext.broadcast(files)
    wanted = captures.select(_sort_key(F.col(f"`{url}`"), F.col(f"`{key}`")).alias("sort_key")).distinct()
    wanted = wanted.repartitionByRange(max(len(files), 1), "sort_key").sortWithinPartitions("sort_key")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * keep_payload
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()] + [pa.binary()] * keep_payload

    def read(batches):
        found, archives = Index(folder, shared.value), Archives(folder)
        for batch in batches:
            out, size = [], 0
            for sort_key in batch.column(0).cast(pa.binary()).to_pylist():
                for place in found.find(sort_key):
                    fields = archives.read(*place)
                    out.append([fields[n] for n in names])
                    size += len(fields["payload"] or b"") if keep_payload else 1
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                        out, size = [], 0
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    ddl = "page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string" + ", payload binary" * keep_payload
    out = wanted.mapInArrow(read, ddl)
    return out.withColumns({"page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind)})
