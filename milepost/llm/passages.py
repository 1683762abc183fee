"""Passages that occur twice, found by distributed prefix doubling over sampled positions."""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from milepost.llm.arrow import schema_of, slices, utf8
from milepost.llm.jaccard import broadcast_if_small
from milepost.session import stage

SEGMENT = 1 << 21  # positions looked at together; longer texts go through in segments
CHUNK = 8 << 20  # bytes of text that are kept together
BUCKET = 32 << 20  # bytes of text whose names are ranked in one task

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_PLACE = np.uint64((1 << 22) - 1)  # a position within a segment
_NONE = np.zeros(0, np.uint64)


class Plan:
    """Lengths of the rounds for passages of `length` bytes.

    A window is a string of `length` bytes. Each is represented by the position of its least
    8-byte string among its first `reach` ones, which its content alone decides; equal
    windows therefore lie alike around their representatives, and neighbouring windows share
    theirs. The strings that begin at a representative and lie in all its windows have `base` bytes in
    the first round and twice as many in the second.
    """

    def __init__(self, length: int, segment: int = SEGMENT, chunk: int = CHUNK):
        if length < 32:
            raise ValueError("passages have 32 bytes at least")
        self.segment, self.chunk = segment, chunk
        self.length, self.reach = length, length // 4
        self.base = 1 << (((length - self.reach + 1) // 2).bit_length() - 1)
        self.first_reach = length - self.base + 1


def _words(data: bytes) -> np.ndarray:
    """The 8 bytes that begin at each position, as numbers."""
    data += bytes(16)
    return np.ndarray((len(data) - 15,), "<u8", buffer=data, strides=(1,)).copy()


def _names(words: np.ndarray, at: np.ndarray, length: int, kind: int = 0) -> np.ndarray:
    """Fingerprints of the strings of `length` bytes at the positions `at`."""
    out = np.full(len(at), _ODD[kind] ^ np.uint64(length), np.uint64)
    for place in [*range(0, length - 8, 8), length - 8]:
        out ^= words[at + place]
        out *= _ODD[(kind + 1) % 3]
        out ^= out >> np.uint64(29)
    return out


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = (a * _ODD[1]) ^ b
    out ^= out >> np.uint64(32)
    out *= _ODD[2]
    return out ^ (out >> np.uint64(29))


def segments(texts: list, plan: Plan):
    """Texts in buffers of about plan.segment bytes: (bytes, begins in it, windows, text, offset in the text).
    Every window lies whole in one buffer."""
    parts, held, length = [], 0, plan.length
    for k, data in enumerate(texts):
        for at in range(0, len(data or b"") - length + 1, plan.segment):
            part = data[at : at + plan.segment + length - 1]
            if held and held + len(part) > plan.segment + length:
                yield _buffer(parts, length)
                parts, held = [], 0
            parts.append((part, k, at))
            held += len(part)
    if parts:
        yield _buffer(parts, length)


def _buffer(parts: list, length: int):
    sizes = np.array([len(p) for p, _, _ in parts], np.int64)
    text, offset = (np.array([p[i] for p in parts], np.int64) for i in (1, 2))
    return b"".join(p for p, _, _ in parts), np.cumsum(sizes) - sizes, sizes - length + 1, text, offset


def runs(words: np.ndarray, begins: np.ndarray, windows: np.ndarray, reach: int):
    """(first window, last window, representative, part) of the windows that share one."""
    least = words * _ODD[0]
    least ^= least >> np.uint64(32)
    least *= _ODD[1]
    least &= ~_PLACE
    least |= np.arange(len(least), dtype=np.uint64)
    size = 1
    while size < reach:  # the least of a window from those of its two halves
        step = min(size, reach - size)
        least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
        size += step
    place = least & _PLACE
    first = np.union1d(np.flatnonzero(place[1:] != place[:-1]) + 1, begins)
    part = np.searchsorted(begins, first, side="right") - 1
    end = (begins + windows)[part]
    fine = first < end
    last = np.minimum(np.append(first[1:], len(words)), end) - 1
    return first[fine], last[fine], place[first[fine]].astype(np.int64), part[fine]


def _distinct(high: np.ndarray, low: np.ndarray):
    """Sorted distinct pairs: (high, low, number of each input pair, how often each occurs)."""
    if not len(high):
        return high, low, np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((low, high))
    h, w = high[order], low[order]
    new = np.append(True, (h[1:] != h[:-1]) | (w[1:] != w[:-1]))
    number = np.empty(len(h), np.int64)
    number[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    return h[at], w[at], number, np.diff(np.append(at, len(h)))


def _blocks(high: np.ndarray, buckets: int):
    """(bucket, begin, end) of sorted names, by ranges of their values."""
    bucket = ((high >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
    return [(int(bucket[a]), a, b) for a, b in zip(at, [*at[1:], len(bucket)])]


def _rows(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _joined(table, name: str, kind) -> np.ndarray:
    """A binary column's values, one after the other."""
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


# --- first round: names of `base` bytes; which documents have one that occurs again ------------

_SCAN = "chunk bigint, doc int, hash bigint, n_bytes bigint, kept_sha256 string, again boolean, names binary, docs binary"


def _scan(batches, plan: Plan, out: pa.Schema):
    """A row per document, and a row per chunk with its distinct names: those of one document
    with its number, those met more often (their documents are marked) with -1."""
    made, task = 0, TaskContext.get().partitionId() << 32

    def chunk(keys, hashes, texts):
        names, owners = [_NONE], [np.zeros(0, np.int64)]
        for data, begins, windows, text, _ in segments(texts, plan):
            words = _words(data)
            _, _, at, part = runs(words, begins, windows, plan.first_reach)
            names.append(_names(words, at, plan.base))
            owners.append(text[part])
        names, owners = np.concatenate(names), np.concatenate(owners)
        found, _, number, times = _distinct(names, np.zeros(len(names), np.uint8))
        several = times > 1
        again = np.zeros(len(texts), bool)
        again[owners[several[number]]] = True
        owner = np.full(len(found), -1, "<i4")
        owner[number] = owners
        owner[several] = -1
        rows = [
            (key, task + made, k, h, len(t or b""), hashlib.sha256(t or b"").hexdigest(), a, None, None)
            for k, (key, h, t, a) in enumerate(zip(keys, hashes, texts, again.tolist()))
        ]
        rows.append((None, task + made, None, None, None, None, None, found.tobytes(), owner.tobytes()))
        return _rows(rows, out)

    keys, hashes, texts, size = [], [], [], 0
    for batch in slices(batches, 100):
        keys += batch.column(0).to_pylist()
        hashes += batch.column(1).to_pylist()
        texts += (new := utf8(batch.column(2)))
        size += sum(len(t) for t in new if t)
        if size >= plan.chunk or len(keys) >= 50_000:
            yield chunk(keys, hashes, texts)
            keys, hashes, texts, size, made = [], [], [], 0, made + 1
    if keys:
        yield chunk(keys, hashes, texts)


def _send_names(batches, buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("names", pa.binary()), ("docs", pa.binary())])
    for batch in batches:
        for chunk, names, docs in zip(*(batch.column(c).to_pylist() for c in ("chunk", "names", "docs"))):
            high = np.frombuffer(names, "<u8")
            yield _rows([(b, chunk, names[8 * i : 8 * j], docs[4 * i : 4 * j]) for b, i, j in _blocks(high, buckets)], schema)


def _again(table: pa.Table) -> pa.Table:
    """The (chunk, doc) whose names occur again in this bucket."""
    names, docs = _joined(table, "names", "<u8"), _joined(table, "docs", "<i4")
    sizes = [len(x) // 8 for x in table["names"].to_pylist()]
    chunk = np.repeat(table["chunk"].to_numpy(), sizes)
    _, _, number, times = _distinct(names, np.zeros(len(names), np.uint8))
    several = times > 1
    several[number[docs < 0]] = True
    hit = several[number] & (docs >= 0)
    chunk, docs, _, _ = _distinct(chunk[hit], docs[hit])
    return pa.table({"chunk": pa.array(chunk, pa.int64()), "doc": pa.array(docs, pa.int32())})


# --- second and third round: 2 * base bytes, then all windows of a representative --------------


def _gather(batches, plan: Plan, out: pa.Schema):
    """Documents in chunks of about plan.chunk bytes."""
    made, task = 0, TaskContext.get().partitionId() << 32
    keys, texts, size = [], [], 0
    for batch in slices(batches, 100):
        keys += batch.column(0).to_pylist()
        texts += (new := utf8(batch.column(1)))
        size += sum(map(len, new))
        if size >= plan.chunk:
            yield _rows([(task + made, size, keys, texts)], out)
            keys, texts, size, made = [], [], 0, made + 1
    if keys:
        yield _rows([(task + made, size, keys, texts)], out)


def _ranges(texts: list, plan: Plan):
    """All runs of a chunk: text, first and last window in it, and the pair of names: of the 2 * base
    bytes at the representative, and of everything that the run's windows cover."""
    found = [(np.zeros(0, np.int64),) * 3 + (_NONE,) * 2]
    for data, begins, windows, text, offset in segments(texts, plan):
        words = _words(data)
        first, last, at, part = runs(words, begins, windows, plan.reach)
        common = _pair(_names(words, at, plan.base), _names(words, at + plan.base, plan.base))
        shape = ((at - first) << 32 | (last - first)).astype(np.uint64)
        whole = _pair(_pair(_names(words, first, plan.length, 1), _names(words, last, plan.length, 1)), shape)
        shift = (offset - begins)[part]
        found.append((text[part], first + shift, last + shift, common, whole))
    return [np.concatenate(x) for x in zip(*found)]


_PAIRS = "bucket int, chunk bigint, high binary, low binary, twice binary"
_PAIR_ROWS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("high", pa.binary()), ("low", pa.binary()), ("twice", pa.binary())])


def _pair_rows(chunk: int, high, low, twice, buckets: int) -> list:
    return [(b, chunk, high[i:j].tobytes(), low[i:j].tobytes(), twice[i:j].tobytes()) for b, i, j in _blocks(high, buckets)]


def _send_pairs(batches, plan: Plan, buckets: int):
    for batch in batches:
        for i in range(batch.num_rows):
            texts = batch.column("texts")[i].as_py()
            _, _, _, common, whole = _ranges(texts, plan)
            high, low, _, times = _distinct(common, whole)
            yield _rows(_pair_rows(batch.column("chunk")[i].as_py(), high, low, times > 1, buckets), _PAIR_ROWS)


ALONE, REPEATED, OPEN, SHOWN = range(4)
_RANKED = "chunk bigint, bucket int, ranks binary"


def _ranked(table: pa.Table, ranks: np.ndarray) -> pa.Table:
    sizes = [len(x) for x in table["twice"].to_pylist()]
    ends = np.cumsum(sizes).tolist()
    cut = [ranks[e - n : e].tobytes() for e, n in zip(ends, sizes)]
    return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "ranks": pa.array(cut, pa.binary())})


def _rank_pairs(table: pa.Table) -> pa.Table:
    """Sorts the pairs of a bucket and tells of each: ALONE (its first half is unique), REPEATED (the pair
    itself occurs again), OPEN (only the first half does: its windows must be compared), or
    SHOWN (repeated, and its windows stand for all equal ones in the comparison)."""
    high, low, twice = _joined(table, "high", "<u8"), _joined(table, "low", "<u8"), _joined(table, "twice", bool)
    pairs, _, number, times = _distinct(high, low)
    times = times + np.bincount(number, weights=twice, minlength=len(pairs)).astype(np.int64)
    new = np.append(True, pairs[1:] != pairs[:-1])
    half = np.cumsum(new) - 1
    mixed = np.bincount(half)[half] > 1
    of_pair = np.where(times > 1, REPEATED, np.where(mixed, OPEN, ALONE)).astype(np.uint8)
    ranks = of_pair[number]
    shown = np.unique(number, return_index=True)[1]
    shown = shown[(mixed & (times > 1))]
    ranks[shown] = SHOWN
    return _ranked(table, ranks)


def _by_bucket(table: pa.Table) -> np.ndarray:
    """The answers to a chunk's sorted names, in their order."""
    rows = sorted(zip(table["bucket"].to_pylist(), table["ranks"].to_pylist()))
    return np.frombuffer(b"".join(r for _, r in rows), np.uint8)


def _window_names(texts: list, text: np.ndarray, first: np.ndarray, last: np.ndarray, plan: Plan):
    """Two names of every window of the given runs, in order."""
    out, parts, held, length = [(_NONE, _NONE)], [], 0, plan.length

    def take():
        data = b"".join(parts)
        sizes = np.array([len(p) for p in parts], np.int64)
        count = sizes - length + 1
        begin = np.cumsum(sizes) - sizes
        at = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
        words = _words(data)
        out.append((_names(words, at, length, 1), _names(words, at, length, 2)))

    for k, a, b in zip(text.tolist(), first.tolist(), last.tolist()):
        parts.append(texts[k][a : b + length])
        held += len(parts[-1])
        if held >= plan.segment:
            take()
            parts, held = [], 0
    if parts:
        take()
    return [np.concatenate(x) for x in zip(*out)]


_STEP = f"{_PAIRS}, text binary, first binary, last binary, rank binary"


def _open_windows(key, texts: pa.Table, ranks: pa.Table, plan: Plan, buckets: int, out: pa.Schema) -> pa.Table:
    """A chunk after the pairs are ranked: its runs that are not alone, and the names of the windows
    that are still open."""
    chunk, texts = key[0].as_py(), texts["texts"][0].as_py()
    text, first, last, common, whole = _ranges(texts, plan)
    rank = _by_bucket(ranks)[_distinct(common, whole)[2]]
    shown = np.flatnonzero(rank == SHOWN)
    rest = np.setdiff1d(shown, shown[np.unique(whole[shown], return_index=True)[1]])
    rank = rank.copy()
    rank[rest] = REPEATED  # equal runs of one chunk need to be shown once
    at = np.flatnonzero(rank >= OPEN)
    high, low = _window_names(texts, text[at], first[at], last[at], plan)
    pairs, lows, number, times = _distinct(high, low)
    twice = times > 1
    twice[number[np.repeat(rank[at] == SHOWN, last[at] - first[at] + 1)]] = True
    kept = np.flatnonzero(rank != ALONE)
    state = [x[kept].astype(kind).tobytes() for x, kind in ((text, "<i4"), (first, "<i8"), (last, "<i8"), (rank, "u1"))]
    rows = [(*r, None, None, None, None) for r in _pair_rows(chunk, pairs, lows, twice, buckets)]
    return pa.Table.from_batches([_rows([*rows, (None, chunk, None, None, None, *state)], out)])


def _rank_windows(table: pa.Table) -> pa.Table:
    high, low, twice = _joined(table, "high", "<u8"), _joined(table, "low", "<u8"), _joined(table, "twice", bool)
    pairs, _, number, times = _distinct(high, low)
    times = times + np.bincount(number, weights=twice, minlength=len(pairs)).astype(np.int64)
    return _ranked(table, (times > 1).astype(np.uint8)[number])


# --- the end: covered bytes ------------------------------------------------------------------


def _union(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal covered ranges, in order."""
    order = np.argsort(begin, kind="stable")
    begin, upto = begin[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.append(True, begin[1:] > upto[:-1]))
    return list(zip(begin[new].tolist(), upto[np.append(new[1:], len(begin)) - 1].tolist()))


def _cut(key, texts: pa.Table, found: pa.Table, plan: Plan, out: pa.Schema, keep_text: bool) -> pa.Table:
    """A chunk's documents without the bytes that repeated windows cover."""
    keys, texts = texts["keys"].combine_chunks().flatten(), texts["texts"][0].as_py()
    state = found.filter(pc.is_valid(found["text"]))
    answers = _by_bucket(found.filter(pc.is_valid(found["bucket"])))
    text, first, last, rank = (_joined(state, c, kind) for c, kind in (("text", "<i4"), ("first", "<i8"), ("last", "<i8"), ("rank", "u1")))
    at = np.flatnonzero(rank >= OPEN)
    number = _distinct(*_window_names(texts, text[at], first[at], last[at], plan))[2]
    sizes = last[at] - first[at] + 1
    window = np.repeat(first[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    hit = answers[number] > 0
    whole = np.flatnonzero((rank == REPEATED) | (rank == SHOWN))
    owner = np.concatenate([text[whole], np.repeat(text[at], sizes)[hit]])
    begin = np.concatenate([first[whole], window[hit]])
    end = np.concatenate([last[whole], window[hit]]) + plan.length
    order = np.argsort(owner, kind="stable")
    bounds = np.searchsorted(owner[order], np.arange(len(texts) + 1))
    rows = []
    for k, data in enumerate(texts):
        mine = order[bounds[k] : bounds[k + 1]]
        spans = _union(begin[mine], end[mine]) if len(mine) else []
        edges = [0, *(x for span in spans for x in span), len(data)]
        kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
        removed = len(data) - len(kept)
        spans = [{"start": a, "end": b} for a, b in spans]
        rows.append((len(data), removed, len(spans), hashlib.sha256(kept).hexdigest(), spans, kept if keep_text else None))
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(out)[1:])]
    return pa.Table.from_arrays([keys.cast(out.field(0).type), *columns], schema=out)


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 400, keep_text: bool = False,
    segment: int = SEGMENT, chunk: int = CHUNK, bucket: int = BUCKET,
) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, spans) of every document; with keep_text also
    `kept`, the remaining bytes.

    Removed is every byte covered by a string of `length` bytes that also starts anywhere else in the
    corpus, the same document included. Spans (start, end in bytes) are the maximal removed ranges.

    Distributed prefix doubling: positions are named by the string that begins there, Spark deals
    the names to tasks by ranges of their values, and each task sorts and ranks its own; what is unique drops
    out, and the next round ranks pairs of the former name and a following one. Positions are
    sampled (see Plan): neighbouring windows of `length` bytes share one, so that a hundredth of the bytes
    is named. The rounds compare `base` bytes, which leaves the documents that can share
    anything; twice that, paired with all bytes of the position's windows, which settles
    the inside of repeats; and at last the single windows at their edges. Nothing gathers
    at a frequent string: a chunk of text sends each name once. Equality is that of 128 bits of fingerprints.

    A null text counts as empty, and a text shorter than `length` has nothing to remove. Null
    and repeated keys are documents of their own, repeated rows are repeats of each other. Other columns
    are not read. Memory does not depend on the length of a text beyond the text itself. Empty in, empty out.
    """
    plan = Plan(length, min(segment, SEGMENT), chunk)
    key_type = docs.schema[key].dataType
    own = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("hash"), F.col(f"`{text}`").alias("text"))

    scanned = StructType([StructField("key", key_type)] + schema_of(_SCAN).fields)
    arrow = to_arrow_schema(scanned)
    scan = stage(own.mapInArrow(lambda batches: _scan(batches, plan, arrow), scanned), "names")
    rows, names = scan.where("doc is not null"), scan.where("doc is null").select("chunk", "names", "docs")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = -(-total // bucket) or 1
    sent = names.mapInArrow(lambda batches: _send_names(batches, buckets), "bucket int, chunk bigint, names binary, docs binary")
    again = sent.groupBy("bucket").applyInArrow(_again, "chunk bigint, doc int")
    again = again.unionByName(rows.where("again").select("chunk", "doc")).distinct()
    marked = rows.select("key", "hash", "chunk", "doc").join(again, ["chunk", "doc"], "left_semi").select("key", "hash").distinct()
    marked = stage(marked.withColumnsRenamed({"key": "_key", "hash": "_hash"}), "marked")
    marked = broadcast_if_small(marked, "_key")  # else all texts are shuffled to find theirs
    same = (F.col("hash") == F.col("_hash")) & F.col("key").eqNullSafe(F.col("_key"))

    chunked = StructType(schema_of("chunk bigint, bytes bigint").fields + [StructField("keys", ArrayType(key_type)), StructField("texts", ArrayType(BinaryType()))])
    shape = to_arrow_schema(chunked)
    texts = own.where(F.octet_length("text") >= length).join(marked, same, "left_semi").select("key", "text")
    texts = stage(texts.mapInArrow(lambda batches: _gather(batches, plan, shape), chunked), "texts")
    share = -(-(texts.agg(F.sum("bytes")).first()[0] or 0) // bucket) or 1
    pairs = texts.select("chunk", "texts").mapInArrow(lambda batches: _send_pairs(batches, plan, share), _PAIRS)
    ranks = pairs.groupBy("bucket").applyInArrow(_rank_pairs, _RANKED)
    step = to_arrow_schema(schema_of(_STEP))
    opened = texts.select("chunk", "texts").groupBy("chunk").cogroup(ranks.groupBy("chunk"))
    opened = stage(opened.applyInArrow(lambda k, a, b: _open_windows(k, a, b, plan, share, step), _STEP), "windows")
    windows = opened.where("bucket is not null").select("bucket", "chunk", "high", "low", "twice")
    windows = windows.groupBy("bucket").applyInArrow(_rank_windows, _RANKED)
    found = opened.where("bucket is null").select("chunk", "text", "first", "last", "rank").unionByName(windows, allowMissingColumns=True)

    result = StructType([StructField(key, key_type)] + schema_of("n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start: bigint, end: bigint>>, kept binary").fields)
    final = to_arrow_schema(result)
    done = texts.select("chunk", "keys", "texts").groupBy("chunk").cogroup(found.groupBy("chunk"))
    done = done.applyInArrow(lambda k, a, b: _cut(k, a, b, plan, final, keep_text), result)

    nothing = {"n_removed": F.lit(0).cast(LongType()), "n_spans": F.lit(0).cast(LongType()), "spans": F.array().cast("array<struct<start: bigint, end: bigint>>")}
    if keep_text:
        rest = own.join(marked, same, "left_anti").withColumn("kept", F.coalesce(F.col("text").cast("binary"), F.expr("X''")))
        rest = rest.withColumns({"n_bytes": F.octet_length("kept").cast("bigint"), "kept_sha256": F.sha2("kept", 256)})
    else:
        rest = rows.join(marked, same, "left_anti").withColumn("kept", F.lit(None).cast("binary"))
    rest = rest.withColumns(nothing).withColumnRenamed("key", key).select(result.names)
    whole = done.unionByName(rest)
    return whole if keep_text else whole.drop("kept")
