"""Deleted interpolation: n-gram estimates mixed by the frequency of their context.

The corpus is cut into parts of bounded size. A part keeps its own sorted vocabulary,
and only hashes and counts travel: distinct words, then distinct pairs of words, go out by
bucket of their hash, are added up, and the sums come back to the part, so no task and no
broadcast holds the vocabulary or the pairs of the corpus.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from milepost.llm.arrow import lower_words, utf8
from milepost.session import stage

PART_BYTES = 8 << 20  # text in a part
ROW_TOKENS = 1 << 18  # tokens in a stored row
BUCKET_WORDS = 2_000_000  # vocabulary entries that a bucket sums up, about
BUCKET_PAIRS = 2_000_000  # distinct pairs of parts that a bucket sums up, at most on average
OCTAVES = 41  # powers of two of a count
FINE = 32  # held-out estimates are told apart by 1/FINE of an octave when weights are learned
DEFAULT_WEIGHTS = (0.1, 0.4, 0.5)  # uniform, word, pair: of an octave without held-out tokens
SHARE = 1 << 20  # shares are added up in whole numbers of 1/SHARE
LEAST_UNSEEN = 1e-6  # weight that the uniform distribution always has
_END = b"\xff"  # the token after the last word; never a word


def squeeze(ids: np.ndarray) -> bytes:
    """32-bit numbers byte plane by byte plane, compressed: the high bytes are mostly zero."""
    return pa.compress(np.ascontiguousarray(ids.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def unsqueeze(data, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<i4").reshape(n)


def pack(values: np.ndarray) -> bytes:
    """64-bit numbers byte plane by byte plane, compressed, after their number."""
    planes = np.ascontiguousarray(values.astype("<i8", copy=False).view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(values).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=8 * n, codec="zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<i8").reshape(n)


def pack_sorted(hashes: np.ndarray) -> bytes:
    return pack(np.diff(hashes, prepend=np.uint64(0)).view(np.int64))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data).view(np.uint64), dtype=np.uint64)


def _part(part: int, keys: pa.Array, folds: np.ndarray, texts: list) -> list[dict]:
    """One part's rows: tokens as numbers into its vocabulary, which is sorted by hash."""
    sizes, words = lower_words(texts)
    coded = words.dictionary_encode()
    known = [_END, *coded.dictionary.cast(pa.large_binary()).to_pylist()]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
    order = np.argsort(hashes, kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    stops = np.cumsum(sizes + 1)
    ids = np.full(int(stops[-1]), place[0], np.int32)
    is_word = np.ones(len(ids), bool)
    is_word[stops - 1] = False
    ids[is_word] = place[1:][coded.indices.to_numpy(zero_copy_only=False)]
    fold_of = np.repeat(folds, sizes + 1)
    counts = [np.bincount(ids[fold_of <= f], minlength=len(order)).astype(np.uint32) for f in (0, 1)]  # keep, train
    rows, begin = [], 0
    firsts = np.concatenate([[0], stops[:-1]])
    while begin < len(sizes):
        end = max(begin + 1, int(np.searchsorted(stops, firsts[begin] + ROW_TOKENS, side="right")))
        rows.append({
            "part": part, "keys": keys[begin:end], "folds": folds[begin:end].astype(np.int32), "sizes": (sizes + 1)[begin:end].astype(np.int32),
            "ids": squeeze(ids[firsts[begin] : stops[end - 1]]), "words": 0, "kept": 0, "train": 0, "hashes": None, "counts": None,
        })
        begin = end
    rows[0] |= {
        "words": len(order), "kept": int(counts[0].sum()), "train": int(counts[1].sum()),
        "hashes": pack_sorted(hashes[order]), "counts": pack(np.concatenate(counts)),
    }
    return rows


def _tokenise(docs: DataFrame, key: str, text: str, folds: int, fold: int) -> DataFrame:
    """Parts with their vocabularies. folds: 0 counted, 1 for the weights, 2 held out."""
    kind = docs.schema[key].dataType
    crc = F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")))
    of_doc = F.when(F.pmod(crc, F.lit(folds)) == fold, 2).when(F.pmod(F.floor(crc / folds), F.lit(10)) == 0, 1).otherwise(0)
    rows = docs.select(F.col(f"`{key}`").alias("key"), of_doc.alias("fold"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    schema = pa.schema([
        ("part", pa.int64()), ("keys", pa.list_(to_arrow_type(kind))), ("folds", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())), ("ids", pa.binary()),
        ("words", pa.int64()), ("kept", pa.int64()), ("train", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary()),
    ])

    def run(batches):
        task, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close():
            table = pa.Table.from_batches(held).combine_chunks()
            columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (table["key"], table["fold"], table["text"])]
            out = _part(task << 24 | made, columns[0], columns[1].to_numpy(), utf8(columns[2]))
            for row in out:
                row["keys"] = row["keys"].to_pylist()
                yield pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            lengths = pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False)
            begin = 0
            while begin < batch.num_rows:
                upto = begin + max(1, int(np.searchsorted(np.cumsum(lengths[begin:]), PART_BYTES - size)))
                held.append(batch.slice(begin, upto - begin))
                size += int(lengths[begin:upto].sum())
                begin = upto
                if size >= PART_BYTES:
                    yield from close()
                    made, held, size = made + 1, [], 0
        if held:
            yield from close()

    ddl = (
        f"part bigint, keys array<{kind.simpleString()}>, folds array<int>, sizes array<int>, ids binary, "
        "words bigint, kept bigint, train bigint, hashes binary, counts binary"
    )
    return rows.mapInArrow(run, ddl)


def _spans(hashes: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, begin, end) of sorted hashes, by their first `bits` bits."""
    if not len(hashes):
        return []
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    cuts = (np.flatnonzero(np.diff(bucket)) + 1).tolist()
    return [(int(bucket[a]), a, b) for a, b in zip([0, *cuts], [*cuts, len(hashes)])]


def _added(rows: list[dict]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's rows added up: each row's own counts (kept and train), the place of every
    row's hashes among the distinct ones, sums per distinct hash, rows that have it."""
    own = [unpack(r["counts"]).reshape(2, -1) for r in rows]
    distinct, place = np.unique(np.concatenate([unpack_sorted(r["hashes"]) for r in rows]), return_inverse=True)
    sums = np.array([np.bincount(place, c, len(distinct)) for c in np.concatenate(own, axis=1)]).astype(np.int64)
    return own, place, sums, np.bincount(place, minlength=len(distinct))


def _binary_rows(rows: list[tuple]) -> pa.Table:
    parts, buckets, counts = zip(*rows)
    return pa.table({"part": pa.array(parts, pa.int64()), "bucket": pa.array(buckets, pa.int64()), "counts": pa.array(counts, pa.binary())})


def _totals(parts: DataFrame, bits: int) -> DataFrame:
    """Counts of the whole corpus for every part's words, in the order of its vocabulary:
    (part, bucket, counts: kept, train, and whether other parts have the word). Rows with
    part -1 have a bucket's distinct train and kept words."""

    def spread(batches):
        for batch in batches:
            for row in batch.to_pylist():
                hashes, counts = unpack_sorted(row["hashes"]), unpack(row["counts"]).reshape(2, -1)
                spans = _spans(hashes, bits)
                for at in range(0, len(spans), 256):
                    some = spans[at : at + 256]
                    yield pa.RecordBatch.from_pydict({
                        "bucket": [k for k, _, _ in some], "part": [row["part"]] * len(some),
                        "hashes": [pack_sorted(hashes[a:b]) for _, a, b in some], "counts": [pack(counts[:, a:b].ravel()) for _, a, b in some],
                    })

    def add(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own, place, sums, holders = _added(rows)
        out, at, bucket = [], 0, rows[0]["bucket"]
        for row, counts in zip(rows, own):
            of = place[at : at + counts.shape[1]]
            at += len(of)
            out.append((row["part"], bucket, pack(np.concatenate([*sums[:, of], holders[of] > 1]))))
        out.append((-1, bucket, pack(np.array([(sums[1] > 0).sum(), (sums[0] > 0).sum()]))))
        return _binary_rows(out)

    vocabularies = parts.where("hashes is not null").select("part", "hashes", "counts")
    sent = vocabularies.mapInArrow(spread, "bucket bigint, part bigint, hashes binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(add, "part bigint, bucket bigint, counts binary")


def _words(totals: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word of a part: kept count, train count, whether other parts have it."""
    kept, train, many = np.concatenate([unpack(r["counts"]).reshape(3, -1) for r in sorted(totals, key=lambda r: r["bucket"])], axis=1)
    return kept, train, many > 0


def _rows(tokens: pa.Table):
    """(keys, folds, sizes, ids) of each stored row; no keys if they were left out."""
    for i in range(tokens.num_rows):
        yield (
            tokens["keys"][i].values if "keys" in tokens.column_names else None, tokens["folds"][i].values.to_numpy(), tokens["sizes"][i].values.to_numpy(),
            unsqueeze(tokens["ids"][i].as_buffer(), int(tokens["sizes"][i].values.to_numpy().sum())),
        )


def _contexts(kind: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """The token before each token; the end stands before a text's first word."""
    before = np.empty_like(kind)
    before[1:] = kind[:-1]
    before[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = end
    return before


@dataclass
class Pairs:
    """The distinct pairs of a part, in the order of their hash."""

    context: np.ndarray  # place of the first word in the part's vocabulary
    word: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray  # the part's own: kept and train
    of_token: np.ndarray  # the pair that each token ends, row after row
    sent: np.ndarray  # other parts may have the pair, or it has a held-out count


def _pairs(tokens: pa.Table, many: np.ndarray) -> Pairs:
    size, codes, folds = len(many), [], []
    for _, folds_, sizes, ids in _rows(tokens):
        ids = ids.astype(np.int64)
        codes.append(_contexts(ids, sizes, ids[-1]) * size + ids)  # a row's last token is an end
        folds.append(np.repeat(folds_, sizes))
    code, of_token = np.unique(np.concatenate(codes), return_inverse=True)
    fold = np.concatenate(folds)
    counts = np.array([np.bincount(of_token[fold <= f], minlength=len(code)) for f in (0, 1)])
    context, word = code // size, code % size
    known = next(unpack_sorted(x) for x in tokens["hashes"].to_pylist() if x is not None)
    hashes = known[context] * np.uint64(0x9E3779B97F4A7C15) + known[word]
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(32)
    order = np.argsort(hashes, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    context, word, counts = context[order], word[order], counts[:, order]
    return Pairs(context, word, hashes[order], counts, place[of_token], (many[context] & many[word]) | (counts[1] > counts[0]))


def _octave(count: np.ndarray) -> np.ndarray:
    return np.frexp(count.astype(float))[1].clip(0, OCTAVES + 1)


def _cells(context: np.ndarray, word: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Kept counts of held-out pairs on a grid: octave of the context's count, FINE steps per
    octave of the word's count and of the pair's share of its context; step 0 is a count of 0."""
    fine = lambda x, seen: np.where(seen, 1 + np.rint(FINE * np.log2(np.where(seen, x, 1))), 0).astype(np.int64)
    return (_octave(context).astype(np.int64) << 24) | (fine(word, word > 0) << 12) | fine(context / np.maximum(pair, 1), pair > 0)


def _of_octave(table: pa.Table, tokens: int, types: int) -> pa.Table:
    """The weights of one octave of the context's count, learned from its cells: their held-out
    counts n, and the words' counts and the pairs' shares, summed up over these."""
    octave, n = int(table["cell"][0].as_py() >> 24), table["n"].to_numpy().astype(float)
    of_word, of_pair = (table[c].to_numpy() / n for c in ("word", "share"))
    p = np.stack([np.full(len(n), 1 / (types + 1)), of_word / max(tokens, 1), of_pair / SHARE], axis=1)
    found = _maximise(np.full(len(n), octave), n, p)[octave]
    return pa.table({"octave": pa.array([octave], pa.int32()), **{f"w{j}": pa.array([found[j]]) for j in range(3)}})


def _pair_sums(parts: DataFrame, per_part: DataFrame, bits: int) -> DataFrame:
    """Train counts of the whole corpus for the sent pairs of every part, in the order of their
    hash: (part, bucket, counts). Rows with part -1 have a bucket's held-out pairs: cells and
    their counts."""

    def ask(tokens: pa.Table, own: pa.Table) -> pa.Table:
        kept, _, many = _words(own.to_pylist())
        pairs = _pairs(tokens, many)
        context, word, hashes, counts = pairs.context[pairs.sent], pairs.word[pairs.sent], pairs.hashes[pairs.sent], pairs.counts[:, pairs.sent]
        held, spans = counts[1] > counts[0], _spans(hashes, bits)
        return pa.table({
            "bucket": pa.array([k for k, _, _ in spans], pa.int64()), "part": pa.array([tokens["part"][0].as_py()] * len(spans), pa.int64()),
            "hashes": pa.array([pack_sorted(hashes[a:b]) for _, a, b in spans], pa.binary()),
            "counts": pa.array([pack(counts[:, a:b].ravel()) for _, a, b in spans], pa.binary()),
            "held": pa.array([pack(np.concatenate([kept[x[a:b][held[a:b]]] for x in (context, word)])) for _, a, b in spans], pa.binary()),
        })

    def add(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own, place, sums, _ = _added(rows)
        out, at, bucket = [], 0, rows[0]["bucket"]
        words = np.zeros((2, sums.shape[1]), np.int64)  # kept counts of the context and the word, where held out
        for row, counts in zip(rows, own):
            of = place[at : at + counts.shape[1]]
            at += len(of)
            words[:, of[counts[1] > counts[0]]] = unpack(row["held"]).reshape(2, -1)
            out.append((row["part"], bucket, pack(sums[1][of])))
        held = np.flatnonzero(sums[1] > sums[0])
        words, pair, n = words[:, held], sums[0][held], (sums[1] - sums[0])[held]
        cells, which = np.unique(_cells(words[0], words[1], pair), return_inverse=True)
        # What the members of a cell come to on average, so that the grid costs next to nothing.
        share = np.rint(SHARE * pair / np.maximum(words[0], 1))
        added = [np.bincount(which, n * x, len(cells)).astype(np.int64) for x in (1, words[1], share)]
        out.append((-1, bucket, pack(np.concatenate([cells, *added]))))
        return _binary_rows(out)

    slim = parts.select("part", "folds", "sizes", "ids", "hashes")
    asked = slim.groupBy("part").cogroup(per_part).applyInArrow(ask, "bucket bigint, part bigint, hashes binary, counts binary, held binary")
    return asked.groupBy("bucket").applyInArrow(add, "part bigint, bucket bigint, counts binary")


def _weights(sums: DataFrame, tokens: int, types: int) -> np.ndarray:
    """Mixture weights per octave of the context's count. Each octave is learned in a task of its own,
    from at most a fixed grid of cells; one row per octave reaches the driver."""

    def flat(batches):
        for batch in batches:
            for row in batch.to_pylist():
                cells, *added = unpack(row["counts"]).reshape(4, -1)
                columns = {c: x.astype(float) for c, x in zip(("n", "word", "share"), added)}
                yield pa.RecordBatch.from_pydict({"octave": pa.array(cells >> 24, pa.int32()), "cell": cells, **columns})

    cells = sums.where("part = -1").select("counts").mapInArrow(flat, "octave int, cell bigint, n double, word double, share double")
    cells = cells.groupBy("octave", "cell").agg(*[F.sum(c).alias(c) for c in ("n", "word", "share")])
    learned = cells.groupBy("octave").applyInArrow(lambda t: _of_octave(t.sort_by("cell"), tokens, types), "octave int, w0 double, w1 double, w2 double")
    weights = np.tile(DEFAULT_WEIGHTS, (OCTAVES + 2, 1))
    for row in learned.collect():
        weights[row["octave"]] = row[1:]
    return weights


def mix(weights: np.ndarray, tokens: int, types: int, context: np.ndarray, word: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Probability of words from the counts of their context, of themselves, and of both."""
    w = weights[_octave(context)]
    return w[:, 0] / (types + 1) + w[:, 1] * word / max(tokens, 1) + w[:, 2] * pair / np.maximum(context, 1)


def _maximise(at: np.ndarray, n: np.ndarray, p: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Weights per bucket `at` by expectation-maximisation, where `n` held-out tokens have the
    estimates `p`. A bucket without held-out tokens has default weights."""
    buckets = OCTAVES + 2
    weights = np.tile(DEFAULT_WEIGHTS, (buckets, 1))
    seen = np.bincount(at, n, buckets)
    for _ in range(rounds):
        share = weights[at] * p
        share *= (n / np.maximum(share.sum(1), 1e-300))[:, None]
        new = np.stack([np.bincount(at, share[:, j], buckets) for j in range(3)], axis=1) + 1e-9
        weights = np.where(seen[:, None] > 0, new / new.sum(1, keepdims=True), weights)
    weights[:, 0] = np.maximum(weights[:, 0], LEAST_UNSEEN)
    return weights / weights.sum(1, keepdims=True)


def _kinds(batches):
    for batch in batches:
        found = np.array([unpack(c) for c in batch.column(0).to_pylist()], np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_pydict({"train": found[:, 0], "kept": found[:, 1]})


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 5, fold: int = 1) -> DataFrame:
    """Score whole texts with a model of those whose crc32(key as text) mod `folds` is not `fold`.

    Tokens are runs of anything but ASCII white space, A-Z lower-cased, and one end. The
    model mixes uniform, word and word-pair estimates; every pair of words keeps its own count.
    Nine tenths of the training texts are counted; the weights, one set per octave of the
    context's count, come from the words of the last tenth (deleted from the counts) by
    expectation-maximisation over their estimates, which are averaged within 1/FINE of an octave. Texts are
    then scored with the counts of all training texts.

    Words and pairs go to buckets of their hash and sums come back per part; the driver gets a few
    totals and the weights, one row per octave. Returns key, held_out, n_tokens,
    n_known (tokens seen in training), train_tokens, base_score (add-half word model), score
    (log10 probability).

    A null text is empty: one token, the end. A null key counts as '' for the fold; repeated
    keys are documents of their own. An empty table gives no rows. Other columns are not used.
    """
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    parts = stage(_tokenise(docs, key, text, folds, fold), "tokens")
    length = F.expr("aggregate(sizes, 0L, (a, x) -> a + x)")
    sums = parts.agg(F.sum("words"), F.sum("kept"), F.sum("train"), F.sum(length)).first()
    words, n_kept, n_train, n_tokens = (x or 0 for x in sums)
    bits = lambda n, most: max(6, int(n // most).bit_length())
    totals = stage(_totals(parts, bits(words, BUCKET_WORDS)), "totals")
    types = totals.where("part = -1").select("counts").mapInArrow(_kinds, "train bigint, kept bigint")  # one row per bucket
    n_types, kept_types = (x or 0 for x in types.agg(F.sum("train"), F.sum("kept")).first())
    per_part = totals.where("part >= 0")
    pairs = stage(_pair_sums(parts, per_part.groupBy("part"), bits(n_tokens, BUCKET_PAIRS)), "pairs")
    weights = _weights(pairs, n_kept, kept_types)
    model = spark.sparkContext.broadcast(weights)
    base_total = n_train + 0.5 * (n_types + 1)

    def rate(tokens: pa.Table, own: pa.Table) -> pa.Table:
        rows = own.to_pylist()
        _, train, many = _words([r for r in rows if not r["of_pairs"]])
        base = np.log10((train + 0.5) / base_total)
        pairs = _pairs(tokens, many)
        count = pairs.counts[1].copy()
        received = sorted((r for r in rows if r["of_pairs"]), key=lambda r: r["bucket"])
        count[pairs.sent] = np.concatenate([np.zeros(0, np.int64), *(unpack(r["counts"]) for r in received)])
        of_pair = np.log10(mix(model.value, n_train, n_types, train[pairs.context], train[pairs.word], count))
        out, at = [], 0
        for keys, folds_, sizes, ids in _rows(tokens):
            p = of_pair[pairs.of_token[at : at + len(ids)]]
            at += len(ids)
            begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            add = lambda values: np.add.reduceat(values, begins)  # noqa: E731  every text has a token
            out.append(pa.table({
                "key": keys, "held_out": pa.array(folds_ == 2), "n_tokens": pa.array(sizes, pa.int64()),
                "n_known": pa.array(add((train[ids] > 0).astype(np.int64))), "train_tokens": pa.array(np.full(len(sizes), n_train, np.int64)),
                "base_score": pa.array(add(base[ids])), "score": pa.array(add(p)),
            }))
        return pa.concat_tables(out)

    slim = parts.select("part", "keys", "folds", "sizes", "ids", "hashes")
    per_part = per_part.withColumn("of_pairs", F.lit(False)).unionByName(pairs.where("part >= 0").withColumn("of_pairs", F.lit(True))).groupBy("part")
    ddl = f"key {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return slim.groupBy("part").cogroup(per_part).applyInArrow(rate, ddl).withColumnRenamed("key", key)
