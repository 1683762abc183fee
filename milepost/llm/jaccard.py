"""Jaccard join of word shingles: a size-aware heavy-light join.

Two sets of similarity 0.75 share most of either. Under one global order, rare shingles first,
they therefore share elements of short prefixes. Light (small) sets enumerate all
fixed-size subsets of their prefix and meet under a common subset; heavy (large) sets
post single elements and meet by scanning inverted lists. Every meeting is checked
on whole sets. Where light ends is chosen by cost.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from milepost.llm.arrow import frugal, lower_words, slices, utf8
from milepost.llm.components import components
from milepost.session import stage

WORDS, PERCENT = 5, 75  # words in a shingle; links have 100 * shared >= PERCENT * union
COMMON = 1 << 19  # shingles known as frequent at most: they only move to the end of the order
LEAST_COMMON = 6  # sets from which a shingle counts as frequent
BATCH_SHINGLES = 2_000_000
BUCKET_DOCS = 8_000  # documents whose shingles one task counts, about
BUCKET_POSTINGS = 500_000  # postings that one task scans, about
LONG = 8  # inverted lists up to here are compared pair by pair; longer ones around pivots first
BLOCK = 1024  # members of an unsettled group that are compared at once
HOT_POSTINGS = 200_000  # a list expected to be longer is scanned in several parts
SEND = 4  # cost of sending a posting, against one comparison
BROADCAST_BYTES = 64 << 20  # rows of ids that are broadcast at most, measured before
ROW_BYTES = 150  # of such a row besides its id
MEMBERS = 500  # sets compared with a pivot in one task, about

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads bits (the finaliser of a 64-bit generator; fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list) -> list[np.ndarray]:
    """Per text (UTF-8 bytes or None) its distinct shingles as sorted 64-bit hashes; none for null or blank."""
    sizes, flat = lower_words(texts)
    coded = flat.dictionary_encode()
    known = coded.dictionary.cast(pa.large_binary()).to_pylist()
    of_word = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
    words = of_word[coded.indices.to_numpy(zero_copy_only=False)]
    rolling = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
    for j in range(WORDS):
        rolling = rolling * _ODD + words[j : j + len(rolling)]
    rolling = _mix(rolling)
    out, begin = [], 0
    for n in sizes.tolist():
        if n >= WORDS:
            found = np.sort(rolling[begin : begin + n - WORDS + 1])
            keep = np.ones(len(found), bool)
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            out.append(found[keep])
        elif n:  # fewer words: the sequence as one, apart from all longer ones
            out.append(np.array([xxhash.xxh3_64_intdigest(words[begin : begin + n].tobytes(), seed=n)], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        begin += n
    return out


def linked(shared: int, a: int, b: int) -> bool:
    return shared > 0 and 100 * shared >= PERCENT * (a + b - shared)


def prefix(n: int, share: int) -> int:
    """Elements at the front of a set of which any linked set has `share` at the front of its own."""
    return min(n, n - -(-PERCENT * n // 100) + share)


class Order:
    """Elements in rising frequency: unknown ones by hash, then the common ones by count."""

    def __init__(self, fronts: np.ndarray, counts: np.ndarray, total: int):
        order = np.argsort(fronts)
        self.fronts, self.counts = fronts[order], counts[order].astype(np.int64)
        self.rank = np.empty(len(order), np.int64)
        self.rank[np.lexsort((self.fronts, self.counts))] = 1 + np.arange(len(order))
        # Cost of a list per posting: the mean length of the list that a posting meets.
        scan = min(float((self.counts.astype(float) ** 2).sum()) / max(total, 1), LONG)
        self.light = 0
        while self._subsets(self.light + 1) * SEND <= prefix(self.light + 1, 1) * (SEND + scan):
            self.light += 1

    @staticmethod
    def _subsets(n: int) -> int:
        p = prefix(n, 2)
        return p * (p - 1) // 2

    def places(self, elements: np.ndarray) -> np.ndarray:
        """Rank of common elements, 0 for the others."""
        at = self._find(elements)
        return np.zeros(len(elements), np.int64) if at is None else np.where(at >= 0, self.rank[at], 0)

    def expected(self, keys: np.ndarray) -> np.ndarray:
        """How many sets post a single element, about; 0 if it is not common."""
        at = self._find(keys)
        return np.zeros(len(keys), np.int64) if at is None else np.where((at >= 0) & (keys & np.uint64(1) == 0), self.counts[at], 0)

    def _find(self, elements: np.ndarray):
        if not len(self.fronts):
            return None
        front = (elements >> np.uint64(32)).astype(np.uint32)
        at = np.minimum(np.searchsorted(self.fronts, front), len(self.fronts) - 1)
        return np.where(self.fronts[at] == front, at, -1)

    def keys(self, elements: np.ndarray) -> tuple[np.ndarray, int]:
        """Keys under which the set meets others (subsets are odd, single elements even),
        and how far its elements are from being common, 0 to 255."""
        n, place = len(elements), self.places(elements)
        rare = 255 * int((place == 0).sum()) // max(n, 1)
        ordered = elements[np.lexsort((elements, place))]
        keys = []
        if 1 < n <= self.light:
            front = ordered[: prefix(n, 2)]
            i, j = np.triu_indices(len(front), 1)
            pair = np.sort(np.stack([front[i], front[j]]), axis=0)
            keys.append(_mix(pair[0] * _ODD + pair[1]) | np.uint64(1))
        if n > 1 and 100 * n >= PERCENT * (self.light + 1):  # may be linked to a heavy set
            keys.append(ordered[: prefix(n, 1)] & ~np.uint64(1))
        return (np.concatenate(keys) if keys else np.zeros(0, np.uint64)), rare


def _common(docs: DataFrame) -> Order:
    """The frequent shingles of all texts, by the first 32 bits of their hashes.

    Every batch sends its distinct sets' shingles by bucket, two bytes each; buckets count them
    and give on what occurs LEAST_COMMON times, of which the COMMON most frequent are collected.
    They only order the prefixes, so two shingles that share 32 bits cost time, not a link.
    """
    bits = min(30, max(6, int(docs.count() // BUCKET_DOCS).bit_length()))
    shift, groups = 32 - bits, 1 << max(16 - bits, 0)

    def send(batches):
        held, seen, size = [], set(), 0

        def close():
            flat = np.sort(np.concatenate(held) >> np.uint64(32)).astype(np.uint32) if held else np.zeros(0, np.uint32)
            bucket, middle, low = flat >> np.uint32(shift), (flat >> np.uint32(16)).astype(np.int64) & (groups - 1), flat.astype(np.uint16)
            at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist() if len(flat) else []
            spans = list(zip(at, [*at[1:], len(flat)]))
            return pa.RecordBatch.from_arrays([
                pa.array(bucket[at].astype(np.int32), pa.int32()),
                pa.array([np.bincount(middle[i:j], minlength=groups).astype(np.uint32).tobytes() for i, j in spans], pa.binary()),
                pa.array([low[i:j].tobytes() for i, j in spans], pa.binary()),
            ], ["bucket", "counts", "low"])

        for batch in slices(batches):
            for elements in shingle_sets(utf8(batch.column(0))):
                print_ = xxhash.xxh3_64_intdigest(elements.tobytes())
                if len(elements) > 1 and print_ not in seen:
                    seen.add(print_)
                    held.append(elements)
                    size += len(elements)
            if size >= BATCH_SHINGLES:
                yield close()
                held, seen, size = [], set(), 0
        if held:
            yield close()

    def count(table: pa.Table) -> pa.Table:
        parts = []
        for counts, low in zip(table["counts"].to_pylist(), table["low"].to_pylist()):
            middle = np.repeat(np.arange(groups, dtype=np.uint32), np.frombuffer(counts, np.uint32))
            parts.append(middle << np.uint32(16) | np.frombuffer(low, np.uint16))
        flat = np.sort(np.concatenate(parts))
        begins = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        n = np.diff(np.append(begins, len(flat)))
        often = n >= LEAST_COMMON
        # The bits above these: all of the bucket's, without those that the low 16 have as well.
        above = (table["bucket"][0].as_py() << shift) & ~0xFFFF
        front = flat[begins[often]].astype(np.int64) | above
        # One row for all occurrences, under no shingle.
        return pa.table({"front": pa.array([*front.tolist(), None], pa.int64()), "n": pa.array([*n[often].tolist(), len(flat)], pa.int64())})

    sent = docs.select("text").mapInArrow(frugal(send), "bucket int, counts binary, low binary")
    counts = stage(sent.groupBy("bucket").applyInArrow(frugal(count), "front bigint, n bigint"), "common")
    total = counts.where("front is null").agg(F.sum("n")).first()[0] or 0
    top = counts.where("front is not null").orderBy(F.desc("n"), "front").limit(COMMON).toArrow()
    return Order(top["front"].to_numpy().astype(np.uint32), top["n"].to_numpy(), total)


def _sets(docs: DataFrame, order) -> DataFrame:
    """Per document: its number, the size and fingerprint of its set, and its keys."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        task, row = TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            out = [[], [], [], [], []]
            for elements in shingle_sets(utf8(batch.column(2))):
                keys, rare = order.value.keys(elements)
                made = (task << 27 | row, len(elements), xxhash.xxh3_128_digest(elements.tobytes()), rare, keys.tobytes())
                row += 1
                for column, value in zip(out, made):
                    column.append(value)
            types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
            arrays = [batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(out, types)]]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "hash", "rid", "n", "print", "rare", "keys"])

    return docs.select("id", "hash", "text").mapInArrow(frugal(run), f"id {id_type}, hash bigint, rid bigint, n bigint, print binary, rare int, keys binary")


def _post(sets: DataFrame, order, bits: int) -> DataFrame:
    """Postings by bucket of their key; a row holds a batch of them as arrays. Lists
    expected to be very long are split over buckets from 1 << bits on."""

    def run(batches):
        held, size = [], 0

        def close():
            key = np.concatenate([k for k, *_ in held])
            lengths = [len(k) for k, *_ in held]
            columns = [np.repeat(np.array([h[j] for h in held], np.int64), lengths) for j in (1, 2, 3)]
            common = order.value
            bucket = (_mix(key) >> np.uint64(64 - bits)).astype(np.int64)
            if len(common.counts) and common.counts.max() > HOT_POSTINGS:  # a long list goes to several buckets
                ways = 1 + common.expected(key) // HOT_POSTINGS
                apart = (_mix(key + (columns[0] % ways).astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
                bucket = np.where(ways > 1, apart + (1 << bits), bucket)
            by = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[by])) + 1
            spans = [by[a:b] for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(by)])]
            return pa.RecordBatch.from_arrays([
                pa.array([int(bucket[s[0]]) for s in spans], pa.int64()),
                *[pa.array([c[s].tobytes() for s in spans], pa.binary()) for c in (key, columns[0], columns[1].astype(np.int32), columns[2].astype(np.uint8))],
            ], ["bucket", "key", "rid", "n", "rare"])

        for batch in batches:
            for rid, n, rare, keys in zip(*(c.to_pylist() for c in batch.columns)):
                if keys:
                    held.append((np.frombuffer(keys, np.uint64), rid, n, rare))
                    size += len(keys) // 8
                    if size >= BATCH_SHINGLES:
                        yield close()
                        held, size = [], 0
        if held:
            yield close()

    return sets.select("rid", "n", "rare", "keys").mapInArrow(frugal(run), "bucket bigint, key binary, rid binary, n binary, rare binary")


def _close_sizes(a, b):
    return 100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)


def _scan(table: pa.Table, bits: int) -> pa.Table:
    """One bucket: PAIRs (a < b) to compare, MEMBERs of groups, and LINKs of split lists.

    Lists of up to LONG members give all their pairs. In a longer list each band of
    sizes is compared with its pivot, the set closest to being common (copies of one
    text differ in rare shingles), and the band is noted as a group under the pivot, with the sets just
    above its sizes; the many lists that copies share come to few groups.
    """
    read = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
    key, rid, n, rare = read("key", np.uint64), read("rid", np.int64), read("n", np.int32).astype(np.int64), read("rare", np.uint8).astype(np.int64)
    split = table["bucket"][0].as_py() >= 1 << bits
    by = np.lexsort((rid, n, key))
    key, rid, n, rare = key[by], rid[by], n[by], rare[by]
    begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    m = np.diff(np.append(begins, len(key)))
    found: dict[int, list] = {PAIR: [], MEMBER: [], LINK: []}
    for size in range(2, LONG + 1) if not split else ():
        at = begins[m == size]
        if len(at):
            i, j = np.triu_indices(size, 1)
            left, right = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
            ok = _close_sizes(n[left], n[right])
            found[PAIR].append(np.stack([rid[left[ok]], rid[right[ok]]]))
    for at in np.flatnonzero(m > (0 if split else LONG)):
        span = slice(begins[at], begins[at] + m[at])
        ids, sizes, far, name = rid[span], n[span], rare[span], key[begins[at]].view(np.int64)
        low = 0
        while low < len(ids):
            high = int(np.searchsorted(sizes, sizes[low] * 100 // PERCENT, side="right"))
            above = int(np.searchsorted(sizes, sizes[high - 1] * 100 // PERCENT, side="right"))
            pivot = ids[low + int(np.lexsort((ids[low:high], far[low:high]))[0])]
            found[PAIR].append(np.stack([np.full(high - low, pivot), ids[low:high]]))
            if split:
                found[LINK].append(np.array([[name], [pivot]]))
            else:
                found[MEMBER].append(np.stack([np.full(above - low, pivot), ids[low:above]]))
            low = high
        if split:
            found[MEMBER].append(np.stack([np.full(len(ids), name), ids]))
    out = []
    for kind, parts in found.items():
        rows = np.concatenate(parts, axis=1) if parts else np.zeros((2, 0), np.int64)
        if kind == PAIR:
            rows = np.sort(rows[:, rows[0] != rows[1]], axis=0)
        rows = np.unique(rows, axis=1) if rows.size else rows
        out.append(pa.table({"kind": pa.array(np.full(rows.shape[1], kind), pa.int32()), "x": pa.array(rows[0], pa.int64()), "y": pa.array(rows[1], pa.int64())}))
    return pa.concat_tables(out)


PAIR, MEMBER, LINK = 0, 1, 2


def broadcast_if_small(rows: DataFrame, key: str) -> DataFrame:
    """`rows`, to be broadcast if they are measured to take BROADCAST_BYTES at most."""
    n, keys = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(key).cast("string")))).first()
    return F.broadcast(rows) if n * ROW_BYTES + (keys or 0) <= BROADCAST_BYTES else rows


def _with_texts(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """`wanted` (with id, hash and print) and the texts of these documents. The text's hash belongs to the
    condition, so documents without id, or under one id, do not meet each other's texts."""
    own = docs.select(F.col("id").alias("id_"), F.col("hash").alias("hash_"), "text")
    same = (F.col("hash_") == F.col("hash")) & F.col("id_").eqNullSafe(F.col("id"))
    return own.join(broadcast_if_small(wanted, "id"), same).drop("id_", "hash_")


def _verify(pairs: DataFrame, docs: DataFrame, names: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are linked.

    A set is fetched as text: once as pivot a, once per pivot it is compared with. Texts of
    a pivot arrive sorted, the pivot's first, and are compared one by one as they stream by.
    Pivots with many partners are copied to several tasks.
    """
    pairs = stage(pairs, "pairs")
    ways = stage(pairs.groupBy(F.col("a").alias("p")).agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("ways")), "pivots")
    members = pairs.join(ways, F.col("a") == F.col("p")).select(
        F.col("b").alias("rid"), F.col("a").alias("pivot"), F.pmod(F.xxhash64("b"), "ways").cast("int").alias("way"), F.lit(1).alias("member")
    )
    pivots = ways.select(F.col("p").alias("rid"), F.col("p").alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("ways") - 1)).alias("way"), F.lit(0).alias("member"))
    wanted = stage(members.unionByName(pivots).join(names, "rid"), "wanted")
    rows = _with_texts(wanted, docs).select("pivot", "way", "member", "rid", "print", "text")
    rows = rows.repartition("pivot", "way").sortWithinPartitions("pivot", "way", "member", "rid")

    def compare(batches):
        at, base = None, np.zeros(0, np.uint64)
        for batch in slices(batches, 500):
            out, last = [], None
            pivot, way, member, rid, prints = (batch.column(i).to_pylist() for i in range(5))
            for i, elements in enumerate(shingle_sets(utf8(batch.column(5)))):
                if xxhash.xxh3_128_digest(elements.tobytes()) != prints[i]:
                    continue  # another text with the same id and hash
                if not member[i]:
                    at, base = (pivot[i], way[i]), elements
                elif at == (pivot[i], way[i]) and last != (at, rid[i]):
                    last = at, rid[i]
                    place = np.minimum(np.searchsorted(base, elements), len(base) - 1)
                    if linked(int((base[place] == elements).sum()), len(base), len(elements)):
                        out.append((pivot[i], rid[i]))
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], pa.int64()) for j in (0, 1)], ["a", "b"])

    return rows.mapInArrow(frugal(compare), "a bigint, b bigint")


def _settle(groups: DataFrame, roots: DataFrame, docs: DataFrame, names: DataFrame) -> DataFrame:
    """Links between the different components that are left in a group.

    The sets of a group meet in blocks of BLOCK members. In a pair of blocks an inverted index of the
    sets is scanned for every set outside the largest component: that counts its shared
    shingles with all others at once. Only links come out, one per set and component.
    """
    rooted = groups.join(roots, F.col("rid") == F.col("node"), "left").select("group", "rid", F.coalesce("root", "rid").alias("root"))
    rooted = stage(rooted, "rooted")
    sizes = rooted.groupBy(F.col("group").alias("g")).agg(F.min("root").alias("low"), F.max("root").alias("high"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("ways"))
    unsettled = stage(sizes.where("low <> high").select("g", "ways"), "unsettled")
    members = rooted.join(unsettled, F.col("group") == F.col("g")).withColumn("block", F.pmod(F.xxhash64("rid"), "ways").cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("ways") - 1)))
    members = members.select("group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rid", "root").join(names, "rid")
    rows = _with_texts(stage(members, "members"), docs).select("group", "i", "j", "block", "rid", "root", "print", "text")

    def scan(table: pa.Table) -> pa.Table:
        sets = shingle_sets(utf8(table["text"]))
        right = [i for i, (s, p) in enumerate(zip(sets, table["print"].to_pylist())) if xxhash.xxh3_128_digest(s.tobytes()) == p]
        rids, first = np.unique(table["rid"].to_numpy()[right], return_index=True)
        use = np.array(right, np.int64)[first]
        root, block = table["root"].to_numpy()[use], table["block"].to_numpy()[use]
        sets = [sets[i] for i in use.tolist()]
        n = np.array([len(s) for s in sets], np.int64)
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
        by = np.argsort(flat, kind="stable")
        flat, owner = flat[by], owner[by]
        kinds, counts = np.unique(root, return_counts=True)
        inner = table["i"][0].as_py() == table["j"][0].as_py()
        out = []
        for at in np.flatnonzero(root != kinds[counts.argmax()]).tolist():
            low, high = np.searchsorted(flat, sets[at], side="left"), np.searchsorted(flat, sets[at], side="right")
            width = high - low
            place = np.repeat(low - np.cumsum(width) + width, width) + np.arange(width.sum())
            shared = np.bincount(owner[place], minlength=len(sets))
            hit = (shared > 0) & (100 * shared >= PERCENT * (n + n[at] - shared)) & (root != root[at]) & (inner | (block != block[at]))
            hit = np.flatnonzero(hit)
            _, once = np.unique(root[hit], return_index=True)
            out += [(min(rids[at], rids[k]), max(rids[at], rids[k])) for k in hit[once].tolist()]
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

    return rows.groupBy("group", "i", "j").applyInArrow(frugal(scan), "a bigint, b bigint")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_shingles (its set's size) and component_id, the smallest key
    it reaches by links; two documents link at a Jaccard similarity of 0.75 or more.

    Equal sets are one node. Light sets post pairs of their prefix, heavy ones single
    elements; postings meet in buckets of their key, several for a very frequent one.
    Short lists give all their pairs. Long lists are compared with pivots first, which puts
    copies of one text into one component with a number of comparisons proportional to
    them; what a long list then still holds in different components is settled by scanning
    an inverted index of its sets, block by block. So no link between different texts is lost, and no group of copies is squared.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a text of fewer than five
    words is one shingle. A null or blank text has no shingles and is alone. Null
    keys are never the smallest; a component of null keys alone has a null id. Repeated rows
    are copies. Other columns are not used, so names cannot clash. Empty in, empty out.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("hash"), F.col(f"`{text}`").alias("text"))
    order = spark.sparkContext.broadcast(_common(docs))  # COMMON hashes and counts
    sets = stage(_sets(docs, order), "sets")

    copies = sets.where("n > 0").groupBy(F.col("print").alias("same")).agg(F.min("rid").alias("first"), F.count(F.lit(1)).alias("n_same")).where("n_same > 1")
    copies = stage(copies.select("same", "first"), "copies")
    node = F.coalesce("first", "rid")
    joined = sets.join(broadcast_if_small(copies, "same"), F.col("print") == F.col("same"), "left")
    nodes = joined.where(node == F.col("rid"))

    postings = sets.agg(F.sum(F.octet_length("keys") / 8)).first()[0] or 0
    bits = max(5, int(postings // BUCKET_POSTINGS).bit_length())
    met = stage(_post(nodes, order, bits).groupBy("bucket").applyInArrow(lambda t: _scan(t, bits), "kind int, x bigint, y bigint"), "met")
    names = stage(nodes.where("n > 1").select("rid", "id", "hash", "print"), "names")
    parts = met.where(F.col("kind") == LINK).select("x", "y").distinct()  # pivots of the parts of split lists
    hubs = stage(parts.groupBy(F.col("x").alias("list")).agg(F.min("y").alias("a")), "hubs")
    apart = parts.join(hubs, F.col("x") == F.col("list")).where("a < y").select("a", F.col("y").alias("b"))
    pairs = met.where(F.col("kind") == PAIR).select(F.col("x").alias("a"), F.col("y").alias("b"))
    links = stage(_verify(pairs.unionByName(apart).distinct(), docs, names), "links")
    roots = stage(components(links), "roots")
    groups = met.where(F.col("kind") == MEMBER).select(F.col("x").alias("group"), F.col("y").alias("rid")).distinct()
    more = stage(_settle(groups, roots, docs, names), "links")
    if not more.isEmpty():
        roots = stage(components(links.unionByName(more)), "roots")

    found = joined.select("id", "n", "rid", F.col("first").isNotNull().alias("copied"), node.alias("node_"))
    found = found.join(roots, F.col("node_") == F.col("node"), "left")
    grouped = F.col("copied") | F.col("root").isNotNull()
    found = stage(found.select("id", "n", grouped.alias("grouped"), F.coalesce("root", "node_").alias("root")), "found")
    least = found.where("grouped").groupBy(F.col("root").alias("r")).agg(F.min("id").alias("least"))
    out = found.join(stage(least, "least"), F.col("grouped") & (F.col("root") == F.col("r")), "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("grouped"), F.col("least")).otherwise(F.col("id")).alias("component_id"))
