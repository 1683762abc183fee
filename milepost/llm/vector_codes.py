"""Product codes of vectors: Lloyd rounds over partition-local cover trees."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructField, StructType

from milepost.llm.arrow import schema_of
from milepost.session import stage

SCALE = 4096  # a component becomes the integer floor(SCALE * x)
LARGEST = 1 << 27  # components beyond it are out of range: their squares would not sum up in 64 bits
CHUNK = 4096  # vectors in one tree
LEAF = 12  # a subtree of so few points is compared point by point
SHRINK = 1.3  # a child covers at most its parent's radius divided by this
_UP, _DOWN = 1 + 1e-12, 1 - 1e-12  # float distances are widened, so that bounds hold for the exact ones

_NODE = np.dtype([("lo", "<i4"), ("hi", "<i4"), ("radius", "<f8"), ("child", "<i4"), ("children", "<i4")])


def _square(differences: np.ndarray) -> np.ndarray:
    return np.einsum("...i,...i->...", differences, differences)


def _split(points: np.ndarray, owner: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """The child of every point: a node's first point without one becomes the centre of a
    child, which takes all points of the node within reach that have none yet."""
    child, left, made = np.zeros(len(points), np.int64), np.arange(len(points)), 0
    while len(left):
        first = np.append(True, owner[left][1:] != owner[left][:-1])
        centre = left[np.flatnonzero(first)[np.cumsum(first) - 1]]
        near = _square(points[left] - points[centre]) <= reach[owner[left]]
        near |= left == centre
        child[left[near]] = made
        left, made = left[~near], made + 1
    return child


def build(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, nodes) of the cover trees over points[part, vector, position]; a tree per part.

    A node holds a range of `order`, whose first point is its centre (nesting), its exact
    radius, rounded up (covering), and its children, which stand one after the other. Their centres
    are further apart than their parent's radius / SHRINK (separation).
    """
    parts, n, width = points.shape
    flat = points.reshape(parts * n, width)
    order = np.arange(parts * n)
    lo, hi, nodes, made = np.arange(parts) * n, (np.arange(parts) + 1) * n, [], 0
    while len(lo):
        sizes = hi - lo
        begin = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(lo)), sizes)
        at = lo[owner] + np.arange(len(owner)) - begin[owner]
        mine = flat[order[at]]
        far = np.maximum.reduceat(_square(mine - flat[order[lo]][owner]), begin)
        level = np.zeros(len(lo), _NODE)
        level["lo"], level["hi"], level["radius"] = lo, hi, np.sqrt(far) * _UP
        made += len(lo)
        opened = (sizes > LEAF) & (far > 0)
        inside = np.flatnonzero(opened[owner])
        if len(inside):
            number = np.cumsum(opened) - 1
            child = _split(mine[inside], number[owner[inside]], far[opened] / SHRINK**2)
            key = owner[inside] * (n + 1) + child
            sort = np.argsort(key, kind="stable")
            order[at[inside]] = order[at[inside][sort]]
            key, places = key[sort], at[inside]
            cut = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            lo, hi = places[cut], places[np.append(cut[1:], len(key)) - 1] + 1
            parents = key[cut] // (n + 1)
            level["children"] = np.bincount(parents, minlength=len(level))
            level["child"] = made + np.cumsum(level["children"]) - level["children"]
        else:
            lo = lo[:0]
        nodes.append(level)
    return order, np.concatenate(nodes)


class Trees:
    """The trees of one chunk, ready to be descended. Points stand in tree order, and their
    cumulative sums give the sum of any subtree."""

    def __init__(self, points: np.ndarray, nodes: np.ndarray, parts: int):
        self.points, self.nodes, self.parts = points, nodes, parts
        self.sums = np.zeros((len(points) + 1, points.shape[1]), np.int64)
        np.cumsum(points, axis=0, out=self.sums[1:])
        self.exact = 0  # points that were compared one by one

    def _nearest(self, points: np.ndarray, part: np.ndarray, book: np.ndarray):
        far = np.stack([_square(points - book[part, k]) for k in range(book.shape[1])], axis=1)
        return far, far.argmin(axis=1)  # the first of equals: ties go to the lower index

    def assign(self, book: np.ndarray):
        """Yields (lo, hi, entry, whole) arrays: ranges of points that belong to one entry each;
        whole subtrees first, by level, then single points."""
        n = len(self.points) // self.parts
        front, single = np.arange(self.parts), []
        while len(front):
            node = self.nodes[front]
            part = node["lo"] // n
            far, best = self._nearest(self.points[node["lo"]], part, book)
            away = np.sqrt(far) * _DOWN
            rows = np.arange(len(front))
            nearest = np.sqrt(far[rows, best]) * _UP
            away[rows, best] = np.inf
            sure = (node["radius"] == 0) | (away.min(axis=1) - node["radius"] > (nearest + node["radius"]) * _UP)
            yield node["lo"][sure], node["hi"][sure], best[sure]
            node = node[~sure]
            leaf = node["children"] == 0
            single += [np.arange(a, b) for a, b in zip(node["lo"][leaf].tolist(), node["hi"][leaf].tolist())]
            node = node[~leaf]
            count = node["children"].astype(np.int64)
            front = np.repeat(node["child"] - np.cumsum(count) + count, count) + np.arange(count.sum())
        if single:
            at = np.concatenate(single)
            self.exact += len(at)
            yield at, at + 1, self._nearest(self.points[at], at // n, book)[1]

    def totals(self, book: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
        """Adds the sums and counts of what each entry of `book` gets."""
        n = len(self.points) // self.parts
        for lo, hi, entry in self.assign(book):
            np.add.at(sums, (lo // n, entry), self.sums[hi] - self.sums[lo])
            np.add.at(counts, (lo // n, entry), (hi - lo).astype(np.int64))

    def entries(self, book: np.ndarray) -> np.ndarray:
        """The entry of every point, in tree order."""
        out = np.zeros(len(self.points), np.int64)
        for lo, hi, entry in self.assign(book):
            size = (hi - lo).astype(np.int64)
            at = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
            out[at] = np.repeat(entry, size)
        return out


def integers(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors.astype(np.float64)).astype(np.int64)


def _plant(batches, parts: int, width: int, size: int, out):
    """One row per chunk of vectors: their ids and labels, and the chunk's trees."""

    def chunk(table):
        vectors = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, parts, width)
        points = np.ascontiguousarray(integers(vectors).transpose(1, 0, 2))
        order, nodes = build(points)
        columns = [[table["id"].to_pylist()], [table["label"].to_pylist()], [points.reshape(-1, width)[order].astype("<i4").tobytes()]]
        columns += [[order.astype("<i4").tobytes()], [nodes.tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        while rows >= size:
            table = pa.Table.from_batches(held)
            yield chunk(table.slice(0, size))
            held, rows = table.slice(size).to_batches(), rows - size
    if rows:
        yield chunk(pa.Table.from_batches(held))


def _trees(batch, i: int, parts: int, width: int):
    column = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)
    points = column("points", "<i4").astype(np.int64).reshape(-1, width)
    return Trees(points, column("nodes", _NODE), parts), column("order", "<i4")


def _round(trees: DataFrame, book: np.ndarray) -> np.ndarray:
    """`book` with every entry moved to the mean of its parts; unused entries stay."""
    parts, entries, width = book.shape

    def run(batches):
        sums, counts = np.zeros(book.shape, np.int64), np.zeros(book.shape[:2], np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                _trees(batch, i, parts, width)[0].totals(book, sums, counts)
        part, entry = np.nonzero(counts)
        arrays = [part.astype("i4"), entry.astype("i4"), counts[part, entry]]
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, arrays), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "s"]
        )

    found = trees.select("points", "order", "nodes").mapInArrow(run, "part int, entry int, n bigint, s array<bigint>")
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    found = found.select("part", "entry", "n", F.posexplode("s").alias("at", "s")).groupBy("part", "entry", "at").agg(total("n").alias("n"), total("s").alias("s"))
    moved = book.copy()
    for row in found.collect():  # parts x entries x width rows at any size of the input
        moved[row["part"], row["entry"], row["at"]] = int(row["s"]) // int(row["n"])
    return moved


def _code(batches, book: np.ndarray, out):
    parts, _, width = book.shape
    for batch in batches:
        for i in range(batch.num_rows):
            trees, order = _trees(batch, i, parts, width)
            entry, n = trees.entries(book), len(order) // parts
            error = _square(trees.points - book[np.repeat(np.arange(parts), n), entry])
            codes, errors = np.zeros(parts * n, np.uint8), np.zeros(parts * n, np.int64)
            codes[order], errors[order] = entry, error
            text = np.ascontiguousarray(codes.reshape(parts, n).T).tobytes().hex()
            arrays = [batch.column("ids")[i].values, batch.column("labels")[i].values]
            arrays += [pa.array([text[2 * parts * k : 2 * parts * (k + 1)] for k in range(n)]), pa.array(errors.reshape(parts, n).sum(axis=0))]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, out)], schema=out)


def _whole(vector: Column) -> Column:
    """Not null, and every component a number within the range of the integers."""
    fine = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < LARGEST // SCALE), F.lit(False))
    return F.coalesce(F.forall(vector, fine), F.lit(False))


def compress(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = 8, entries: int = 16, rounds: int = 6, chunk: int = CHUNK,
) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every kept vector.

    Components become integers, vectors are cut into `parts` equal parts, and each part is
    replaced by the index of its nearest entry in the codebook of that part: two hex digits. The
    codebooks begin with the kept vectors of the least keys and move through `rounds`
    of Lloyd. All results are those of plain comparisons on integers: sets of vectors whose
    entry follows from the triangle inequality are never opened, the others are.

    Tasks build cover trees over chunks of their vectors once, and a round descends them: a node
    whose every point must be nearest to one entry adds its cumulative sum, an ambiguous
    one hands over to its children, small ones are compared point by point. Only the sums
    per entry travel, so neither frequent vectors nor hot labels gather anywhere; the codebooks,
    parts x entries short vectors, are all that the driver holds.

    Dropped are null vectors, those with null, non-finite or out of range components
    (beyond +-LARGEST / SCALE), and those whose length differs from that of the vector with the
    least key or cannot be cut. Null keys come last in the order, equal keys go by their
    vectors. With fewer vectors than `entries` the codebooks are smaller. Null
    labels count as one label. Repeated rows count each. Other columns are not read. Empty in, empty out.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits")
    rows = vectors.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("v"), F.col(f"`{label}`").alias("label"))
    rows = rows.where(_whole(F.col("v")) & (F.size("v") > 0) & (F.size("v") % parts == 0))
    start = rows.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(1).collect()
    length = len(start[0][0]) if start else parts
    rows, width = rows.where(F.size("v") == length), length // parts
    start = rows.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    id_type, label_type = rows.schema["id"].dataType, rows.schema["label"].dataType

    planted = StructType([StructField("ids", ArrayType(id_type)), StructField("labels", ArrayType(label_type))] + schema_of("points binary, order binary, nodes binary").fields)
    arrow = to_arrow_schema(planted)
    trees = stage(rows.mapInArrow(lambda batches: _plant(batches, parts, width, chunk, arrow), planted), "trees")
    book = integers(np.array([r[0] for r in start]).reshape(-1, parts, width)).transpose(1, 0, 2)
    for _ in range(rounds if start else 0):
        book = _round(trees, book)
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()

    coded = StructType([StructField(key, id_type), StructField("_label", label_type)] + schema_of("code string, error bigint").fields)
    shape = to_arrow_schema(coded)
    codes = stage(trees.mapInArrow(lambda batches: _code(batches, book, shape), coded), "codes")
    sums = codes.groupBy(F.col("_label").alias("_of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("bigint").alias("label_error"))
    joined = codes.join(sums, F.col("_label").eqNullSafe(F.col("_of")), "left")
    return joined.select(F.col(f"`{key}`"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
