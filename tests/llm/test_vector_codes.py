"""Product codes against plain Lloyd rounds."""

import hashlib
import math
import random

import numpy as np
import pytest

from milepost.llm import vector_codes
from milepost.llm.oracle import ORACLE
from milepost.llm.queries import op12_cover_tree_codes, table
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


def brute(rows, parts, entries, rounds):
    """rows: (id, vector, label) of kept vectors."""
    cut = lambda v: [[math.floor(4096 * x) for x in v[i * len(v) // parts : (i + 1) * len(v) // parts]] for i in range(parts)]
    pieces = [cut(v) for _, v, _ in rows]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    book = [[pieces[i][p] for i in first] for p in range(parts)]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min((square(v[p], e), k) for k, e in enumerate(book[p])) for p in range(parts)] for v in pieces]

    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for k in range(len(book[p])):
                mine = [v[p] for v, n in zip(pieces, near) if n[p][1] == k]
                if mine:
                    book[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    near = assign()
    error = [sum(d for d, _ in n) for n in near]
    by = {}
    for (_, _, label), e in zip(rows, error):
        by[label] = by.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in book for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{k:02x}" for _, k in n), e, by[label], digest) for (i, _, label), n, e in zip(rows, near, error)]


def sample(rng, n, length=16, spread=0.05):
    centres = [[rng.uniform(-1, 1) for _ in range(length)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.choice([0, 1, None])) for i in range(n)]
    return rows + [(r[0] + n, r[1], r[2]) for r in rows[: n // 3]]  # a third once more


@pytest.mark.parametrize("seed, n, chunk", [(1, 300, 4096), (2, 200, 64), (3, 3, 4096), (4, 1, 1)])
def test_equals_plain_rounds(spark, seed, n, chunk):
    rng = random.Random(seed)
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in sample(rng, n)]
    rows += [(None, rows[0][1], 7), (rows[0][0], [0.0] * 16, 7)]  # a null key, and a key twice
    bad = [(900, None, 0), (-5, [float("nan")] * 16, 0), (-6, [None] * 16, 0), (-7, [float("inf")] + [0.0] * 15, 0), (901, [1.0] * 8, 0), (902, [], 0), (903, [1e30] * 16, 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows + bad], "vec_id bigint, embedding array<float>, label int, code string").repartition(3)
    got = vector_codes.compress(df, rounds=4, chunk=chunk)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows, 8, 16, 4), key=repr)


def test_all_vectors_equal(spark):
    df = spark.createDataFrame([(i, [0.5] * 8, "a") for i in range(50)], "vec_id bigint, embedding array<double>, label string")
    got = vector_codes.compress(df).collect()
    assert {r[1:4] for r in map(tuple, got)} == {("00" * 8, 0, 0)} and len(got) == 50


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert vector_codes.compress(df).collect() == []


def test_trees_cover_and_nest_and_spare_comparisons():
    rng = random.Random(3)
    vectors = np.array([v for _, v, _ in sample(rng, 1500, spread=0.02)])
    points = np.ascontiguousarray(vector_codes.integers(vectors).reshape(len(vectors), 2, 8).transpose(1, 0, 2))
    order, nodes = vector_codes.build(points)
    flat = points.reshape(-1, 8)[order]
    assert sorted(order) == list(range(len(order)))
    for node in nodes:
        far = np.sqrt(((flat[node["lo"] : node["hi"]] - flat[node["lo"]]) ** 2).sum(axis=1))
        assert far.max() <= node["radius"] <= far.max() * 1.001 + 1e-9
        children = nodes[node["child"] : node["child"] + node["children"]]
        if len(children):
            assert children["lo"][0] == node["lo"] and children["hi"][-1] == node["hi"]
            assert (children["lo"][1:] == children["hi"][:-1]).all()
            centres = flat[children["lo"]].astype(float)
            apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2))[~np.eye(len(centres), dtype=bool)]
            assert not len(apart) or apart.min() > node["radius"] / vector_codes.SHRINK * 0.999
    trees = vector_codes.Trees(flat, nodes, 2)
    book = points[:, :16].copy()
    plain = (((flat.reshape(2, -1, 1, 8) - book[:, None]) ** 2).sum(axis=3)).argmin(axis=2).ravel()
    assert (trees.entries(book) == plain).all()
    assert trees.exact < len(flat)  # whole subtrees were assigned


def test_query_matches_sql(spark):
    assert difference(op12_cover_tree_codes(spark, FOLDER), connect(FOLDER), ORACLE["op12_cover_tree_codes"]) is None
    assert op12_cover_tree_codes(spark, FOLDER).count() == table(spark, FOLDER, "embeddings").count()
