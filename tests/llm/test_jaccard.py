"""The join against all pairs, on families of edited texts."""

import random

import pytest

from milepost.llm import jaccard
from milepost.llm.components import components
from milepost.llm.keep import keep_least


def words_of(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words_of(text)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((k, len(s), least.get(find(i))) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str)


def family(rng, words, size, length, edits):
    base = [rng.choice(words) for _ in range(length)]
    out = [base]
    for _ in range(size - 1):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(text))
            text[at : at + rng.randint(0, 2)] = [rng.choice(words)]
        out.append(text)
    return [" ".join(t) for t in out]


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Über", "the", "Of"]
    passage = [rng.choice(words) for _ in range(60)]
    texts = [None, "", " \t ", "a b", "A  b", "a b c d", "a b c d e", "A B C D E", "a b c d e f", "a b c d e f g", "a b c d e f g h"]
    for size, length, edits in ((40, 90, 6), (25, 300, 14), (12, 12, 1), (30, 30, 2), (3, 700, 20), (2, 8, 1)):
        texts += family(rng, words, size, length, edits)
    texts += [" ".join(passage + [rng.choice(words) for _ in range(rng.randint(0, 25))]) for _ in range(40)]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 200))) for _ in range(60)]
    texts += texts[20:26] * 3
    rng.shuffle(texts)
    return list(enumerate(texts, 5))


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return sorted((tuple(r) for r in jaccard.jaccard_components(df).collect()), key=str)


@pytest.mark.parametrize("seed, limits", [
    (1, {}),
    (2, {"LONG": 2, "BLOCK": 6, "LEAST_COMMON": 2, "BUCKET_DOCS": 1, "HOT_POSTINGS": 5, "MEMBERS": 3, "BROADCAST_BYTES": 0, "BATCH_SHINGLES": 700}),
    (3, {"LONG": 3, "BLOCK": 9, "COMMON": 10, "SEND": 1}),
])
def test_links_and_components(spark, monkeypatch, seed, limits):
    for name, value in limits.items():
        monkeypatch.setattr(jaccard, name, value)
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_null_and_repeated_keys(spark):
    text = "one two three four five six seven"
    rows = [(None, text), (7, text), (7, text), (9, text + " eight"), (None, "x y z"), (None, None), (3, None)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("key", [None, 7])
def test_documents_without_keys_of_their_own_fetch_one_text_each(spark, monkeypatch, key):
    rng, fetched = random.Random(6), []
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(50)) for _ in range(30)) for _ in range(10)]
    rows = [(key, f"{rng.choice(base)} {i}") for i in range(300)]
    plain = jaccard._with_texts

    def counted(wanted, docs):
        out = plain(wanted, docs)
        fetched.append((wanted.count(), out.count()))
        return out

    monkeypatch.setattr(jaccard, "_with_texts", counted)
    assert run(spark, rows) == brute(rows)
    assert fetched[0][0] >= 300 and all(texts == rows for rows, texts in fetched)


def test_very_long_text(spark):
    rng = random.Random(7)
    words = [rng.choice("abcdefgh") + str(rng.randrange(10_000)) for _ in range(60_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:50_000])), (3, " ".join(words[:30_000])), (4, None)]
    got = run(spark, rows)
    assert [(k, c) for k, _, c in got] == [(1, 1), (2, 1), (3, 3), (4, 4)]


@pytest.mark.parametrize("docs", [1, 200_000_000, 1 << 34])
def test_common_shingles_in_any_number_of_buckets(spark, monkeypatch, docs):
    """Counting buckets grow with the documents, beyond 65,536 as well."""
    rows = corpus(8)
    monkeypatch.setattr(jaccard, "BUCKET_DOCS", len(rows) / docs)
    monkeypatch.setattr(jaccard, "LEAST_COMMON", 2)
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert jaccard.jaccard_components(df).collect() == []
    df = spark.createDataFrame([(1, "a b c", 5, "q"), (2, "A b  c", 6, "r")], "doc_id bigint, text string, rid int, print string")
    assert sorted(map(tuple, jaccard.jaccard_components(df).collect())) == [(1, 1, 1), (2, 1, 1)]


def test_light_and_heavy_keys_meet():
    rng = random.Random(4)
    import numpy as np

    order = jaccard.Order(np.array([3, 9, 11], np.uint32), np.array([5000, 40, 7]), 100)
    assert order.light >= 8
    for _ in range(300):
        element = lambda: rng.randrange(40) << 32
        a = np.unique(np.array([element() for _ in range(rng.randint(1, 30))], np.uint64))
        b = np.unique(np.array([x for x in a.tolist() if rng.random() < 0.9] + [element() for _ in range(rng.randint(0, 3))], np.uint64))
        shared = len(np.intersect1d(a, b))
        if jaccard.linked(shared, len(a), len(b)) and a.tolist() != b.tolist():
            assert set(order.keys(a)[0].tolist()) & set(order.keys(b)[0].tolist())


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(80), rng.randrange(80)) for _ in range(40)] + [(500, 500), (300, 200), (300, 250)]
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: find(n) for n in parent if any(n in e and e[0] != e[1] for e in edges)}


def test_repeated_and_null_keys_lose_only_copies(spark):
    near, other = "a b c d e f g h i j k l m n o p", "entirely different words that no other text of this table has"
    rows = [(1, near), (5, near + " q"), (5, other), (5, other), (None, near), (None, "alone " + other[::-1])]
    rows += [(None, "u v w x y z one two three"), (None, "U v w x y z one two three"), (None, "u v w x y z one two three")]
    rows += [(None, None), (None, None), (None, " "), (8, None), (8, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = [tuple(r) for r in keep_least(df).collect()]
    group = [r for r in got if r[1] and r[1].lower().startswith("u v")]
    assert len(group) == 1 and group[0][0] is None
    want = [(1, near), (5, other), (None, "alone " + other[::-1]), (None, None), (None, None), (None, " "), (8, None)]
    assert sorted(map(str, got)) == sorted(map(str, [*want, *group]))
    assert keep_least(df.limit(0)).collect() == []
