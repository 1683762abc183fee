"""Decontamination, language model, shards and archives against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from milepost.llm import decontaminate, lm, shards, warc
from milepost.llm.queries import op9_best_fit_shards, table

FOLDER = "/root/testdata/sf0.001"


# --- decontamination ----------------------------------------------------------


def words7(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_hits(text, items):
    words = words7(text)
    hit, found = set(), set()
    for name, item in items:
        iw = words7(item)
        windows = [iw] if 0 < len(iw) < 13 else [iw[i : i + 13] for i in range(len(iw) - 12)]
        for w in windows:
            for i in range(len(words) - len(w) + 1):
                if words[i : i + len(w)] == w:
                    hit |= set(range(i, i + len(w)))
                    found.add("" if name is None else str(name))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)


def contaminated_corpus():
    rng = random.Random(7)
    vocabulary = ["a", "b", "c", "dé", "e1", "F"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 5, 12, 13, 14, 30]))) for i in range(25)] + [(90, None), (91, " ,. "), (None, text(20)), (7, text(15))]
    docs = [None, "", "...", text(400)] + [text(rng.randint(1, 60)) for _ in range(40)]
    docs += [f"{text(5)}; {items[i][1]}! {text(200)}" for i in range(25)]
    return list(enumerate(docs)), items


def test_contamination(spark):
    docs, items = contaminated_corpus()
    df = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id bigint, text string, n_hit string").repartition(3)
    for chosen in (items, [x for x in items if len(words7(x[1])) >= 12], []):
        bench = spark.createDataFrame(chosen, "item_id bigint, text string")
        got = decontaminate.contamination(df, bench)
        assert sorted(map(tuple, got.collect())) == sorted((k, *brute_hits(t, chosen)) for k, t in docs)
    assert decontaminate.contamination(df.limit(0), bench).collect() == []


def test_several_automata_and_cut_spans(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_ITEM_BYTES", 200)
    docs, items = contaminated_corpus()
    long = [x for x in items if len(words7(x[1])) >= 12]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = decontaminate.contamination(df, spark.createDataFrame(long, "item_id bigint, text string"), cut_spans=True).collect()
    for r in got:
        text = dict(docs)[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute_hits(text, long)
        assert r.text == text if not r.n_hit else len(words7(r.text)) == r.n_words - r.n_hit


def test_long_items_are_indexed_in_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 10)
    rng = random.Random(9)
    items = [("a", " ".join(f"w{rng.randrange(50)}" for _ in range(100))), ("b", "x y"), ("c", " ".join(f"v{i}" for i in range(13)))]
    batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in items]), pa.array([t for _, t in items])], names=["k", "t"])
    made = [(r["k"], r["t"]) for out in decontaminate._pieces(iter([batch]), 4) for r in out.to_pylist()]
    windows = lambda rows: {(k, tuple(t.split()[i : i + 4])) for k, t in rows for i in range(len(t.split()) - 3)}
    assert windows((k, t.decode()) for k, t in made) == windows(items) and ("b", b"x y") in made
    assert max(len(t.split()) for _, t in made) <= 13


# --- language model -------------------------------------------------------------


@pytest.mark.parametrize("limits", [{}, {"PART_BYTES": 3000, "ROW_TOKENS": 50, "BUCKET_WORDS": 50}])
def test_counts_and_base_score(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(lm, name, value)
    docs = [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").collect()][:120] + [(None, None), (5000, ""), (5000, " \n"), (5001, "Neverseen words THE")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    fold = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 5 == 1
    tokens = [(k, (t or "").encode().lower().split() + [None]) for k, t in docs]
    seen = collections.Counter(w for k, ws in tokens if not fold(k) for w in ws)
    total, types = sum(seen.values()), len(seen)
    want = sorted(
        ((str(k), fold(k), len(ws), sum(seen[w] > 0 for w in ws), total, sum(math.log10((seen[w] + 0.5) / (total + 0.5 * (types + 1))) for w in ws)) for k, ws in tokens),
        key=lambda r: (r[0], r[2], r[5]),
    )
    rows = lm.score(df).collect()
    got = sorted(((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows), key=lambda r: (r[0], r[2], r[5]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5])) for g, w in zip(got, want))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) and all(r.score < 0 for r in rows)
    assert lm.score(df.limit(0)).collect() == []


def test_mixture_is_a_distribution():
    import numpy as np

    weights = lm._maximise(np.array([2, 2, 3]), np.array([5.0, 1, 2]), np.array([[0.2, 0.1, 0.6], [0.2, 0.3, 0.0], [0.2, 0.6, 0.1]]))
    assert np.allclose(weights.sum(1), 1) and (weights > 0).all()
    # Three known words and an unknown one, after contexts of 0, 2 and 5 tokens.
    for pairs in ([0, 0, 0, 0], [1, 1, 0, 0], [3, 1, 1, 0]):
        p = lm.mix(weights, 10, 3, np.full(4, sum(pairs)), np.array([5, 3, 2, 0]), np.array(pairs))
        lost = weights[lm._octave(np.array([sum(pairs)]))[0], 2] if not sum(pairs) else 0  # no pair after an unseen context
        assert abs(p.sum() - (1 - lost)) < 1e-9


def test_weights_of_octaves_are_learned_apart():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    context, word = rng.integers(1, 40, 400), rng.integers(0, 9, 400)
    pair = rng.integers(0, context + 1)
    cells, n = lm._cells(context, word, pair), rng.integers(1, 5, 400)
    for octave in set((cells >> 24).tolist()):
        mine = cells >> 24 == octave
        got = lm._of_octave(pa.table({"cell": cells[mine], "n": n[mine], "word": (n * word)[mine], "share": (n * pair / context * lm.SHARE)[mine]}), 900, 40).to_pylist()[0]
        p = np.stack([np.full(mine.sum(), 1 / 41), word[mine] / 900, pair[mine] / context[mine]], axis=1)
        want = lm._maximise(np.full(mine.sum(), octave), n[mine].astype(float), p)[octave]
        assert got["octave"] == octave and np.allclose([got[f"w{j}"] for j in range(3)], want, atol=1e-9)


def brute_scores(docs, folds=5, fold=1):
    """Word-pair model of (key, text) by dictionaries; the weights are learned from exact estimates."""
    import numpy as np

    crc = lambda k: zlib.crc32(str(k).encode())
    part = {k: 2 if crc(k) % folds == fold else int(crc(k) // folds % 10 == 0) for k, _ in docs}
    tokens = {k: t.lower().split() + [None] for k, t in docs}
    steps = lambda f: [(a, b) for k, ws in tokens.items() if part[k] == f for a, b in zip([None, *ws], ws)]

    def counted(pairs):
        return collections.Counter(pairs), collections.Counter(b for _, b in pairs)

    both, one = counted(steps(0))
    n, types = sum(one.values()), len(one)
    estimates = lambda a, b: (1 / (types + 1), one[b] / n, both[a, b] / max(one[a], 1))
    held = steps(1)
    weights = lm._maximise(lm._octave(np.array([one[a] for a, _ in held])), np.ones(len(held)), np.array([estimates(a, b) for a, b in held]))
    both, one = counted(steps(0) + held)  # scored with all training texts
    n, types = sum(one.values()), len(one)
    of = lambda a, b: math.log10(sum(w * p for w, p in zip(weights[one[a].bit_length()], estimates(a, b))))
    return {k: sum(of(a, b) for a, b in zip([None, *ws], ws)) for k, ws in tokens.items()}


@pytest.mark.parametrize("limits", [{}, {"PART_BYTES": 3000, "ROW_TOKENS": 50, "BUCKET_PAIRS": 500}])
def test_every_pair_of_words_has_its_count(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(lm, name, value)
    rng = random.Random(5)
    pairs = [f"left{i} right{i} " for i in range(60)]  # rarer than 1/2048 of the tokens
    docs = [(i, "the " * 400 + "".join(rng.choices(pairs, k=6))) for i in range(300)] + [(1000 + i, f"left{i} right{i}") for i in range(9)]
    docs += [(2000 + i, f"left{i} right{i + 1}") for i in range(9)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got, want = {r.doc_id: r.score for r in lm.score(df).collect()}, brute_scores(docs)
    off = max(abs(got[k] - want[k]) / abs(want[k]) for k in want)
    assert got.keys() == want.keys() and off < 0.001, off
    assert all(got[1000 + i] > got[2000 + i] + 0.5 for i in range(9))


def test_texts_that_teach_weights_are_counted_too(spark):
    docs = [(i, f"some plain words{i % 7} here") for i in range(200)]
    teach = [k for k in range(1000, 1300) if zlib.crc32(str(k).encode()) % 5 != 1 and zlib.crc32(str(k).encode()) // 5 % 10 == 0][:8]
    docs += [(k, "fresh start again") for k in teach]  # words that no other text has
    got = {r.doc_id: r.score for r in lm.score(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    want = brute_scores(docs)
    assert all(abs(got[k] - want[k]) < 0.001 * abs(want[k]) for k in want)


# --- shards -----------------------------------------------------------------------


def plain_best_fit(sizes, capacity):
    room, out = [], []
    for size in sizes:
        fits = [(free, i) for i, free in enumerate(room) if free >= size]
        i = min(fits)[1] if fits else len(room)
        if not fits:
            room.append(max(capacity, size))
        room[i] -= size
        out.append(i)
    return out


def test_best_fit_against_plain_search():
    rng = random.Random(3)
    for _ in range(60):
        sizes = sorted((rng.randint(1, 120) for _ in range(rng.randint(0, 150))), reverse=True)
        assert shards.best_fit(sizes, 100) == plain_best_fit(sizes, 100)


def test_shards(spark):
    placed = op9_best_fit_shards(spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    slots, size, of_text = collections.defaultdict(list), collections.Counter(), collections.defaultdict(set)
    for r in placed:
        assert r["size"] == len(texts[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        slots[r.shard].append(r.slot)
        size[r.shard] += r["size"]
        of_text[texts[r.doc_id]].add(r.shard)
    assert sorted(slots) == list(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of_text.values()) and max(size.values()) < 1.02 * min(size.values())


def test_shards_by_capacity_and_hot_groups(spark):
    rows = [(i, "same" if i % 3 == 0 else f"t{i}", "x") for i in range(300)] + [(None, None, "y"), (None, None, "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, shard string")
    group, size = F.xxhash64(F.coalesce("text", F.lit(""))), F.coalesce(F.octet_length("text"), F.lit(0)) + 6
    got = shards.shard_by_best_fit(df, size, group, shards=4).collect()
    assert len({r.shard for r in got if r.doc_id is not None and r.doc_id % 3 == 0}) == 1 and len(got) == 302
    got = shards.shard_by_best_fit(df, size, group, capacity=100).collect()
    total = collections.Counter()
    for r in got:
        total[r.shard] += r["size"]
    assert sum(v > 100 for v in total.values()) == 1 and len(total) <= 1 + 1.1 * sum(sorted(total.values())[:-1]) / 100 + 1
    assert shards.shard_by_best_fit(df.limit(0), size, group, shards=4).collect() == []


# --- archives ---------------------------------------------------------------------


@pytest.mark.parametrize("limits", [{}, {"BLOCK_LINES": 2, "OPEN_FILES": 1}])
def test_archive_round_trip(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(warc, name, value)
    long = "é" * 80
    given = [(r.page_id, r.url, r.html, 0) for r in table(spark, FOLDER, "pages").collect()]
    given += [(900, None, None, 0), (901, "", "short", 0), (902, "HTTP://user@A.B.example:80/x y?q#f", long, 0), (903, "http://a.b.example/", long, 0)]
    given += [(904, "no host\nat all", long, 0), (904, "no host\nat all", long, 0), (-5, "http://a.b.example/", "short", 0), (None, "u", long, 0), (None, None, "z" * 99, 0)]
    pages = spark.createDataFrame(given, "page_id bigint, url string, html string, payload int").repartition(4)
    folder, index = warc.write_archive(pages)
    got = warc.look_up(folder, index, pages, keep_payload=True).collect()
    first = {}
    for k, _, html, _ in given:
        if k is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, k), k)
    want = []
    for k, _, html, _ in given:
        data = (html or "").encode()
        revisit = len(data) >= 100 and html in first and first[html] != k
        want.append((k, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first[html] if revisit else None, None if revisit else data))
    plain = lambda r: tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)
    assert sorted(map(plain, got), key=str) == sorted(want, key=str)
    absent = spark.createDataFrame([(12345, "http://nowhere.example/")], "page_id bigint, url string")
    assert warc.look_up(folder, index, absent).collect() == []
    folder, index = warc.write_archive(pages.limit(0))
    assert warc.look_up(folder, index, pages).collect() == []
