"""Removal of repeated passages against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from milepost.llm import passages
from milepost.llm.queries import op11_prefix_doubling, table

FOLDER = "/root/testdata/sf0.001"


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, digest, spans, kept) of every text."""
    texts = [(t or "").encode() for t in texts]
    seen = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        edges = np.flatnonzero(np.diff(np.array([0, *gone, 0]))).tolist()
        spans = list(zip(edges[::2], edges[1::2]))
        out.append((len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), spans, kept))
    return out


def corpus(rng):
    word = lambda n, alphabet="abcdé ": "".join(rng.choice(alphabet) for _ in range(n))
    common, page = word(70), word(900)
    texts = [None, "", "x" * 39, "y" * 40, "y" * 41, "z" * 300, "ab" * 200, "ab" * 21, common, common, page, page, page[100:400]]
    for _ in range(12):  # near copies
        cut = rng.randrange(len(page))
        texts.append(page[:cut] + word(rng.randrange(1, 4)) + page[cut:])
    for _ in range(20):  # a passage that many share, at and beyond the least length
        a, n = rng.randrange(30), rng.choice([38, 39, 40, 41, 45, 60])
        texts.append(word(rng.randrange(80)) + common[a : a + n] + word(rng.randrange(80)))
    texts += [word(rng.randrange(400)) for _ in range(20)]
    texts += [word(50, "ab") for _ in range(40)] + [(u := word(60)) + "-" + u]  # once more in the same text
    return texts


@pytest.mark.parametrize("seed, segment, chunk", [(1, 1 << 21, 8 << 20), (2, 64, 500), (3, 200, 3000)])
def test_removes_what_brute_force_removes(spark, seed, segment, chunk):
    rng = random.Random(seed)
    texts = corpus(rng)
    keys = [None if i % 9 == 0 else i // 2 for i in range(len(texts))]
    df = spark.createDataFrame(list(zip(keys, texts, texts)), "doc_id bigint, text string, n_bytes string").repartition(3)
    sizes = {"segment": segment, "chunk": chunk, "bucket": 2000}
    got = passages.remove_repeats(df, length=40, keep_text=True, **sizes)
    got = [(r["doc_id"], *r[1:5], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in got.collect()]
    want = [(k, *b) for k, b in zip(keys, brute(texts, 40))]
    by = lambda rows: sorted(rows, key=repr)
    assert by(got) == by(want)
    plain = passages.remove_repeats(df, length=40, **sizes).drop("spans")
    assert by(map(tuple, plain.collect())) == by(x[:5] for x in want)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id string, text string")
    assert passages.remove_repeats(df).collect() == []


def test_short_lengths_are_refused():
    with pytest.raises(ValueError):
        passages.Plan(31)


@pytest.mark.parametrize("length", [32, 33, 50, 64, 100, 255, 400, 1000])
def test_plan_fits_in_a_window(length):
    plan = passages.Plan(length)
    assert 2 * plan.base <= length - plan.reach + 1 and plan.base >= 8
    assert plan.first_reach + 7 <= length and plan.first_reach + plan.base - 1 <= length


def test_runs_cover_every_window_once():
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab ") for _ in range(n)).encode() for n in (100, 40, 39, 0, 500)] + [b"a" * 300]
    plan, seen = passages.Plan(40), []
    for data, begins, windows, text, offset in passages.segments(texts, plan):
        first, last, at, part = passages.runs(passages._words(data), begins, windows, plan.reach)
        for a, b, c, p in zip(first, last, at, part):
            assert b <= c < a + plan.reach or a <= c < a + plan.reach
            seen += [(text[p], w - begins[p] + offset[p]) for w in range(a, b + 1)]
    assert sorted(seen) == [(k, i) for k, t in enumerate(texts) for i in range(len(t) - 39)]


def test_query_on_given_table(spark):
    rows = table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    want = sorted((r[0], *b[:4]) for r, b in zip(rows, brute([r[1] for r in rows], 400)))
    assert sorted(map(tuple, op11_prefix_doubling(spark, FOLDER).collect())) == want


def test_a_text_beyond_one_segment(spark):
    rng = random.Random(8)
    page = "".join(rng.choice("abcdefgh ") for _ in range(1000))
    long = "".join(rng.choice("abcdefgh ") for _ in range(3 << 20))
    at = passages.SEGMENT - 300  # across the end of the first segment
    df = spark.createDataFrame([(1, long[:at] + page + long[at:]), (2, page), (3, long[:200])], "doc_id bigint, text string")
    got = passages.remove_repeats(df).select("doc_id", "n_removed", F.get("spans", F.lit(0))["start"].alias("at")).collect()
    assert sorted(map(tuple, got)) == [(1, 1000, at), (2, 1000, 0), (3, 0, None)]
