"""The audit of sources against plain sums over all terms."""

import collections
import random
import re

import numpy as np
import pytest

from milepost.llm import divergence
from milepost.llm.oracle import ORACLE
from milepost.llm.queries import op13_source_audit
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


def brute(docs, least=3, ranks=200):
    counts, seen = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for text, lang, source in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        counts[lang or "", source or ""].update(found)
        seen[lang or ""].update(set(found))
    out = []
    for lang, docs_of in seen.items():
        kept = [t for t, n in docs_of.items() if n >= least]
        groups = {s: c for (g, s), c in counts.items() if g == lang}
        whole = collections.Counter()
        for c in groups.values():
            whole.update(c)

        def probabilities(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: probabilities(c) for s, c in groups.items()}
        q = probabilities(whole)
        f = lambda a, b: (a - b) * (a - b) // b
        for s in groups:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(found, 1) if part == "pair" or i <= ranks]
    return sorted(out)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "b", "dé", "É", "über-all", "x1y", "中文", "𝒳", "don't", "z_z", " "] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(8)]
    docs = [(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(30))), rng.choice(["en", "en", "de", None]), rng.choice(["s0", "s0", "s1", "s2", "", None])) for _ in range(n)]
    return docs + [(None, "fr", "s0"), ("", "fr", "s9"), ("only here", "it", "s0"), (" \t\x00!", None, None)] + docs[: n // 3]


@pytest.mark.parametrize("seed, n, ranks, least", [(1, 150, 200, 3), (2, 60, 5, 3), (3, 60, 1, 1), (4, 3, 200, 3)])
def test_equals_plain_sums(spark, seed, n, ranks, least):
    docs = corpus(seed, n)
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "text string, lang string, source string, n int, term string").repartition(5)
    got = divergence.audit_sources(df, least_docs=least, ranks=ranks)
    assert sorted(map(tuple, got.collect())) == brute(docs, least, ranks)


@pytest.mark.parametrize("held, bucket", [(10, 50), (1 << 20, 100), (500, 1 << 20)])
def test_counts_are_added_up_over_blocks(spark, held, bucket):
    docs = corpus(5, 80)
    df = spark.createDataFrame(docs, "text string, lang string, source string").coalesce(1)
    assert sorted(map(tuple, divergence.audit_sources(df, held=held, bucket=bucket).collect())) == brute(docs)


def test_very_long_text(spark):
    docs = [("ab cd " * 300_000, "en", "s0"), ("ab cd ef", "en", "s1"), ("ef ab cd ef", "en", "s1"), ("ef", "en", None)]
    df = spark.createDataFrame(docs, "text string, lang string, source string")
    assert sorted(map(tuple, divergence.audit_sources(df).collect())) == brute(docs)


def test_empty_table(spark):
    df = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit_sources(df).collect() == []


def test_probability_is_exact_at_large_counts():
    rng = random.Random(6)
    pairs = [(rng.randrange(s), s) for s in (1, 7, 10**9, 10**12 + 7, 2**53 - 1) for _ in range(20)]
    got = divergence.probability(np.array([c for c, _ in pairs]), np.array([s for _, s in pairs]))
    assert got.tolist() == [1 + 10**9 * (c + 1) // s for c, s in pairs]


@pytest.mark.parametrize("ranks", [1, 3, 10, 1000])
def test_cells_list_what_a_full_sort_lists(ranks):
    rng = np.random.default_rng(ranks)
    source, n = rng.integers(0, 4, 500), rng.integers(1, 5, 500)
    lang_n = n + rng.integers(0, 6, 500)
    size = np.array([300, 400, 500, 900])
    entry, value = divergence.top_cells(source, n, lang_n, size, 2500, ranks)
    p, q = divergence.probability(n, size[source]), divergence.probability(lang_n, np.int64(2500))
    want = []
    for s in range(4):
        listed = sorted((-int((p[i] - q[i]) ** 2 // q[i]), i) for i in range(500) if source[i] == s and p[i] > q[i])
        want += [(i, -v) for v, i in listed[:ranks]]
    assert list(zip(entry.tolist(), value.tolist())) == want


def test_query_matches_sql(spark):
    assert difference(op13_source_audit(spark, FOLDER), connect(FOLDER), ORACLE["op13_source_audit"]) is None
