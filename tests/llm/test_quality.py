"""Counts, thresholds and verdicts by brute force; the classifier by held-out accuracy."""

import collections
import math

import numpy as np
from pyspark.sql import functions as F

from milepost.llm import gam, quality_rules
from milepost.llm.measures import NAMES, measure
from milepost.llm.queries import op10_quality_classifier, table
from tests.llm.test_jaccard import words_of  # noqa: F401  same notion of a word

FOLDER = "/root/testdata/sf0.01"
BLANK = " \t\n\x0b\x0c\r"
TEXTS = [None, "", " \n", "one", "a b c d e a b c d e", "x y z w v u x y z w v\nq q q\nq q q\n\n", "## $5 a|b <c> & 100% *", "Äpfel ÖL X Y1! wie? so!", "a " * 40]


def split(text, marks=BLANK):
    out, word = [], ""
    for c in (text or "") + marks[0]:
        if c in marks:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def brute(text):
    words = split(text)
    lines = [x for x in (text or "").split("\n") if split(x)]
    windows = collections.defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    repeated = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    flat = "".join(words)
    return (
        len(words), len(flat), sum(flat.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated), len(lines),
        sum(a == b for a, b in zip(words, words[1:])), sum("A" <= c <= "Z" for c in flat), sum("0" <= c <= "9" for c in flat),
        flat.count("!") + flat.count("?"), len(set(words)), max((len(w.encode()) for w in words), default=0),
    )


def test_counts_of_texts(spark):
    given = TEXTS + [r.text for r in table(spark, FOLDER, "documents").limit(300).collect()]
    for text in given:
        assert measure(None if text is None else text.encode()) == brute(text), text


def test_rules_against_brute_force(spark):
    docs = [tuple(r) for r in table(spark, FOLDER, "documents").select("doc_id", "text", "lang", "source").collect()]
    docs += [(None, t, None, None) for t in TEXTS] + docs[:3]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string").withColumn("kept", F.lit("clash"))
    counts = [dict(zip(NAMES, brute(t))) for _, t, _, _ in docs]
    per = lambda a, b, scale=1000: lambda c: min(scale * c[a] // max(c[b], 1), 1000)
    shares = {
        "symbols": per("n_symbols", "word_chars"), "dup_lines": per("n_dup_lines", "n_lines"), "adjacent": per("n_adjacent", "n_words"),
        "word_length": per("word_chars", "n_words", 100), "distinct": per("n_distinct", "n_words"),
    }

    def fine(values, name, x, words):
        values = sorted(values)
        q1, q3, tail = (values[-(-len(values) * percent // 100) - 1] for percent in (25, 75, 99))
        off = max(x - q3, q1 - x if name in ("word_length", "distinct") else 0, 0)
        return 4 * off**2 * words <= 25 * (q3 - q1) ** 2 * max(words, 400) if q3 > q1 else x <= tail

    groups, langs = collections.defaultdict(list), collections.defaultdict(list)
    for (_, _, lang, source), c in zip(docs, counts):
        groups[lang or "", source or ""].append(c)
        langs[lang or ""].append(c)

    def kept(lang, source, c):
        if c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]:
            return False
        own = next(g for g in (groups[lang or "", source or ""], langs[lang or ""], counts) if len(g) >= quality_rules.LEAST_ROWS or g is counts)
        return all(fine(list(map(f, own)), n, f(c), c["n_words"]) for n, f in shares.items())

    want = sorted((str(k), *(c[n] for n in NAMES[:5]), kept(lang, source, c)) for (k, _, lang, source), c in zip(docs, counts))
    got = quality_rules.quality_rules(df).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("None")), *NAMES[:5], "kept").collect()
    assert sorted(map(tuple, got)) == want
    applied = quality_rules.apply_rules(df)
    assert applied.columns == df.columns and applied.count() == sum(r[-1] for r in want)
    assert quality_rules.quality_rules(df.limit(0)).collect() == []


def test_limits_follow_the_group(spark):
    """The same text is prose in one source and an outlier in another, and no fixed rule is asked."""
    rng = np.random.default_rng(4)
    text = lambda size: " ".join("".join(rng.choice(list("abcdefghij"), max(int(rng.normal(size, 1)), 1))) for _ in range(400))
    probe = text(9)
    rows = [(f"{s}{i}", text(size), "en", s) for s, size in (("long", 9), ("short", 4)) for i in range(60)]
    rows += [("probe long", probe, "en", "long"), ("probe short", probe, "en", "short")]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")
    judged = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules.quality_rules(df).collect()}
    assert judged["probe long"] == (False, True) and judged["probe short"] == (False, False)


def test_sketches_decide_on_the_given_table(spark):
    judged = quality_rules.quality_rules(table(spark, FOLDER, "documents"))
    assert judged.where("not base_failed and not kept").count() > 0


def test_sketches_merge_exactly(spark):
    rows = quality_rules.measured(table(spark, FOLDER, "documents"))
    whole = quality_rules.sketch(rows, ["lang", "source"])
    halves = [quality_rules.sketch(rows.where(F.col("doc_id") % 2 == i), ["lang", "source"]) for i in (0, 1)]
    merged = quality_rules.merge(halves[0].unionByName(halves[1]), ["g0", "g1"])
    assert sorted(map(tuple, merged.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))


def test_classifier_on_held_out_rows(spark):
    scored = op10_quality_classifier(spark, FOLDER)
    labels = table(spark, FOLDER, "labels")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 60 and sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert scored.count() == 1000 and scored.where("score < 0 or score > 1 or score is null").count() == 0


def test_classifier_never_learns_from_held_out_labels(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    spoiled = labels.withColumn("quality", F.when(gam.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = gam.train(docs, labels), gam.train(docs.repartition(3), spoiled.repartition(2))
    assert a.base == b.base and all(np.array_equal(x, y) for x, y in zip(a.tables, b.tables))


def test_scores_equal_plain_sums_of_table_entries(spark):
    docs, labels = table(spark, FOLDER, "documents").select("doc_id", "text"), table(spark, FOLDER, "labels")
    model = gam.train(docs, labels)
    place = lambda edges, v: sum(v > e for e in edges)  # noqa: E731  bins end with their edge

    def plain(text):
        c = dict(zip(NAMES, brute(text)))
        words, chars, lines = (max(c[n], 1) for n in ("n_words", "word_chars", "n_lines"))
        x = [
            math.log1p(c["n_words"]), chars / words, c["n_symbols"] / chars, c["n_dup_lines"] / lines, c["n_repeat_words"] / words, c["n_adjacent"] / words,
            c["n_upper"] / chars, c["n_digits"] / chars, c["n_marks"] / words, c["n_distinct"] / words, math.log1p(c["longest"]), words / lines,
        ]
        bins = [place(e, v) for e, v in zip(model.edges, x)]
        total = model.base + sum(t[b] for t, b in zip(model.tables, bins)) + sum(t[bins[i], bins[j]] for i, j, t in model.pairs)
        return 1 / (1 + math.exp(-total))

    assert model.pairs and any(t.any() for t in model.tables)
    got = {r.doc_id: r.score for r in op10_quality_classifier(spark, FOLDER).collect()}
    for r in docs.limit(200).collect():
        assert abs(got[r.doc_id] - plain(r.text)) < 1e-9


def test_classifier_on_odd_input(spark):
    docs = spark.createDataFrame([(None, None, "a"), (1, "", "b"), (1, "x " * 30_000, "c")], "doc_id bigint, text string, score string")
    empty = spark.createDataFrame([], "doc_id bigint, quality int")
    model = gam.train(docs, empty)
    assert [r.score for r in gam.score(docs, model).collect()] == [0.5] * 3
    assert gam.score(docs.limit(0), model).collect() == []
    one = spark.createDataFrame([(1, 1), (1, None), (None, 0)], "doc_id bigint, quality int")
    assert all(0 <= r.score <= 1 for r in gam.score(docs, gam.train(docs, one)).collect())


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x[:3000], y[:3000])
    assert {(i, j) for i, j, _ in model.pairs} >= {(0, 1)}
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
