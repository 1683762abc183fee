"""Quality rules whose thresholds follow the texts of each language and source."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from milepost.llm.arrow import add_columns, set_aside
from milepost.llm.measures import NAMES, measure
from milepost.session import stage

GRID = 1000  # a measure is kept as a whole number up to here: the sketch's buckets

# Measure -> (its bucket as SQL over the counts, whether low values are outliers too).
SHARES = {
    "symbols": ("1000 * n_symbols div greatest(word_chars, 1)", False),
    "dup_lines": ("1000 * n_dup_lines div greatest(n_lines, 1)", False),
    "adjacent": ("1000 * n_adjacent div greatest(n_words, 1)", False),
    "word_length": ("100 * word_chars div greatest(n_words, 1)", True),
    "distinct": ("1000 * n_distinct div greatest(n_words, 1)", True),
}
REACH = 5  # half interquartile ranges beyond the quartiles that a measure may lie
STEADY = 400  # words from which a text's measures count as steady; shorter ones may scatter more
TAIL = 99  # percentile that stands in where a group's quartiles are equal
LEAST_ROWS = 50  # smaller groups take the sketch of their language, or of everything

BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"


def measured(docs: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """`docs` with the counts of `measures.NAMES`, without the text unless keep_text."""

    def make():
        return lambda texts: list(zip(*map(measure, texts))) or [[] for _ in NAMES]

    return add_columns(docs, text, ", ".join(f"{n} bigint" for n in NAMES), make, keep_text)


def _group(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def sketch(rows: DataFrame, by: list[str], shares=SHARES) -> DataFrame:
    """A quantile sketch per group and measure: (g0, g1, .., measure, bucket, n).

    Buckets are a fixed grid, so sketches of any two sets of rows merge exactly by
    adding their counts, in any order; a quantile is off by one bucket at most. One
    row per bucket, GRID + 1 at most, folded on each task before the shuffle: a source
    with a third of all rows costs nothing extra.
    """
    points = F.array(
        *[F.struct(F.lit(name).alias("measure"), F.least(F.expr(sql), F.lit(GRID)).cast("int").alias("bucket")) for name, (sql, _) in shares.items()]
    )
    groups = [_group(c).alias(f"g{i}") for i, c in enumerate(by)]
    flat = rows.select(*groups, F.explode(points).alias("p")).select(*[f"g{i}" for i in range(len(by))], "p.*")
    return flat.groupBy(*flat.columns).agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches added up to the coarser groups `by`."""
    return sketches.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Per group and measure: its rows, and cut = (first quartile, third quartile, TAIL percentile)."""
    whole = Window.partitionBy(*by, "measure")
    upto = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    run = sketches.withColumns({"upto": F.sum("n").over(upto), "rows": F.sum("n").over(whole)})
    quantile = lambda percent: F.min(F.when(F.col("upto") * 100 >= F.col("rows") * percent, F.col("bucket"))).cast("bigint")
    cut = F.struct(quantile(25).alias("q1"), quantile(75).alias("q3"), quantile(TAIL).alias("tail"))
    return run.groupBy(*by, "measure").agg(F.max("rows").alias("rows"), cut.alias("cut"))


def thresholds(sketches: DataFrame, shares=SHARES) -> DataFrame:
    """One row per group of `sketches` (g0 language, g1 source): the quantiles of every measure.

    A group of under LEAST_ROWS rows takes the merged sketch of its language, and a
    language of so few the sketch of all rows.
    """
    own, lang, every = fences(sketches, ["g0", "g1"]), fences(merge(sketches, ["g0"]), ["g0"]), fences(merge(sketches, []), [])
    lang = lang.select("g0", "measure", F.col("rows").alias("lang_rows"), F.col("cut").alias("lang_cut"))
    every = every.select("measure", F.col("cut").alias("any_cut"))  # one row per measure
    cut = F.when(F.col("rows") >= LEAST_ROWS, F.col("cut")).when(F.col("lang_rows") >= LEAST_ROWS, F.col("lang_cut")).otherwise(F.col("any_cut"))
    chosen = own.join(lang, ["g0", "measure"]).join(F.broadcast(every), "measure")
    chosen = chosen.select("g0", "g1", "measure", cut.alias("cut"))
    return chosen.groupBy("g0", "g1").agg(*[F.max(F.when(F.col("measure") == m, F.col("cut"))).alias(f"_cut_{m}") for m in shares])


def within(bucket: Column, cut: Column, words: Column, both: bool) -> Column:
    """Whether a measure is no outlier of its group.

    It may lie REACH / 2 interquartile ranges beyond the quartiles. A text of fewer than STEADY words
    may lie further off, as the square root of its words asks for. Where both
    quartiles are equal, the TAIL percentile is the limit.
    """
    spread = cut["q3"] - cut["q1"]
    off = F.greatest(bucket - cut["q3"], cut["q1"] - bucket if both else F.lit(0), F.lit(0))
    scattered = 4 * off * off * words <= REACH * REACH * spread * spread * F.greatest(words, F.lit(STEADY))
    return F.when(spread > 0, scattered).otherwise(bucket <= cut["tail"])


def judge(rows: DataFrame, cuts: DataFrame, lang: str = "lang", source: str = "source", shares=SHARES) -> DataFrame:
    """Rows with counts, joined to the quantiles of their group: adds base_failed and kept."""
    spare = cuts.withColumnsRenamed({"g0": "_g0", "g1": "_g1"})
    joined = rows.join(spare, (_group(lang) == F.col("_g0")) & (_group(source) == F.col("_g1")), "left")
    verdict = F.lit(True)
    for name, (sql, both) in shares.items():
        verdict = verdict & within(F.least(F.expr(sql), F.lit(GRID)), F.col(f"_cut_{name}"), F.col("n_words"), both)
    kept = [c for c in rows.columns if c not in ("base_failed", "kept")]
    return joined.select(*kept, F.expr(BASE_FAILED).alias("base_failed"), (~F.expr(BASE_FAILED) & verdict).alias("kept"))


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """`docs` without its text, with the counts, base_failed and kept.

    base_failed is fixed: fewer than 10 words, or over 20 % of the words in repeated
    windows. The method's verdict compares five measures (shares of symbols, repeated lines, words
    equal to the word before and distinct words, and the mean length of words) with limits taken
    from mergeable quantile sketches of the document's language and source; no limit is fixed. The texts are read once; the counts are staged
    without them, and the thresholds, one row per group, are joined back.

    A null or blank text has no words and fails the base rule. A null language or
    source counts as the empty string. Rows keep their other columns, repeats
    included; columns named like a result are replaced. Empty in, empty out.
    """
    rows = stage(measured(docs, text), "measured")
    cuts = stage(thresholds(sketch(rows, [lang, source])), "cuts")
    return judge(rows, cuts, lang, source)


def apply_rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that the rules keep, with their own columns and texts.

    The texts are measured twice instead of being shuffled.
    """
    cuts = stage(thresholds(sketch(measured(docs, text), [lang, source])), "cuts")
    safe, back = set_aside(docs, [*NAMES, "base_failed", "kept", "_g0", "_g1", *(f"_cut_{m}" for m in SHARES)])
    names = {v: k for k, v in back.items()}
    judged = judge(measured(safe, text, keep_text=True), cuts, names.get(lang, lang), names.get(source, source)).where("kept")
    return judged.select(safe.columns).withColumnsRenamed(back)
