"""How far the sources of a language diverge, and the terms that set a source apart."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from milepost.llm.arrow import frugal, schema_of, slices, utf8
from milepost.session import stage

ONE = 1_000_000_000  # a probability of 1 in the fixed-point scale
LEAST_DOCS = 3  # documents of the language that a kept term occurs in
RANKS = 200  # ranks listed per group in part `term`
HELD = 8 << 20  # bytes of text that a task counts at once
BUCKET = 32 << 20  # bytes of text whose terms one task adds up
DENSE = 1 << 19  # counts of a dense table of terms by sources

# ASCII letters in lower case, everything else in ASCII as a blank; UTF-8 bytes of other characters stay.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(texts: list) -> tuple[np.ndarray, pa.Array]:
    """The number of terms of each text (UTF-8 bytes or None), and all terms in a row: runs of
    letters and of all characters beyond ASCII; only A-Z are lower-cased."""
    clean = pa.array([t.translate(_LETTERS).strip() or None if t else None for t in texts], pa.large_string())
    split = pc.ascii_split_whitespace(clean)
    return pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64), split.flatten()


def _fold(key: np.ndarray, *values: np.ndarray):
    """Distinct keys, and each of `values` summed up by them."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else order
    return key[at], *(np.add.reduceat(v[order], at) if len(at) else v for v in values)


# A block: terms of one language, one after the other, and their counts by source, sparse.
_BLOCK = "lang string, sources array<string>, terms binary, spread binary, docs binary, source binary, n binary"


def _blocks_of(texts: list, langs: list, sources: list, buckets: int, out: pa.Schema) -> pa.RecordBatch:
    """Occurrences and documents per language, term and source of some texts, by bucket of the term."""
    lang_names, source_names = (list(dict.fromkeys(x)) for x in (langs, sources))
    place = lambda names, values: np.array([*map({v: i for i, v in enumerate(names)}.get, values)], np.int64)
    lang, source = place(lang_names, langs), place(source_names, sources)
    sizes, flat = terms(texts)
    coded = flat.dictionary_encode()
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    kinds, code = max(len(words), 1), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    in_text, n = _fold(np.repeat(np.arange(len(texts)), sizes) * kinds + code, np.ones(len(code), np.int64))
    text, code = in_text // kinds, in_text % kinds
    bucket = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) % np.uint64(buckets)
    # In the order of bucket, language, term and source.
    key = ((bucket[code].astype(np.int64) * len(lang_names) + lang[text]) * kinds + code) * len(source_names) + source[text]
    key, n, docs = _fold(key, n, np.ones(len(n), np.int64))
    key, source = key // len(source_names), key % len(source_names)
    term, spread, docs = _fold(key, np.ones(len(key), np.int64), docs)
    part, code = term // kinds, term % kinds
    ends = np.cumsum(spread)
    rows, cut = [], np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
    for i, j in zip(cut, [*cut[1:], len(part)]):
        inside = slice(ends[i] - spread[i], ends[j - 1])
        rows.append((
            int(part[i]) // len(lang_names), lang_names[part[i] % len(lang_names)], source_names, b" ".join([words[c] for c in code[i:j].tolist()]),
            spread[i:j].astype("<i4").tobytes(), docs[i:j].astype("<i4").tobytes(), source[inside].astype("<i4").tobytes(), n[inside].astype("<i8").tobytes(),
        ))
    columns = list(zip(*rows)) if rows else [[]] * len(out)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)


def _send(batches, buckets: int, most: int, out: pa.Schema):
    texts, langs, sources, held = [], [], [], 0
    for batch in slices(batches, 100):
        texts += (new := utf8(batch.column(0)))
        langs += batch.column(1).to_pylist()
        sources += batch.column(2).to_pylist()
        held += sum(map(len, new)) + 100 * len(new)
        if held >= most:
            yield _blocks_of(texts, langs, sources, buckets, out)
            texts, langs, sources, held = [], [], [], 0
    if texts:
        yield _blocks_of(texts, langs, sources, buckets, out)


def _numbers(row, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(row[name], kind).astype(np.int64)


def _merge(table: pa.Table, least: int, out: pa.Schema) -> pa.Table:
    """The blocks of one bucket and language as one, with the terms in at least `least`
    documents, in UTF-8 order."""
    rows = table.to_pylist()
    # A block lists all sources of its texts, also those of other languages.
    names = sorted({r["sources"][i] for r in rows for i in np.unique(_numbers(r, "source", "<i4")).tolist()}, key=str.encode)
    at = {s: i for i, s in enumerate(names)}
    coded = pa.array([t for r in rows for t in r["terms"].split(b" ")], pa.binary()).dictionary_encode()
    words, code = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    order = sorted(range(len(words)), key=words.__getitem__)
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    code = rank[code]
    join = lambda name, kind: np.concatenate([_numbers(r, name, kind) for r in rows])
    source = np.concatenate([np.array([at.get(s, 0) for s in r["sources"]], np.int64)[_numbers(r, "source", "<i4")] for r in rows])
    _, docs = _fold(code, join("docs", "<i4"))
    key, n = _fold(np.repeat(code, join("spread", "<i4")) * len(names) + source, join("n", "<i8"))
    kept = docs >= least
    fine = kept[key // len(names)]
    key, n = key[fine], n[fine]
    _, spread = _fold(key // len(names), np.ones(len(key), np.int64))
    row = (rows[0]["lang"], names, b" ".join([words[order[i]] for i in np.flatnonzero(kept).tolist()]))
    row += tuple(x.astype(k).tobytes() for x, k in ((spread, "<i4"), (docs[kept], "<i8"), (key % len(names), "<i4"), (n, "<i8")))
    chosen = [row] if kept.any() else []
    return pa.Table.from_arrays([pa.array([r[i] for r in chosen], f.type) for i, f in enumerate(out)], schema=out)


def _block_totals(batches):
    """(lang, source, total, kinds): occurrences of the kept terms by source, and of a language
    (source null) with the number of its terms."""
    for batch in batches:
        for row in batch.to_pylist():
            n, source = _numbers(row, "n", "<i8"), _numbers(row, "source", "<i4")
            total = np.zeros(len(row["sources"]), np.int64)
            np.add.at(total, source, n)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([row["lang"]] * (len(total) + 1), pa.string()), "source": pa.array([*row["sources"], None], pa.string()),
                "total": pa.array([*total.tolist(), int(n.sum())], pa.int64()), "kinds": pa.array([0] * len(total) + [len(row["spread"]) // 4], pa.int64()),
            })


def probability(count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """1 + floor(ONE * (count + 1) / size), exact for sizes up to 2^53: ONE is reached in three steps
    of long division, none of which leaves 64 bits."""
    whole, rest = np.divmod(count + 1, size)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, size)
        whole = whole * 1000 + more
    return 1 + whole


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q) of two such probabilities; the square stays below 2^63."""
    return (p - q) ** 2 // q


def _pair_sums(count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """sums[a, b]: the divergence of source a from source b over the terms of count[term, source]."""
    p = np.ascontiguousarray(probability(count, size).T)
    return np.stack([divergence(p[a], p).sum(axis=1) for a in range(len(p))])


def top_cells(source: np.ndarray, n: np.ndarray, lang_n: np.ndarray, size: np.ndarray, lang_size: int, ranks: int):
    """(entry, value) of the first `ranks` entries of each source, by falling value, then entry.

    Entries, which are terms with their counts, are never valued one by one: they are grouped into cells of
    equal counts (in the source, in the language), values are taken per cell, equal values are merged
    and ranked by the entries of the cells before them, and only cells that begin within
    `ranks` are expanded again.
    """
    order = np.lexsort((lang_n, n, source))
    s, a, b = source[order], n[order], lang_n[order]
    at = np.flatnonzero(np.append(True, (s[1:] != s[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(order) else order
    many, s = np.diff(np.append(at, len(order))), s[at]
    p, q = probability(a[at], size[s]), probability(b[at], np.int64(lang_size))
    value = np.where(p > q, divergence(p, q), -1)
    by = np.lexsort((-value, s))  # cells by source and falling value
    s, value = s[by], value[by]
    before = np.cumsum(many[by]) - many[by]
    first = np.flatnonzero(np.append(True, (s[1:] != s[:-1]) | (value[1:] != value[:-1]))) if len(s) else by
    before = np.repeat(before[first], np.diff(np.append(first, len(s))))  # one rank for equal values
    begin = np.searchsorted(s, s)
    begins = (np.cumsum(many[by]) - many[by])[begin] if len(s) else before
    fine = (value >= 0) & (before - begins < ranks)
    by, value = by[fine], value[fine]
    inside = np.repeat(at[by] - np.cumsum(many[by]) + many[by], many[by]) + np.arange(many[by].sum())
    entry, value = order[inside], np.repeat(value, many[by])
    sort = np.lexsort((entry, -value, source[entry]))
    entry, value = entry[sort], value[sort]
    place = np.arange(len(entry)) - np.searchsorted(source[entry], source[entry])
    return entry[place < ranks], value[place < ranks]


def _score(batches, ranks: int):
    """Per block: sums of its terms for all pairs of sources, and the terms that can be listed."""
    for batch in batches:
        for row in batch.to_pylist():
            names = [g["source"] for g in row["groups"]]
            size = np.array([g["total"] for g in row["groups"]], np.int64) + row["kinds"]
            place = {s: i for i, s in enumerate(names)}
            source = np.array([place[s] for s in row["sources"]], np.int64)[_numbers(row, "source", "<i4")]
            n, spread, words = _numbers(row, "n", "<i8"), _numbers(row, "spread", "<i4"), row["terms"].split(b" ")
            term = np.repeat(np.arange(len(words)), spread)
            _, lang_n = _fold(term, n)
            some = max(DENSE // len(names), 1)
            for at in range(0, len(words), some):
                low, high = np.searchsorted(term, [at, at + some])
                count = np.zeros((min(some, len(words) - at), len(names)), np.int64)
                count[term[low:high] - at, source[low:high]] = n[low:high]
                sums = _pair_sums(count, size)
                a, b = np.nonzero(~np.eye(len(names), dtype=bool))
                yield _scores(row["lang"], "pair", [names[i] for i in a], [names[i] for i in b], sums[a, b])
            entry, value = top_cells(source, n, lang_n[term], size, row["lang_total"] + row["kinds"], ranks)
            yield _scores(row["lang"], "term", [names[i] for i in source[entry]], [words[i].decode() for i in term[entry]], value)


def _scores(lang: str, part: str, sources: list, items: list, value: np.ndarray) -> pa.RecordBatch:
    same = lambda x: pa.array([x] * len(sources), pa.string())
    columns = [same(lang), pa.array(sources, pa.string()), same(part), pa.array(items, pa.string()), pa.array(value, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "part", "item", "value"])


def audit_sources(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    least_docs: int = LEAST_DOCS, ranks: int = RANKS, held: int = HELD, bucket: int = BUCKET,
) -> DataFrame:
    """(lang, source, part, item, value, rank): the divergence of each source from every other source
    of its language (part `pair`, all of them), and the terms that a source uses more
    than its language does (part `term`, ranks up to `ranks`).

    Tasks count the terms of a few megabytes of text at once and send them on as blocks of arrays, by
    bucket of the term; a bucket adds up its blocks. A task then sums up the divergences of all pairs of
    sources over its terms, and ranks count cells (see top_cells) for the listed ones, so that only sums and
    few candidates travel again. A frequent term is one entry per block and source. All arithmetic is on
    whole numbers. Ranks run by falling value, then rising item in UTF-8 order.

    Null texts, languages and sources read as ''; a group without terms has counts of 0. If no
    term of a language is kept, its values are 0. Repeated rows count as documents of their own.
    Other columns are not read. No documents, no rows; a source alone in its language has no pairs.
    """
    columns = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))]
    docs = docs.select(columns)
    buckets = -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // bucket) or 1
    sent, kept = (schema_of(ddl) for ddl in (f"bucket int, {_BLOCK}", _BLOCK))
    shapes = to_arrow_schema(sent), to_arrow_schema(kept)
    blocks = docs.mapInArrow(frugal(lambda batches: (yield from _send(batches, buckets, held, shapes[0]))), sent)
    blocks = blocks.groupBy("bucket", "lang").applyInArrow(frugal(lambda t: _merge(t, least_docs, shapes[1])), kept)
    blocks = stage(blocks.drop("docs"), "blocks")

    found = blocks.select("lang", "sources", "spread", "source", "n").mapInArrow(_block_totals, "lang string, source string, total bigint, kinds bigint")
    found = stage(found.groupBy("lang", "source").agg(F.sum("total").alias("total"), F.sum("kinds").alias("kinds")), "totals")
    totals = found.where("source is not null").select("lang", "source", "total")
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").fillna(0)
    groups = stage(groups, "groups")
    listed = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("groups"))
    of_lang = listed.join(found.where("source is null").select("lang", F.col("total").alias("lang_total"), "kinds"), "lang")
    wide = blocks.join(of_lang, "lang")
    scores = stage(wide.mapInArrow(lambda batches: _score(batches, ranks), "lang string, source string, part string, item string, value bigint"), "scores")

    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    sums = scores.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("bigint").alias("value"))
    pairs = pairs.join(sums, ["lang", "source", "item"], "left").fillna(0, ["value"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    listed = scores.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    return pairs.unionByName(listed)
