"""Benchmark decontamination with a generalised suffix automaton of the test items."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from milepost.llm.arrow import fresh, frugal, schema_of, slices, utf8
from milepost.session import stage

WINDOW = 13
RESULTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
MAX_ITEM_BYTES = 1 << 20  # item text in one automaton: some 170,000 words and 150 MB in a worker
PIECE_WORDS = 20_000  # longer items are indexed in overlapping pieces

# Lower case for A-Z; everything in ASCII but digits and letters separates words.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_LOWER).split()


class Automaton:
    """All substrings of all items, as words. After reading a document word the state
    stands for the longest suffix of the document so far that occurs in an item."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window, self.ids = window, {}
        self.next, self.link, self.len = [{}], [-1], [0]
        coded = []
        for name, words in items:
            if words:
                coded.append((name, [self.ids.setdefault(w, len(self.ids)) for w in words]))
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        # Windows: a whole item if it is short, else every run of `window` words.
        self.shortest = min((min(len(codes), window) for _, codes in coded), default=0)
        self.window_items: dict[int, set] = {}  # state of a full window -> items
        self.short: dict[int, dict[int, set]] = {}  # state -> length of a short item -> items
        for name, codes in coded:
            state, length = 0, 0
            for c in codes:
                state, length = self._step(state, length, c)
                if len(codes) >= window and length >= window:
                    self.window_items.setdefault(self._of_length(state, window), set()).add(name)
            if len(codes) < window:
                self.short.setdefault(state, {}).setdefault(len(codes), set()).add(name)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        twin = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.len.append(self.len[p] + 1)
        self.link[q] = twin
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def _step(self, state: int, length: int, c: int) -> tuple[int, int]:
        nxt = self.next
        while state and c not in nxt[state]:
            state = self.link[state]
            length = self.len[state]
        if c in nxt[state]:
            return nxt[state][c], length + 1
        return 0, 0

    def _of_length(self, state: int, length: int) -> int:
        """The state of the suffix of `length` words."""
        while self.len[self.link[state]] >= length:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """Which words are inside an occurrence of a window, and the items of these."""
        hit, items = np.zeros(len(words) + 1, np.int32), set()
        if not self.shortest or len(words) < self.shortest:
            return np.zeros(len(words), bool), items
        get = self.ids.get
        codes = [get(w, -1) for w in words]
        known = np.array(codes) >= 0
        # Runs of item words too short for any window cannot match.
        edges = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
        for begin, end in zip(edges[::2], edges[1::2]):
            if end - begin < self.shortest:
                continue
            state = length = 0
            for i in range(begin, end):
                state, length = self._step(state, length, codes[i])
                longest = 0
                if length >= self.window:
                    at = self._of_length(state, self.window)
                    found = self.window_items.get(at)
                    if found:
                        items |= found
                        longest = self.window
                if self.short:
                    at = state
                    while at > 0:
                        for size, found in self.short.get(at, {}).items():
                            if size <= length:
                                items |= found
                                longest = max(longest, size)
                        at = self.link[at]
                if longest:
                    hit[i - longest + 1] += 1
                    hit[i + 1] -= 1
        return np.cumsum(hit[:-1]) > 0, items


def _pieces(batches, window: int):
    """Items as texts of at most PIECE_WORDS words; each run of `window` words is whole in one of them."""
    for batch in batches:
        keys, texts = [], []
        for key, data in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            words = words_of(data)
            for at in range(0, max(len(words) - window + 1, 1), PIECE_WORDS):
                keys.append("" if key is None else key)
                texts.append(b" ".join(words[at : at + PIECE_WORDS + window - 1]))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(texts, pa.binary())], names=["k", "t"])


def _automata(spark, items: DataFrame, key: str, text: str, window: int):
    """Yields broadcast automata of MAX_ITEM_BYTES of item text each, usually a single one. The driver
    holds the items of one part at a time, and a part's broadcast is gone before the next is made."""
    cleaned = items.select(F.col(f"`{key}`").cast("string").alias("k"), F.col(f"`{text}`").alias("t")).where("t is not null")
    pieces = stage(cleaned.mapInArrow(lambda batches: _pieces(batches, window), "k string, t binary"), "items")
    parts = 1 + (pieces.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // MAX_ITEM_BYTES
    for part in range(parts):
        rows = sorted((r["k"], bytes(r["t"])) for r in pieces.where(F.pmod(F.xxhash64("t"), F.lit(parts)) == part).collect())
        shared = spark.sparkContext.broadcast(Automaton([(k, t.split()) for k, t in rows], window))
        yield shared, part == parts - 1
        if part < parts - 1:
            shared.unpersist()


def _scan_batch(batch, automaton: Automaton, at: int, carried: bool) -> list[tuple]:
    """(words, hit, items) of each text; with what former parts of the items have found."""
    found = []
    before = zip(batch.column(at + 1).to_pylist(), batch.column(at + 2).to_pylist()) if carried else iter(lambda: (None, None), 0)
    for data, (old_hit, old_items) in zip(utf8(batch.column(at)), before):
        words = words_of(data) if data else []
        hit, items = automaton.scan(words)
        if carried:
            hit, items = hit | np.unpackbits(np.frombuffer(old_hit, np.uint8), count=len(words)).astype(bool), items | set(old_items)
        found.append((data, hit, items))
    return found


def contamination(
    docs: DataFrame, items: DataFrame, item_key: str = "item_id", item_text: str = "text", text: str = "text",
    window: int = WINDOW, coverage: float = 0.05, cut_spans: bool = False,
) -> DataFrame:
    """`docs` with n_words, n_hit, n_items, items_sha256 and contaminated.

    Words are runs of digits, letters and non-ASCII bytes after lower-casing A-Z. Every
    run of `window` item words, and every whole item of fewer words, is a window. The
    words of a document run through a suffix automaton of all items, which
    holds the longest match that ends at each word; a word inside an occurrence of a
    window is hit. contaminated: n_hit > 0 and n_hit / n_words >= coverage.
    items_sha256: of the ids of occurring items, sorted as strings, comma-joined.

    cut_spans: the text stays, without the hit spans (from the first byte of a span's
    first word to the last of its last word); else it is left out. Broadcasts the automaton
    of at most MAX_ITEM_BYTES of item text; of more items, the documents pass one part after the
    other, staged in between with the words that were hit so far. No shuffle.

    A null text has no words and stays null. Items without words match nothing; a
    null item id counts as the empty string. Without items nothing is contaminated. Rows
    keep other columns, nulls and repeats included; columns named like a result are replaced.
    """
    per_mille = round(coverage * 1000)
    hits, items_of = fresh("_hit", docs.columns), fresh("_found", docs.columns)
    carried, given = False, docs.columns
    for automaton, last in _automata(docs.sparkSession, items, item_key, item_text, window):
        results = [*RESULTS, *([text] if cut_spans else [])] if last else [hits, items_of]
        types = schema_of("a bigint, b bigint, c bigint, d string, e boolean, f string" if last else "a binary, b array<string>").fields
        gone = {n.lower() for n in [*results, text]} if last else set()
        kept = [c for c in given if c.lower() not in gone]
        out = StructType([docs.schema[c] for c in kept] + [StructField(n, t.dataType) for n, t in zip(results, types)])
        run = _pass(automaton, len(kept), None if last else given.index(text), carried, per_mille, to_arrow_schema(out))
        wanted = [*kept, *([text] if last else []), *([hits, items_of] if carried else [])]
        docs = docs.select([F.col(f"`{c}`") for c in wanted]).mapInArrow(frugal(run), out)
        if not last:
            docs, carried = stage(docs, "scanned"), True
    return docs


def _pass(automaton, kept: int, text: int | None, carried: bool, per_mille: int, out: pa.Schema):
    """One pass over the documents. text: its place among the kept columns; None in the last pass, which
    gives the results and finds the text behind the kept columns."""

    def run(batches):
        n = len(out) - kept
        for batch in slices(batches):
            at = kept if text is None else text
            if carried and text is not None:  # the text is not beside what is carried
                names = [*range(kept), text, kept, kept + 1]
                batch, at = pa.RecordBatch.from_arrays([batch.column(i) for i in names], names=[str(i) for i in range(len(names))]), kept
            values = [[] for _ in range(n)]
            for data, hit, items in _scan_batch(batch, automaton.value, at, carried):
                if text is not None:
                    row = (np.packbits(hit).tobytes(), sorted(items))
                else:
                    n_hit, digest = int(hit.sum()), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
                    contaminated = n_hit > 0 and 1000 * n_hit >= per_mille * len(hit)
                    row = (len(hit), n_hit, len(items), digest, contaminated, None if data is None or n < 6 else (_without(data, hit) if n_hit else data).decode())
                for column, value in zip(values, row):
                    column.append(value)
            arrays = batch.columns[:kept] + [pa.array(v, f.type) for v, f in zip(values, list(out)[kept:])]
            yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return run


def _without(data: bytes, hit: np.ndarray) -> bytes:
    """The text without the spans of hit words."""
    inside = np.frombuffer(data.translate(_LOWER), np.uint8) > 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    begins, ends = edges[::2], edges[1::2]
    keep = np.ones(len(data), bool)
    span = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    for first, last in zip(span[::2], span[1::2]):
        keep[begins[first] : ends[last - 1]] = False
    return np.frombuffer(data, np.uint8)[keep].tobytes()
