"""Token ids: the cut and remembered way against the library on whole texts; packing, files and counts."""

import collections
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from milepost.llm import packing, token_counts, token_files, tokens
from milepost.llm.arrow import by_bytes
from milepost.llm.queries import tokenizer

HARD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "x\n\ny  z ", "tab\tand wide space 　 x", "don't we'll 's 's.", "<|endoftext|> a <|endoftext|>",
    "<|startoftext|>b <|endoftext|>.", "Café, naïve! été. Ünïcode?", "é e ́x", "日本語 テキスト。 と", "...!!! ,,, ;", "word" * 60 + " end", "1234 12.5, 3.", "\x1c a \x1d", "ΣΑΣ ΟΔΟΣ.",
]
MIXED = HARD + [" ".join(f"w{i % 97}{'.,!'[i % 3]}" for i in range(n)) for n in (1, 50, 3000)]
SCHEMA = "doc_id bigint, text string, n_tokens string, key string"  # clashing names


def rows(texts):
    return [(i if i != 5 else None, t, "x", "y") for i, t in enumerate(texts)] + [(3, texts[3], "x", "y")]


def ids_of(name, text):
    return Tokenizer.from_file(tokenizer(name)).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
@pytest.mark.parametrize("batch, memo", [(4 << 20, 450_000), (40, 5)])
def test_encoder_equals_the_library(monkeypatch, name, batch, memo):
    monkeypatch.setattr(tokens, "BATCH_BYTES", batch)
    monkeypatch.setattr(tokens, "MEMO_PARTS", memo)
    if name.endswith(".model"):
        import sentencepiece

        want = sentencepiece.SentencePieceProcessor(model_file=tokenizer(name)).encode([t or "" for t in MIXED])
    else:
        want = [ids_of(name, t) for t in MIXED]
    data = [None if t is None else t.encode() for t in MIXED]
    encoder = tokens.Encoder(tokenizer(name))
    for _ in range(2):  # the second time from the memo
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(data)] == want
    assert tokens.Encoder(tokenizer(name), lengths_only=True).encode(data) == list(map(len, want))


def test_counts(spark):
    df = spark.createDataFrame(rows(MIXED), SCHEMA)
    got = token_counts.count_tokens(df, tokenizer("word_bpe_49k.json"), limit=49)
    want = [(k, "y", len((t or "").encode()), n, n > 49) for k, t, *_ in rows(MIXED) for n in [len(ids_of("word_bpe_49k.json", t))]]
    assert got.columns == ["doc_id", "key", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    small = token_counts.count_tokens(df, tokenizer("word_bpe_49k.json"), limit=49, batch=50)
    assert sorted(map(tuple, small.collect()), key=str) == sorted(want, key=str)
    assert token_counts.count_tokens(df.limit(0), tokenizer("word_bpe_49k.json")).collect() == []


def test_batches_are_cut_by_bytes():
    rng = np.random.default_rng(2)
    sizes = [int(x) for x in rng.integers(0, 200, 3000)] + [25_000, 0, 9_999, 10_000, 10_001]
    texts = [None if n == 7 else "x" * n for n in sizes]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, min(i + 400, len(texts)))), pa.array(texts[i : i + 400])], names=["k", "t"]) for i in range(0, len(texts), 400)]
    cut = list(by_bytes(iter(batches), 1, 10_000))
    assert [k for t in cut for k in t["k"].to_pylist()] == list(range(len(texts)))
    held = [sum(len(x or "") for x in t["t"].to_pylist()) for t in cut]
    assert all(8_000 <= n <= 10_000 for n in held[: 3000 * 100 // 10_000 - 3])  # texts of 100 bytes, within 20 % of the target
    assert [n for n in held if n > 10_000] == [25_000, 10_001]
    assert list(by_bytes(iter([]), 1, 10)) == []


def test_cut_is_complete_and_classes_fit():
    for capacity in (2048, 100, 7):
        ladder = packing.classes(capacity)
        sizes = sorted(ladder, reverse=True)
        assert all(size * n <= capacity < size * (n + 1) or size * n <= capacity for size, n in ladder.items())
        for length in range(1, 3 * capacity):
            pieces = packing.cut(length, capacity, sizes)
            assert sum(p for p, _ in pieces) == length and all(0 < p <= size for p, size in pieces)


def test_packing_round_trip(spark):
    given = rows(MIXED)[:-1] + [(100 + i, "one two three " * (i % 40), "", "") for i in range(200)]
    df = spark.createDataFrame(given, SCHEMA).repartition(4)
    got = packing.pack(df, tokenizer("byte_bpe_50k.json"), end_id=1, capacity=256, keep_ids=True).collect()
    ids = {k: ids_of("byte_bpe_50k.json", t) + [1] for k, t, *_ in given}
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert crc(part) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id]) and np.frombuffer(r.ids, "<u4").tolist() == part
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for found, total in [*((p, len(ids[k])) for k, p in pieces.items()), *((s, None) for s in sequences.values())]:
        at = 0
        for begin, length in sorted(found):
            assert begin == at
            at += length
        assert at <= 256 if total is None else at == total
    assert pieces.keys() == ids.keys()
    total = sum(map(len, ids.values()))
    assert total / (256 * len(sequences)) > 0.95
    assert packing.pack(df.limit(0), tokenizer("byte_bpe_50k.json"), end_id=1).collect() == []


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    for high in (1, 2, 300, 50_257, 2**32):
        ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
        ids[rng.random(n) < 0.02] = 2**32 - 1  # exceptions
        blocks = token_files.encode_blocks(ids)
        starts = np.concatenate([[0], np.cumsum([len(b) for b in blocks])])[:-1].astype(np.int64)
        back = token_files.decode_blocks(b"".join(blocks), starts) if n else ids
        assert back.tolist() == ids.tolist()


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame(rows(MIXED), SCHEMA).repartition(3)
    manifest = token_files.write_tokens(df, tokenizer("byte_bpe_50k.json"), end_id=2, folder=str(tmp_path / "ids"))
    got = token_files.read_tokens(manifest, "bigint", keep_ids=True).orderBy("start").collect()
    order = sorted(rows(MIXED), key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for r, (key, text, *_) in zip(got, order, strict=True):
        ids = ids_of("byte_bpe_50k.json", text) + [2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.ids) == (key, start, len(ids), crc(ids), ids)
        start += len(ids)
    one = manifest.orderBy("shard").first()
    with token_files.open_folder(one.folder)[0].open_input_file(f"{tmp_path}/ids/{one.file}") as source:
        reader = token_files.Reader(source)
        for number, _, ids in reader.documents():
            assert reader.document(number).tolist() == ids.tolist()
    empty = token_files.write_tokens(df.limit(0), tokenizer("byte_bpe_50k.json"), end_id=2)
    assert token_files.read_tokens(empty, "bigint").collect() == []
