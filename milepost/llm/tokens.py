"""Token ids of whole texts with a given tokenizer file, encoded in balanced batches.

A text is cut where the tokenizer can never join two sides: at such a safe boundary
the ids of the parts are, one after the other, the ids of the whole. The parts of a
batch are looked up in a bounded memo, and those not seen yet are encoded together.
"""

import json
import os
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ROWS = 2500  # texts handed to an encoder at once
BATCH_BYTES = 8 << 20  # text per batch; longer texts are cut, so no batch is much larger
MEMO_HELD = 96 << 20  # bytes of parts and ids that a worker remembers
MEMO_ENTRY = 256  # bytes of one of them, about: a part of MEMO_BYTES at most, its ids, and its place
MEMO_PARTS = MEMO_HELD // MEMO_ENTRY // 2  # remembered before those not met since the last time are dropped
JOINED = 4096  # new parts that are encoded as one text, where that is possible
MEMO_BYTES = 48  # longer parts are encoded each time

_FIRST = b"\xff"  # never in UTF-8: marks a part without the space before it
# A part between two spaces that is empty or has white space at an end.
_UNEVEN = r"^$|^[\s\v{0}]|[\s\v{0}]$".format(r"\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
_EDGE, _WIDE_FIRST, _WIDE_LAST = (np.isin(np.arange(256), list(x)) for x in (b"\t\n\x0b\x0c\r ", b"\xc2\xe1\xe2\xe3", b"\x85\x9f\xa0\xa8\xa9\xaf" + bytes(range(0x80, 0x8B))))
_TAIL = b".,;:!?"
_SAFE = re.compile(r"(?<=\S)(?= \S)")
_SAFE_SPACE = re.compile(rb"(?<=[!-~]) (?=[!-~])")  # between visible ASCII characters
_BLANK = re.compile(rb"[\t-\r ]")


def boundary_of(path: str) -> str:
    """How texts can be cut for this file: 'space' (before a single space, which
    belongs to the next word), 'blank' (at white space, which is dropped), or
    'none' (whole texts only)."""
    if not path.endswith(".json"):
        return "none"
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    stray = [t for t in spec["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]]
    if stray or spec["post_processor"] and spec["post_processor"]["type"] != "ByteLevel" or spec["model"]["type"] != "BPE":
        return "none"
    pre = spec["pre_tokenizer"] or {}
    if spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
        return "space"
    parts = pre.get("pretokenizers", [])
    if parts and parts[0]["type"] == "Split" and parts[0]["behavior"] == "Removed" and parts[0]["invert"]:
        pattern = parts[0]["pattern"].get("Regex", "")
        return "blank" if r"[^\s\p{L}\p{N}]+" in pattern and " " not in pattern else "none"
    return "none"


def _bytes(words: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """Words as bytes, and which of them are empty or have white space at an end."""
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2].to_pybytes() if words.buffers()[2] else b""
    bounds = ends.tolist()
    raw = np.frombuffer(data or b" ", np.uint8)
    first, last = raw[np.minimum(ends[:-1], len(raw) - 1)], raw[np.maximum(ends[1:] - 1, 0)]
    uneven = (ends[1:] == ends[:-1]) | _EDGE[first] | _EDGE[last]
    doubtful = np.flatnonzero(~uneven & (_WIDE_FIRST[first] | _WIDE_LAST[last]))
    if len(doubtful):
        uneven[doubtful] = pc.match_substring_regex(words.take(pa.array(doubtful)), _UNEVEN).to_numpy(zero_copy_only=False)
    return [data[a:b] for a, b in zip(bounds, bounds[1:])], uneven


class _Tails(dict):
    """Ids or count of the punctuation after a word."""

    def __init__(self, encoder):
        self.encoder = encoder

    def __missing__(self, tail: bytes):
        if len(self) > 10_000:
            self.clear()
        value = self[tail] = self.encoder._alone([_FIRST + tail])[0]
        return value


class Encoder:
    """Ids (or only their number) of UTF-8 texts, as the library gives them without
    added special tokens. Special strings inside a text are handled as its default."""

    def __init__(self, path: str, lengths_only: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        self.boundary, self.lengths_only = boundary_of(path), lengths_only
        self.memo, self.older, self.tails = {}, {}, _Tails(self)
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._batch = lambda texts: model.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self._batch = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
            if self.boundary == "space":  # \u0120 is how byte-level vocabularies write a space
                size = max(model.get_vocab().values()) + 1
                self.begins = np.array([(model.id_to_token(i) or "").startswith("\u0120") for i in range(size)])

    def forget(self) -> None:
        self.memo, self.older = {}, {}
        self.tails.clear()

    def _cuts(self, data: bytes) -> list[tuple[bytes, bool]]:
        """A text in pieces of about BATCH_BYTES at most, cut at safe boundaries; and
        whether a piece follows a space that belongs to it."""
        if self.boundary == "none":
            return [(data, False)]
        find = (_BLANK if self.boundary == "blank" else _SAFE_SPACE).search
        out, begin, after = [], 0, False
        while len(data) - begin > BATCH_BYTES and (found := find(data, begin + BATCH_BYTES)):
            out.append((data[begin : found.start()], after))
            begin, after = found.end(), True
        return [*out, (data[begin:], after)]

    def _text(self, part: bytes) -> str:
        if part[:1] == _FIRST:
            return part[1:].decode()
        return part.decode() if self.boundary == "blank" else " " + part.decode()

    def _together(self, parts: list[bytes]) -> list:
        """Plain parts as one text: each begins with its only space, so each of
        its tokens that begins with a space begins a part."""
        out = []
        for at in range(0, len(parts), JOINED):
            some = parts[at : at + JOINED]
            ids = np.array(self._batch([" " + b" ".join(some).decode()])[0], "<u4")
            begins = np.flatnonzero(self.begins[ids])
            if len(begins) != len(some):
                out += self._alone(some)
                continue
            ends = [*begins[1:].tolist(), len(ids)]
            if self.lengths_only:
                out += [b - a for a, b in zip(begins.tolist(), ends)]
            else:
                raw = ids.tobytes()
                out += [raw[4 * a : 4 * b] for a, b in zip(begins.tolist(), ends)]
        return out

    def _alone(self, parts: list[bytes]) -> list:
        ids = self._batch([self._text(p) for p in parts])
        return list(map(len, ids)) if self.lengths_only else [array("I", x).tobytes() for x in ids]

    def _look_up(self, words: list[bytes]) -> list:
        """Ids or counts of words without white space at their ends."""
        if len(self.memo) > MEMO_PARTS:
            self.older, self.memo = self.memo, {}
        values = list(map(self.memo.get, words))
        missing = [i for i, v in enumerate(values) if v is None]
        if missing and self.older:
            for i in missing:
                if (v := self.older.get(words[i])) is not None:
                    values[i] = self.memo[words[i]] = v
            missing = [i for i in missing if values[i] is None]
        if missing:
            parts = [words[i] for i in missing]
            # A letter or digit and the punctuation after it are never joined.
            stems = [s if (s := p.rstrip(_TAIL)) and s[-1:].isalnum() else p for p in parts]
            memo, older, tails = self.memo, self.older, self.tails
            fresh = [s for s in dict.fromkeys(stems) if s not in memo and s not in older]
            memo.update(zip(fresh, self._together(fresh) if self.boundary == "space" else self._alone(fresh)))
            for i, p, s in zip(missing, parts, stems):
                v = memo.get(s)
                if v is None:
                    v = memo[s] = older[s]
                if s is not p:
                    v = memo[p] = v + tails[p[len(s) :]]
                values[i] = v
            for p in chain(parts, fresh) if max(map(len, parts)) > MEMO_BYTES else ():
                if len(p) > MEMO_BYTES:
                    memo.pop(p, None)
        return values

    def _of_batch(self, pieces: list[tuple[bytes, bool]]) -> list:
        """What each piece comes to: id bytes or counts."""
        if self.boundary == "none":
            return self._alone([_FIRST + data for data, _ in pieces])
        blank = self.boundary == "blank"
        text = pa.array([data for data, _ in pieces], pa.large_string())
        split = pc.ascii_split_whitespace(text) if blank else pc.split_pattern(text, " ")
        sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        coded = split.flatten().dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if blank:
            return self._gather(self._look_up(_bytes(coded.dictionary)[0]), index, ends)

        # A space beside other white space is no safe boundary: such texts go by expression.
        words, uneven = _bytes(coded.dictionary)
        texts = np.repeat(np.arange(len(pieces)), sizes)
        odd = np.unique(texts[uneven[index]]) if uneven.any() else np.zeros(0, int)
        place = np.cumsum(~uneven) - 1  # a word's number among the even ones
        values = self._look_up([w for w, u in zip(words, uneven.tolist()) if not u] if len(odd) else words)
        heads = np.array([k for k, (_, after) in enumerate(pieces) if not after], int)
        heads = heads[~np.isin(heads, odd)]  # their first word has no space before it
        at = ends[heads] - sizes[heads]
        first = [words[i] for i in index[at].tolist()]
        index = place[index] if len(odd) else index
        index[at] = len(values) + np.arange(len(at))
        values = (values or [b"" if not self.lengths_only else 0]) if len(odd) else values
        values += self._alone([_FIRST + w for w in first])
        out = self._gather(values, index, ends, set(odd.tolist()))
        for k in odd.tolist():
            data, after = pieces[k]
            parts = [p.encode() for p in _SAFE.split((b" " * after + data).decode())]
            parts = [p[1:] if p[:1] == b" " and (j or after) else _FIRST + p for j, p in enumerate(parts)]
            value = self._alone(parts)
            out[k] = sum(value) if self.lengths_only else b"".join(value)
        return out

    def _gather(self, values: list, index: np.ndarray, ends: np.ndarray, skip=()) -> list:
        """values[index] joined per text; a text's words end at its number in `ends`."""
        n = np.array(values if self.lengths_only else list(map(len, values)), np.int64)
        if not self.lengths_only:
            n //= 4
        upto = np.concatenate([[0], np.cumsum(n[index])])
        bounds = upto[np.concatenate([[0], ends])].tolist()
        if self.lengths_only:
            return [b - a for a, b in zip(bounds, bounds[1:])]
        pool = np.frombuffer(b"".join(values), "<u4")
        begins = np.concatenate([[0], np.cumsum(n)])[:-1]
        place = np.arange(upto[-1])
        place += np.repeat(begins[index] - upto[:-1], n[index])
        ids = pool[place].tobytes()
        return [b"" if k in skip else ids[4 * a : 4 * b] for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]

    def encode(self, texts: list) -> list:
        """Per text (UTF-8 bytes; None counts as empty) its ids as little-endian
        unsigned 32-bit bytes, or their number."""
        out, batch, owners, size = [0 if self.lengths_only else b""] * len(texts), [], [], 0

        def flush():
            for i, value in zip(owners, self._of_batch(batch)):
                out[i] += value
            batch.clear()
            owners.clear()

        for i, data in enumerate(texts):
            if not data:
                continue
            for piece in self._cuts(data) if len(data) > BATCH_BYTES else [(data, False)]:
                batch.append(piece)
                owners.append(i)
                size += len(piece[0])
                if size >= BATCH_BYTES:
                    flush()
                    size = 0
        if batch:
            flush()
        return out


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, lengths_only: bool = False) -> Encoder:
    """One per worker process, so that its memo serves all tasks there. Only the encoder in use
    keeps a memo, so several of them hold no more than one."""
    key = (path, lengths_only)
    for other, known in _encoders.items():
        if other != key:
            known.forget()
    if key not in _encoders:
        _encoders[key] = Encoder(path, lengths_only)
    return _encoders[key]
