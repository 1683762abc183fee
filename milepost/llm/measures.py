"""Counts on one text that the quality rules and the quality classifier build on."""

import numpy as np

BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
SPAN = 5  # words in a window that counts as repeated
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))

NAMES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_adjacent", "n_upper", "n_digits", "n_marks", "n_distinct", "longest",
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of SPAN words found twice or more, the first included."""
    windows = list(zip(*(words[i:] for i in range(SPAN))))
    if len(set(windows)) == len(windows):
        return 0
    first: dict = {}
    inside = np.zeros(len(words), bool)
    for at, window in enumerate(windows):
        earlier = first.setdefault(window, at)
        if earlier != at:
            inside[earlier : earlier + SPAN] = True
            inside[at : at + SPAN] = True
    return int(inside.sum())


def measure(data: bytes | None) -> tuple:
    """The counts in the order of NAMES; all 0 for a null text.

    Words are runs of anything but ASCII white space; lines are cut at \\n, and only
    those with a word count. n_adjacent: words equal to the word before; n_upper:
    A-Z; n_marks: exclamation and question marks; longest: bytes of the longest word.
    """
    if not data:
        return (0,) * len(NAMES)
    words = data.split()
    n = len(words)
    if not n:
        return (0,) * len(NAMES)
    solid = data.translate(None, BLANKS)
    lines = [line for line in data.split(b"\n") if line.strip()]
    distinct = len(set(words))
    return (
        n,
        len(solid.decode()),
        len(solid) - len(solid.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words) if distinct < n else 0,
        len(lines),
        sum(map(bytes.__eq__, words, words[1:])) if distinct < n else 0,
        len(solid) - len(solid.translate(None, _UPPER)),
        len(solid) - len(solid.translate(None, _DIGITS)),
        solid.count(b"!") + solid.count(b"?"),
        distinct,
        max(map(len, words)),
    )
