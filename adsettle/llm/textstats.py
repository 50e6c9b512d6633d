"""Rule statistics of one text, as counts."""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

SPACES = b" \t\n\x0b\x0c\r"  # what bytes.split() splits at
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
CONTINUING = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no code point


class Stats(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_upper: int
    n_marks: int


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = upto = 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


def stats(text: bytes) -> Stats:
    words = text.split()
    packed = text.translate(None, SPACES)
    lines = [x for x in text.split(b"\n") if x.strip()]
    size = len(packed)
    return Stats(
        n_words=len(words),
        word_chars=len(packed.translate(None, CONTINUING)),
        n_symbols=size - len(packed.translate(None, SYMBOLS)),
        n_dup_lines=len(lines) - len(set(lines)),
        n_repeat_words=repeated_words(words),
        n_upper=size - len(packed.translate(None, UPPER)),
        n_marks=packed.count(b"!") + packed.count(b"?"),
    )


def shares(counts):
    """Features from an array of Stats rows, in scales on which good texts lie close together."""
    import numpy as np

    n, chars, symbols, _, repeats, upper, marks = np.asarray(counts, dtype=np.float64).reshape(-1, len(Stats._fields)).T
    words, size = np.maximum(n, 1), np.maximum(chars, 1)
    return np.column_stack(
        [
            np.log1p(100 * symbols / words),
            np.log1p(100 * marks / words),
            np.log1p(100 * upper / size),
            np.log1p(100 * repeats / words) / 2,
            np.log(np.maximum(chars / words, 0.1)),
        ]
    )
