"""Counts over one text, each worked out once and only when asked for."""

from __future__ import annotations

from collections import Counter
from functools import cached_property

WHITE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
#: Bytes that start no code point.
LATER = bytes(range(0x80, 0xC0))
UPPER = bytes(range(0x41, 0x5B))
LETTERS = UPPER + bytes(range(0x61, 0x7B))
DIGITS = b"0123456789"
STOPS = b".!?"


class TextStats:
    """A text as UTF-8 bytes; words are runs of bytes other than ASCII white space."""

    def __init__(self, text: bytes):
        self.text = text

    def count(self, characters: bytes) -> int:
        return len(self.text) - len(self.text.translate(None, characters))

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text.translate(None, WHITE + LATER))

    @cached_property
    def n_symbols(self) -> int:
        return self.count(SYMBOLS)

    @cached_property
    def n_lines(self) -> int:
        return len(self._lines)

    @cached_property
    def _lines(self) -> list[bytes]:
        return [x for x in self.text.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self._lines) - len(set(self._lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that stand in a three-word window found twice or more."""
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        times = Counter(windows)
        if len(times) == len(windows):
            return 0
        covered, reach = 0, 0
        for i, window in enumerate(windows):
            if times[window] > 1:
                covered += i + 3 - max(reach, i)
                reach = i + 3
        return covered

    @cached_property
    def n_upper(self) -> int:
        return self.count(UPPER)

    @cached_property
    def n_letters(self) -> int:
        return self.count(LETTERS)

    @cached_property
    def n_digits(self) -> int:
        return self.count(DIGITS)

    @cached_property
    def n_stops(self) -> int:
        return self.count(STOPS)

    @cached_property
    def n_distinct_words(self) -> int:
        return len(set(self.words))
