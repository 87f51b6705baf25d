"""Splitting texts into pieces by a tokenizer's pattern, and remembering what each piece encodes to."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable

# Code points below this one are split by Python's own expressions with spelled-out classes.
NARROW = 0x250


def _spelled(test: Callable[[str], bool]) -> str:
    runs: list[list[int]] = []
    for i in range(NARROW):
        if test(chr(i)):
            if runs and runs[-1][1] == i - 1:
                runs[-1][1] = i
            else:
                runs.append([i, i])
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in runs)


class Splitter:
    """``findall`` of a pattern with \\p{L}, \\p{N} and \\s, exact for any text."""

    def __init__(self, pattern: str) -> None:
        import regex

        letters = _spelled(lambda c: unicodedata.category(c)[0] == "L")
        numbers = _spelled(lambda c: unicodedata.category(c)[0] == "N")
        space = "\\t-\\r \\x85\\xa0"  # White_Space below NARROW
        narrow = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letters}{numbers}]")
        for name, chars in ((r"\p{L}", letters), (r"\p{N}", numbers), (r"\s", space)):
            narrow = narrow.replace(name, f"[{chars}]")
        narrow = narrow.replace(r"\S", f"[^{space}]")
        self.wide = regex.compile(pattern).findall
        self.narrow = None if r"\p" in narrow else re.compile(narrow).findall
        self.is_wide = re.compile(f"[^\\x00-{chr(NARROW - 1)}]").search

    def __call__(self, text: str) -> list[str]:
        if self.narrow is None or (not text.isascii() and self.is_wide(text)):
            return self.wide(text)
        return self.narrow(text)


class Remembered(dict):
    """What short pieces encode to; filled on first use and emptied when full."""

    def __init__(self, encode: Callable[[str], bytes], most: int = 600_000, longest: int = 48) -> None:
        super().__init__()
        self.encode, self.most, self.longest = encode, most, longest

    def __missing__(self, piece: str) -> bytes:
        value = self.encode(piece)
        if len(piece) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[piece] = value
        return value


def kept(name: tuple, make: Callable[[], object]) -> object:
    """An object that stays in a Python worker from task to task."""
    store = sys.__dict__.setdefault("_demandspark_kept", {})
    if name not in store:
        store[name] = make()
    return store[name]
