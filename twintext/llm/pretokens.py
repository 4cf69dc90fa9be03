"""Splitting a text into the words that byte-level vocabularies work on."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

# Fixed value: the public split pattern, with white space as Unicode defines it.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


#: Texts of these characters are split the same way with plain classes, which is several times as fast.
PLAIN = "[ \n!-~\u00a1-\u012f\u0131-\u024f]*"
#: Letters and numbers among them and among their lower-case forms.
PLAIN_LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af\u2c65\u2c66"
PLAIN_NUMBERS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_PLAIN_PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{PLAIN_LETTERS}]+| ?[{PLAIN_NUMBERS}]+"
    rf"| ?[^ \n{PLAIN_LETTERS}{PLAIN_NUMBERS}]+|[ \n]+(?![^ \n])|[ \n]+"
)


@lru_cache
def splitter(specials: Sequence[str] = ()) -> Callable[[str], Iterator[list[str]]]:
    """Words of a text, in lists; a special string stands alone in its list."""
    import regex

    any_words = regex.compile(PATTERN).findall
    plain, plain_words = re.compile(PLAIN).fullmatch, re.compile(_PLAIN_PATTERN).findall
    # Longer strings first, so that of two at one place the longer one counts.
    marks = "|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))
    cut = regex.compile(f"({marks})").split

    def words(text: str) -> list[str]:
        return plain_words(text) if plain(text) else any_words(text)

    def split(text: str) -> Iterator[list[str]]:
        if not any(s in text for s in specials):
            yield words(text)
            return
        for k, part in enumerate(cut(text)):
            if part:
                yield [part] if k % 2 else words(part)

    return split


class WordTable(dict):
    """Results by word, computed when first asked for.

    Emptied when it holds ``limit`` words, which
    bounds the memory and changes no result. Words too long to come again are
    not kept.
    """

    def __init__(self, compute: Callable[[str], object], limit: int = 600_000, longest: int = 64):
        super().__init__()
        self._compute, self._limit, self._longest = compute, limit, longest

    def __missing__(self, word: str):
        value = self._compute(word)
        if len(word) <= self._longest:
            if len(self) >= self._limit:
                self.clear()
            self[word] = value
        return value
