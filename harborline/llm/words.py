"""Words of a text with case, punctuation, markup, spacing and typography taken away."""

from __future__ import annotations

import html
import re
import unicodedata

_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_ENTITY = re.compile(r"&(?:#\d+|#x[0-9A-Fa-f]+|[A-Za-z]+);")
#: Characters that are taken out of words: apostrophes, soft hyphens, marks of zero width.
_INSIDE = re.compile("['’‘ʼ`´­​-‏⁠﻿]")
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Case-folded words in order; none for null or blank texts."""
    if not text:
        return []
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = _ENTITY.sub(lambda m: html.unescape(m[0]), text)
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if unicodedata.category(c) != "Mn")
    return _WORD.findall(_INSIDE.sub("", text.casefold()))


def word_spans(text: str) -> list[tuple[str, int, int]]:
    """(word, start, end) with the places in the text as given; the same words as words()."""
    units: list[tuple[str, int, int]] = []
    k = 0
    for m in re.finditer(f"(?P<tag>{_TAG.pattern})|{_ENTITY.pattern}", text):
        units += [(c, i, i + 1) for i, c in enumerate(text[k : m.start()], k)]
        units.append((" " if m["tag"] else html.unescape(m[0]), m.start(), m.end()))
        k = m.end()
    units += [(c, i, i + 1) for i, c in enumerate(text[k:], k)]
    plain, place = [], []
    for c, a, b in units:
        n = "".join(x for x in unicodedata.normalize("NFKD", c) if unicodedata.category(x) != "Mn")
        n = _INSIDE.sub("", n.casefold())
        plain.append(n)
        place += [(a, b)] * len(n)
    joined = "".join(plain)
    return [(m[0], place[m.start()][0], place[m.end() - 1][1]) for m in _WORD.finditer(joined)]
