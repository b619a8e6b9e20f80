"""Pre-tokens of byte-level BPE vocabularies, with the Unicode classes of the public tokenizer libraries."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

# Letters and numbers that Unicode 16 added to Unicode 15.1, as ranges.
LETTERS_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
]
NUMBERS_16 = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]
# The White_Space property.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Below this code point the letter and number sets are small; most European text stays below it.
NEAR = 0x250


def _ranges(kind: str, extra: list[tuple[int, int]], top: int) -> str:
    points = {c for c in range(top) if unicodedata.category(chr(c))[0] == kind}
    points |= {c for a, b in extra for c in range(a, b + 1) if c < top}
    out: list[list[int]] = []
    for c in sorted(points):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


@cache
def _pattern(top: int) -> re.Pattern:
    letter, number = _ranges("L", LETTERS_16, top), _ranges("N", NUMBERS_16, top)
    return re.compile(
        f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{SPACE}{letter}{number}]+"
        f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
    )


_FAR = re.compile(f"[^\\x00-\\U{NEAR - 1:08x}]")


def pretokens(text: str) -> list[str]:
    """The matches of the byte-level pattern, in order; together they are the whole text."""
    return _pattern(sys.maxunicode + 1 if _FAR.search(text) else NEAR).findall(text)
