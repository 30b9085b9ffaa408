"""Fast splitting of steady text: characters whose class all Unicode versions in use agree on.

Python's own expression engine takes explicit character ranges twice as fast as the class
escapes of the ``regex`` package.  The ranges are built from the Unicode database.
Text with any other character has to be split by the tokenizer itself.
"""

from __future__ import annotations

import re
import unicodedata

# Blocks (first, last) in which no Unicode version since 6 has moved a character to another
# class: Latin, combining marks, Cyrillic, general punctuation, the euro sign.
STEADY_BLOCKS = ((0x0000, 0x024F), (0x0300, 0x0373), (0x0400, 0x0481), (0x2010, 0x2027), (0x2030, 0x205E), (0x20AC, 0x20AC))
WHITE = r"\t-\r \x85\xa0"  # the steady characters that count as white space


def _ranges(first_letter: str) -> str:
    """The steady characters of one general category, as the inside of a bracket expression."""
    points = [
        o for low, high in STEADY_BLOCKS for o in range(low, high + 1)
        if unicodedata.category(chr(o)).startswith(first_letter)
    ]
    starts = [o for before, o in zip([-2, *points], points) if o != before + 1]
    ends = [o for o, after in zip(points, [*points[1:], -2]) if after != o + 1]
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(starts, ends))


LETTERS, NUMBERS = _ranges("L"), _ranges("N")
is_steady = re.compile("[" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in STEADY_BLOCKS) + "]*").fullmatch

# The contractions that both schemes split off.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"

#: The split of the byte-level scheme as its files state it, a fixed value.
BYTE_LEVEL_PATTERN = rf"{CONTRACTIONS}| ?\p{{L}}+| ?\p{{N}}+| ?[^\s\p{{L}}\p{{N}}]+|\s+(?!\S)|\s+"
#: The same for steady text.
byte_level = re.compile(
    f"{CONTRACTIONS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{WHITE}{LETTERS}{NUMBERS}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
).findall
#: The split of the scheme with word ends, which drops white space.
word_end = re.compile(f"{CONTRACTIONS}|[{LETTERS}]+|[{NUMBERS}]|[^{WHITE}{LETTERS}{NUMBERS}]+").findall
