"""The word rule shared by the native text operators, as Spark SQL text.

Words are maximal runs of ASCII digits, ASCII letters (lower-cased) and any character
from U+0080 on. Other languages are left alone: only A-Z changes case, so the rule gives
the same words in every engine.
"""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # the same before A-Z are lower-cased
RAW_WORD = RAW_SEPARATOR.replace("[", "[^", 1)


def lowered(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{UPPER.lower()}')"


def word_array(text: str) -> str:
    """SQL for the array of words of the SQL expression ``text``; null for null."""
    # ASCII words have a fast lower(); of the others only those with A-Z need the slower translate().
    low = f"IF(octet_length(w) = length(w), lower(w), IF(w RLIKE '[A-Z]', {lowered('w')}, w))"
    return f"transform({raw_words(text)}, w -> {low})"


def raw_words(text: str) -> str:
    """SQL for the same words as they are written."""
    pattern = RAW_SEPARATOR.replace("\\", "\\\\")
    return f"filter(split({text}, '{pattern}', -1), w -> w != '')"
