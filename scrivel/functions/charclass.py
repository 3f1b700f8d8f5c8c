"""Character classes shared by every pattern of the package.

The jobs follow Unicode text rules: letters and digits of every script are word
characters, full-width digits are digits, and the file/group/record/unit
separators count as white space. Java's ``\\w``, ``\\d`` and ``\\s`` are narrower (or,
under ``(?U)``, differ on marks and superscripts), so the classes are spelled
out. Spell them inside ``[...]``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
DIGIT = r"\p{Nd}"
SPACE = r"\p{IsWhite_Space}\x1c-\x1f"

# Java look-behinds step over whole code points only if they spell one beyond the basic
# plane; the noncharacter serves for that and occurs in no text.
_WIDE = "\U0010ffff"
NOT_AFTER_WORD = f"(?<![{WORD}{_WIDE}])"
AFTER_WORD = f"(?<=[{WORD}{_WIDE}])"
NOT_AFTER_DIGIT = f"(?<![{DIGIT}{_WIDE}])"

# Position between a word and a non-word character, in either direction.
BOUNDARY = f"(?:{NOT_AFTER_WORD}(?=[{WORD}])|{AFTER_WORD}(?![{WORD}]))"

# The members of SPACE one by one, for trimming without a pattern.
_SPACES = "".join(chr(n) for n in range(0x3001) if chr(n).isspace())

# Full-width digits, accepted wherever a number is read.
_WIDE_DIGITS = "０１２３４５６７８９"


def strip(c: Column) -> Column:
    """Remove white space of any kind from both ends (``trim`` removes blanks only)."""
    return F.btrim(c, F.lit(_SPACES))


def squeeze(c: Column) -> Column:
    """Turn each run of white space into one blank and trim the ends."""
    return F.trim(F.regexp_replace(c, f"[{SPACE}]++", " "))


def ascii_digits(c: Column) -> Column:
    return F.translate(c, _WIDE_DIGITS, "0123456789")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))
