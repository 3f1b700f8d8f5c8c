"""Free-text scrubbing: decode, strip tags, mask, squeeze.

The masks lower exposure; they do not make a text anonymous. Capitalised words
followed by punctuation survive, ordinary sentence starts are masked, and ISO dates
and ids of nine or more digits read as phone numbers. Those are the rules, kept as they
are so that results stay comparable.
"""

from __future__ import annotations

import html
import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrivel.functions.charclass import (
    BOUNDARY,
    DIGIT,
    NOT_AFTER_DIGIT,
    NOT_AFTER_WORD,
    SPACE,
    WORD,
    blank_to_null,
    squeeze,
)

# The mask tokens.
EMAIL_MASK = "[EMAIL]"
PHONE_MASK = "[PHONE]"
URL_MASK = "[URL]"
ENTITY_MASK = "[ENTITY] "

TAG = "<[^>]++>"
# The possessive run cannot lose a match: "@" is not part of the run.
EMAIL = f"{BOUNDARY}[{WORD}.+-]++@[{WORD}.-]+\\.[A-Za-z]{{2,}}(?![{WORD}])"
# The look-aheads in front reject most positions before the costlier look-behind runs.
PHONE = f"(?=[+{DIGIT}]){NOT_AFTER_DIGIT}\\+?{DIGIT}[{DIGIT}{SPACE}().-]{{7,}}{DIGIT}(?!{DIGIT})"
URL = f"https?://[^{SPACE}<>'\"]++"
ENTITY = f"(?=[A-Z]){NOT_AFTER_WORD}(?:[A-Z][A-Za-z0-9&.-]*+(?:[{SPACE}]++|\\z)){{1,5}}"

# References frequent enough to decode by plain replaces. "&amp;" comes last:
# decoding it earlier could create references that were not in the text.
_COMMON = ("lt", "gt", "quot", "#39", "#x27", "#x2F", "nbsp", "copy", "middot", "amp")
_NEEDS_TABLE = f"&(?!(?:{'|'.join(_COMMON)});)(?=[#A-Za-z])"

# A text as references, single ampersands and what lies between.
_PIECES = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"
# Names that are known without a semicolon; a longer name may begin with one of them.
_BARE = [name for name in html5 if not name.endswith(";")]
# Numbers that stand for something else than their character: those of an old code page, and noncharacters.
_ODD_NUMBERS = {
    n: html.unescape(f"&#{n};")
    for n in (*range(0xA0), *range(0xFDD0, 0xFDF0), *(p << 16 | 0xFFFE | i for p in range(17) for i in (0, 1)))
    if html.unescape(f"&#{n};") != chr(n)
}


def _if_contains(c: Column, needle: str, changed: Column) -> Column:
    """Spare texts without ``needle`` the pattern; a byte search is far cheaper."""
    return F.when(F.contains(c, F.lit(needle)), changed).otherwise(c)


def _table(values: dict) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "map<string,string>")


def _numbered(piece: Column) -> Column:
    """Character of a numeric reference; numbers beyond all characters give the replacement character."""
    is_hex = F.lower(F.substring(piece, 3, 1)) == "x"
    digits = F.regexp_extract(piece, r"^&#[xX]?0*([0-9a-fA-F]*)", 1)
    given = F.when(digits == "", "0").when(F.length(digits) > 7, "110000").otherwise(digits)
    number = F.when(is_hex, F.conv(given, 16, 10)).otherwise(F.conv(given, 10, 10)).cast("bigint")
    beyond = (F.length(digits) > 7) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    wide = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    odd = F.try_element_at(_table({str(n): c for n, c in _ODD_NUMBERS.items()}), number.cast("string"))
    return F.when(beyond, "\ufffd").otherwise(F.coalesce(odd, wide))


def _by_letter(names: list[str]) -> Column:
    """A table of names for each first letter, so that a search meets few others."""
    tables = [{n: html5[n] for n in names if n[0] == chr(c)} for c in range(ord("A"), ord("z") + 1)]
    return F.from_json(F.lit(json.dumps(tables)), "array<map<string,string>>")


def _named(piece: Column) -> Column:
    """Text of a named reference: of the whole name, or else of the longest beginning that is a name."""
    name = F.substr(piece, F.lit(2))
    table = lambda names: F.get(_by_letter(names), F.ascii(name) - ord("A"))
    whole = F.try_element_at(table(list(html5)), name)
    lengths = {len(n) for n in _BARE}
    beginnings = [
        F.when(F.length(name) > n, F.concat(F.try_element_at(table([x for x in _BARE if len(x) == n]), F.substring(name, 1, n)), F.substr(name, F.lit(n + 1))))
        for n in range(max(lengths), min(lengths) - 1, -1)
    ]
    return F.coalesce(whole, *beginnings, piece)


def decode_entities(c: Column) -> Column:
    """Decode every named and numeric character reference.

    Texts whose references are all common ones are decoded by plain replaces, only others piece by piece.
    """
    native = c
    for name in _COMMON:
        native = F.replace(native, F.lit(f"&{name};"), F.lit(html.unescape(f"&{name};")))

    def decoded(piece: Column) -> Column:
        return (
            F.when(F.startswith(piece, F.lit("&#")) & (F.length(piece) > 2), _numbered(piece))
            .when(F.startswith(piece, F.lit("&")) & (F.length(piece) > 1), _named(piece))
            .otherwise(piece)
        )

    pieces = F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_PIECES), F.lit(0)), decoded), "")
    rare = F.contains(c, F.lit("&")) & F.rlike(c, F.lit(_NEEDS_TABLE))
    return F.when(rare, pieces).otherwise(_if_contains(c, "&", native))


def strip_tags(c: Column) -> Column:
    """Replace each ``<...>`` by one blank."""
    return F.regexp_replace(c, TAG, " ")


def mask_email(c: Column) -> Column:
    return _if_contains(c, "@", F.regexp_replace(c, EMAIL, EMAIL_MASK))


def mask_phone(c: Column) -> Column:
    return F.regexp_replace(c, PHONE, PHONE_MASK)


def mask_url(c: Column) -> Column:
    return _if_contains(c, "http", F.regexp_replace(c, URL, URL_MASK))


def mask_entity(c: Column) -> Column:
    """Mask runs of one to five capitalised ASCII words."""
    return F.regexp_replace(c, ENTITY, ENTITY_MASK)


def squeeze_space(c: Column) -> Column:
    """Squeeze white space; a text without anything else becomes null."""
    return blank_to_null(squeeze(c))


#: The steps of a whole cleaning, in their fixed order.
CLEANING = (decode_entities, strip_tags, mask_email, mask_phone, mask_url, mask_entity, squeeze_space)


def with_clean_texts(table: DataFrame, *columns: str) -> DataFrame:
    """The columns cleaned where they stand; null and blank texts give null.

    Every step is a projection of its own, for all columns side by side. A step names its input several times, so steps
    nested in one expression would grow by that factor each.
    """
    for step in CLEANING:
        table = table.withColumns({c: step(F.col(f"`{c}`")) for c in columns})
    return table
