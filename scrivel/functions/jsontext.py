"""JSON text with two-blank indentation, non-ASCII kept and lower-case escapes.

``to_json`` cannot indent this way and escapes control characters in upper case, so
scalars and blocks of known shape are put together from expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHORT = {"\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}
_RARE = [chr(n) for n in range(0x20) if chr(n) not in "\t\n\r"]


def json_string(c: Column) -> Column:
    """Quoted JSON string; null gives the word ``null``."""
    text = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit('"'), F.lit('\\"'))
    for ch in "\t\n\r":
        text = F.replace(text, F.lit(ch), F.lit(_SHORT[ch]))
    rare = text
    for ch in _RARE:
        rare = F.replace(rare, F.lit(ch), F.lit(_SHORT.get(ch, f"\\u{ord(ch):04x}")))
    text = F.when(F.rlike(text, F.lit(r"[\x00-\x1f]")), rare).otherwise(text)
    return F.coalesce(F.concat(F.lit('"'), text, F.lit('"')), F.lit("null"))


def json_number(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def json_string_list(c: Column, indent: int) -> Column:
    """List of strings, one per line, ``indent`` blanks deep; an empty list is ``[]``."""
    pad = " " * indent
    lines = F.transform(c, lambda t: F.concat(F.lit(pad + "  "), json_string(t)))
    block = F.concat(
        F.lit("[\n"), F.array_join(lines, ",\n"), F.lit(f"\n{pad}]")
    )
    return F.when(F.size(c) > 0, block).otherwise(F.lit("[]"))


def json_object(fields: list[tuple[str, Column]], indent: int = 0) -> Column:
    """Object whose values are rendered already; ``indent`` is that of the closing brace."""
    pad = " " * indent
    lines = [F.concat(F.lit(f'{pad}  "{name}": '), value) for name, value in fields]
    return F.concat(F.lit("{\n"), F.concat_ws(",\n", *lines), F.lit(f"\n{pad}}}"))
