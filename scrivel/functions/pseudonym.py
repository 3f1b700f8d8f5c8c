"""Salted pseudonyms for identifiers.

A pseudonym keeps 48 bits of the digest by default, so about n^2 / 2^49 pairs of n distinct
values collide: raise ``hex_len`` beyond some ten million values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrivel.functions.charclass import blank_to_null

# Network location of an absolute or scheme-relative address, port and user included.
_NETLOC = r"^[\x00-\x20]*+(?:[A-Za-z][A-Za-z0-9+.-]*+:)?//([^/?#]*+)"


def pseudonymize(c: Column, salt: str, hex_len: int = 12) -> Column:
    """``user_`` plus the head of SHA-256 over ``salt:value``; null and '' give null."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), blank_to_null(c)), 256)
    return F.concat(F.lit("user_"), F.substring(digest, 1, hex_len))


def network_location(c: Column) -> Column:
    """Lower-cased network location, null if the address has none."""
    plain = F.translate(c, "\t\r\n", "")
    return blank_to_null(F.lower(F.regexp_extract(plain, _NETLOC, 1)))


def domain_hash(c: Column, salt: str, hex_len: int = 12) -> Column:
    return pseudonymize(network_location(c), salt, hex_len)


def public_tags(c: Column, prefix: str = "author_") -> Column:
    """Drop the tags that name a person; a missing list becomes an empty one."""
    tags = F.coalesce(c, F.array().cast("array<string>"))
    return F.filter(tags, lambda t: ~F.startswith(t, F.lit(prefix)))
