"""String expressions, all JVM-side."""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column, functions as F

TOKEN = r"\p{L}+"


@functools.cache
def _accent_table() -> tuple[str, str]:
    """Characters whose canonical decomposition has one ASCII letter or digit, and that character."""
    source, target = [], []
    for point in range(0x80, sys.maxunicode + 1):
        if 0xAC00 <= point <= 0xD7A3 or 0xD800 <= point <= 0xDFFF:
            continue  # Hangul syllables and surrogates never hold ASCII
        plain = [c for c in unicodedata.normalize("NFD", chr(point)) if c.isascii() and c.isalnum()]
        if len(plain) == 1:
            source.append(chr(point))
            target.append(plain[0])
    return "".join(source), "".join(target)


def strip_accents(c: Column) -> Column:
    """Accented Latin letters as their base letter. Combining marks are left for the caller."""
    return F.translate(c, *_accent_table())


def slug(c: Column) -> Column:
    """Lower-case name of letters, digits and single dashes."""
    dashed = F.regexp_replace(F.lower(strip_accents(c)), "[ _]", "-")
    return F.regexp_replace(F.regexp_replace(dashed, "[^a-z0-9-]", ""), "-+", "-")


def slug_identifier(c: Column) -> Column:
    """``owner/name`` with the name part as a slug; the owner stays as it is."""
    at = F.instr(c, "/")
    owner = F.substring(c, F.lit(1), at)
    return F.concat(owner, slug(F.substring(c, at + 1, F.length(c))))


def is_identifier(c: Column) -> Column:
    """True iff the key has exactly one slash."""
    return F.size(F.split(c, "/")) == 2


def compact_key(c: Column) -> Column:
    """A whole number as base64 of its shortest big-endian bytes, without padding."""
    return F.rtrim(F.base64(F.unhex(F.hex(c))), F.lit("="))


def null_text(c: Column) -> Column:
    """Null and empty strings as the literal ``null``."""
    return F.when(c.isNull() | (c == ""), F.lit("null")).otherwise(c)


def tokens(c: Column) -> Column:
    """Lower-cased runs of letters."""
    return F.regexp_extract_all(F.lower(c), F.lit(f"({TOKEN})"), F.lit(1))


def token_hash(c: Column) -> Column:
    """The first 32 bits of a token's MD5, as a non-negative bigint."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint")


def seeded_order(c: Column, seed: int) -> Column:
    """A reproducible random order over ids."""
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))
