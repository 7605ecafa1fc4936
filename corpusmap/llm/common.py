"""What several operators share: bytes of Arrow strings, slices of a batch, words."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

SLICE_BYTES = 1 << 21


def fresh(name: str, *frames) -> str:
    """``name``, lengthened until no frame has such a column, so that no input column is hidden."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each string; the cast shares the buffers."""
    binary = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(binary).to_pylist()


def slices(texts: list[bytes | None], most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes each, one row at least, so work arrays stay small."""
    start = held = 0
    for i, text in enumerate(texts):
        size = len(text) if text else 0
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


#: Bytes of UTF-8 text that are no part of an alphanumeric word become spaces; A-Z become a-z.
ALNUM = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def alnum_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of ASCII letters, digits and non-ASCII characters."""
    return text.translate(ALNUM).split() if text else []


def space_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space (0x20 and 0x09 to 0x0D), unchanged."""
    return text.split() if text else []
