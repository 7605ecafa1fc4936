"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.functions import arrow_udf

#: Kinds in the order that breaks ties of the start; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
ORDER = {kind: i for i, kind in enumerate(KINDS)}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A match can never start inside a run of digits, because the one before took the run to its end.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

#: Words that make a kind likelier when they stand close before or after a span.
CONTEXT = {
    "email": ("mail", "contact", "kontakt", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "credit", "karte", "tarjeta", "carte"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "llame"),
    "iban": ("iban", "bank", "account", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social", "security"),
}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.85, "phone": 0.7, "iban": 0.95, "ssn": 0.5}
NEAR, BONUS = 40, 0.3
CONTEXT_RE = {kind: re.compile("|".join(rf"\b{w}" for w in words), re.IGNORECASE) for kind, words in CONTEXT.items()}


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod_97(code: str) -> bool:
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost matches, in one pass: the local part is the run of its characters before an @."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        # the run before the next @ is not looked at again, so a long one costs one pass
        floor = found.end() if found else at + 1
        if found:
            yield start, found.end()
        at = text.find("@", floor)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def spans(text: str | None) -> list[dict]:
    """All spans of a text in order: kind, start, end (code points), base, score."""
    if not text:
        return []
    found: list[tuple[int, int, str]] = []
    if "@" in text:
        found += [(a, b, "email") for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(m[0].count, "0123456789")) <= 15:
                found.append((m.start(), m.end(), "phone"))
    for m in IBAN.finditer(text):
        code = m[0].replace(" ", "")
        if 15 <= len(code) <= 34 and mod_97(code):
            found.append((m.start(), m.end(), "iban"))
    if "-" in text:
        for m in SSN.finditer(text):
            if _score(text, m.start(), m.end(), "ssn") > PRIOR["ssn"]:
                found.append((m.start(), m.end(), "ssn"))
    return [
        {"kind": kind, "start": a, "end": b, "base": kind in BASE, "score": _score(text, a, b, kind)}
        for a, b, kind in sorted(found, key=lambda s: (s[0], ORDER[s[2]], s[1]))
    ]


def _score(text: str, start: int, end: int, kind: str) -> float:
    near = CONTEXT_RE[kind].search(text[max(0, start - NEAR) : start]) or CONTEXT_RE[kind].search(text[end : end + NEAR])
    return min(1.0, PRIOR[kind] + BONUS * bool(near))


def masked(text: str | None) -> str | None:
    """The text with each span, or each chain of overlapping ones, replaced by its kind in brackets."""
    if not text:
        return text
    parts, upto = [], 0
    for s in spans(text):
        if s["start"] >= upto:
            parts += [text[upto : s["start"]], f"[{s['kind'].upper()}]"]
        upto = max(upto, s["end"])
    return "".join(parts) + text[upto:]


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())])


def find_pii(text: Column) -> Column:
    """Array of spans in each text: ``kind, start, end, base, score``.

    Offsets count code points of the whole text. Base kinds follow fixed patterns, leftmost and
    without overlaps per kind; matches that fail their check are dropped and not tried again.
    IBANs (mod-97) and social security numbers (only near a telling word) come on top. Null and
    empty texts have no spans; rows are judged alone.
    """

    @arrow_udf("array<struct<kind:string,start:bigint,end:bigint,base:boolean,score:double>>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([spans(t.as_py()) for t in batch], pa.list_(SPAN))

    return find(text.cast("string"))


def mask_pii(text: Column) -> Column:
    """The texts with personal data replaced by the kind in brackets; null stays null."""

    @arrow_udf("string")
    def mask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([masked(t.as_py()) for t in batch], pa.string())

    return mask(text.cast("string"))


def digest(found: str, base_only: bool) -> Column:
    """``kind:start:end`` of the spans, comma-joined in their order."""
    kept = F.filter(found, lambda s: s["base"]) if base_only else F.col(found)
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(found: str, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")
