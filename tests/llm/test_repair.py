"""Repairs against an enumeration of all edits, and the parts of the program against their definitions."""

import hashlib
import random
import re
from itertools import product

import pytest

from corpusmap.llm import repair

WORD = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        found = WORD.findall(text)
        out.append("blank" if not found else "duplicate" if (role, text) in seen else "" if found[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Cost, audit and lines of the cheapest edits, from all of them."""
    options, found = [], faults(rows)
    for (role, text), fault in zip(rows, found):
        extra = 3 * (fault == "truncated")
        edits = [("D", 4, [])]
        if fault in ("", "truncated"):
            edits += [("K", extra, [(role, text)]), ("R", 3 + extra, [("user", text)]), ("R", 3 + extra, [("assistant", text)])]
        options.append(edits)
    inserted = [()] + [tuple(p) for n in (1, 2) for p in product(("user", "assistant"), repeat=n)]
    best = None
    for edits in product(*options):
        for where in product(inserted, repeat=len(rows) + 1) if len(rows) < 4 else [w for w in product(inserted, repeat=len(rows) + 1) if sum(map(len, w)) <= 2]:
            cost, audit, lines = 0, "", []
            for i in range(len(rows) + 1):
                cost, audit = cost + 3 * len(where[i]), audit + "I" * len(where[i])
                lines += [(r, "") for r in where[i]]
                if i < len(rows):
                    letter, price, kept = edits[i]
                    cost, audit, lines = cost + price, audit + letter, lines + kept
            if all(r for r, _ in lines) and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in lines)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, lines
    return best


def conversations(seed, number):
    rng = random.Random(seed)
    for _ in range(number):
        rows = []
        for _ in range(rng.randrange(4)):
            if rows and rng.random() < 0.2:
                rows.append(rng.choice(rows))
            else:
                rows.append((rng.choice(["user", "assistant", "system", "tool", "", "user"]), rng.choice(["Hi.", "Yes!", "no end", " ", "", "So?\n", f"t{rng.random()}."])))
        yield rows


def solved(rows):
    symbols = []
    for (role, _), fault in zip(rows, faults(rows)):
        gone = fault in ("blank", "duplicate")
        symbols.append(repair.GONE if gone else repair.SYMBOLS[role[:1] if role[:1] in ("s", "u", "a") else "o", int(fault == "truncated")])
    return bytes(symbols)


def test_matrices():
    every = list(conversations(1, 60))
    for rows, matrix in zip(every, repair.transfers([solved(r) for r in every])):
        assert repair.finished(matrix) == cheapest(rows)[:2], rows


def test_grammar():
    rng = random.Random(2)
    sequences = [bytes(rng.randrange(3) for _ in range(rng.randrange(30))) for _ in range(60)] + [bytes(100), bytes([1, 2] * 40), b"", b"\x01"]
    rules, short = repair.compress(sequences)
    expand = lambda s: bytes([s]) if s < len(repair.MATRICES) else b"".join(map(expand, rules[s - len(repair.MATRICES)]))
    assert [b"".join(map(expand, one)) for one in short] == sequences
    pairs = [p for one in short for p in zip(one, one[1:])]
    assert sum(map(len, short)) < sum(map(len, sequences)) / 3
    assert all(a == b for a, b in set(pairs) if pairs.count((a, b)) > 1)  # three equal ones in a row may be left


def test_long_by_parts():
    """Any cut gives the same audit; ropes share parts."""
    rng = random.Random(3)
    whole = bytes(rng.choice([0, 1, 3, 3, 5, 5, 4, 7]) for _ in range(3000))
    (matrix,) = repair.transfers([whole])
    parts = repair.transfers([whole[i : i + 700] for i in range(0, 3000, 700)])
    chained = repair.UNIT
    for part in parts:
        chained = repair.product(chained, part)
    plain = repair.UNIT
    for s in whole:
        plain = repair.product(plain, repair.MATRICES[s])
    assert repair.finished(matrix) == repair.finished(chained) == repair.finished(plain)


def expected(rows):
    """The result row for ``(turn, role, text)`` rows in any order."""
    fill = lambda x: " " if x is None else x
    rows = [(t, fill(r), fill(x)) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    found = faults([r[1:] for r in rows])
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, lines = cheapest([r[1:] for r in rows])
    text = "\n".join(f"{r}:{t}" for r, t in lines)
    return (gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("flush", [2, 1 << 18])
def test_repair(spark, monkeypatch, flush):
    monkeypatch.setattr(repair, "FLUSH", flush)
    rng = random.Random(flush)
    table, want = [], {}
    for key, rows in enumerate(conversations(4, 50)):
        key = None if key == 7 else key
        rows = [(rng.choice([None, 1, 2, 5]), r or None, t or None) if rng.random() < 0.2 else (i, r, t) for i, (r, t) in enumerate(rows)]
        want[key] = expected(rows)
        table += [(key, *r, "x", 3) for r in rows]
    ids = spark.createDataFrame([(k,) for k in want], "conv_id int")
    rng.shuffle(table)
    rows = spark.createDataFrame(table, "conv_id int, turn int, role string, text string, mark string, place int").repartition(6)
    for dealt in (rows, rows.coalesce(1)):
        got = {r.id: tuple(r)[1:] for r in repair.digests(repair.repair(dealt, ids=ids)).collect()}
        assert got == want
    assert repair.repair(rows.filter("false")).count() == 0


def test_one_conversation_in_many_tasks(spark):
    """A conversation over all tasks gives the audit of its rows in one sequence."""
    rows = [(1, t, ["user", "assistant", "tool", "system"][t * t % 7 % 4], f"Text {t % 900}" + "." * (t % 5 > 0)) for t in range(4000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = repair.digests(repair.repair(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(9))).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    cost, audit = repair.finished(repair.transfers([solved([r[2:] for r in rows])])[0])
    found = faults([r[2:] for r in rows])
    assert (got[0].cost, got[0].audit, got[0].gaps) == (cost, audit, 0) and len(got) == 1
    assert [got[0].blank, got[0].duplicate, got[0].truncated] == [found.count(f) for f in ("blank", "duplicate", "truncated")]
    assert audit.count("K") + audit.count("R") + audit.count("D") == 4000
