"""Repair of conversation structure by a grammar-compressed dynamic program.

Each row of a conversation is a symbol: its role's initial and whether it is cut off, or one symbol for rows that have to
go. A symbol has a min-plus transfer matrix between the states of the grammar ``(s?(ua)+)?``: the least cost of an edit of
the row, with inserts before it, and the audit (initials of the edits) that comes first among the cheapest. The sequences
of all conversations of a task are compressed together by Re-Pair; each rule's matrix is the product of its two sides,
computed once, bottom-up, and shared by every conversation that holds the rule. Audits are ropes, so products copy nothing.

Equal costs with one audit a proper prefix of the other can't meet in a product, as the rest would hold inserts only
and each costs something, so the first audit of a whole is made of first audits of its parts.

Rows are dealt by ranges of conversation and turn. A conversation that lies in several tasks is a chain of matrices,
so no task needs all rows of a long one.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusmap.session import cut_lineage

RENAME, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
START, SYSTEM, USER, DONE = range(4)  # nothing yet; after a system row; after a user row; after an assistant row
STATES = (START, SYSTEM, USER, DONE)
#: From a state on: a row of this role leads there. A state has one role to insert or rename to.
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", DONE), DONE: ("user", USER)}
GONE, OTHER = 0, "o"
SYMBOLS = {**{(c, cut): 1 + 2 * i + cut for i, c in enumerate("sua" + OTHER) for cut in (0, 1)}}
#: Symbols of a task that are compressed together.
FLUSH = 1 << 18
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
SPACE = r"\x20\x09-\x0D"


class Rope:
    """Two joined strings or ropes."""

    __slots__ = ("left", "right", "size")

    def __init__(self, left, right):
        self.left, self.right, self.size = left, right, _size(left) + _size(right)


def _size(rope) -> int:
    return len(rope) if isinstance(rope, str) else rope.size


def joined(a, b):
    """Both ropes as one; short ones as a plain string."""
    if not _size(a) or not _size(b):
        return a if _size(a) else b
    return a + b if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= 64 else Rope(a, b)


def flat(rope) -> str:
    out, waiting = [], [rope]
    while waiting:
        top = waiting.pop()
        if isinstance(top, str):
            out.append(top)
        else:
            waiting += (top.right, top.left)
    return "".join(out)


def before(a, b) -> bool:
    """Whether rope ``a`` comes before rope ``b``; parts that both share are passed over."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if isinstance(x, str) and isinstance(y, str):
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x[:n] < y[:n]
            if len(x) > n:
                left.append(x[n:])
            if len(y) > n:
                right.append(y[n:])
        elif not isinstance(x, str) and _size(x) >= _size(y):
            left += (x.right, x.left)
            right.append(y)
        else:
            left.append(x)
            right += (y.right, y.left)
    return bool(right) and not left


def _better(old, cost, a, b):
    """The entry of the cheaper edits, or of the first audit of equal ones."""
    if old is None or cost < old[0]:
        return cost, joined(a, b)
    if cost == old[0]:
        rope = joined(a, b)
        if before(rope, old[1]):
            return cost, rope
    return old


def product(left: list, right: list) -> list:
    """Min-plus product of two matrices, rows by state before, columns by state after."""
    out = []
    for row in left:
        new: list = [None] * 4
        for mid, first in enumerate(row):
            if first is None:
                continue
            for to, second in enumerate(right[mid]):
                if second is not None:
                    new[to] = _better(new[to], first[0] + second[0], first[1], second[1])
        out.append(new)
    return out


def _inserts() -> list:
    """No insert, or one or two of them, from each state."""
    none = [[(0, "") if i == j else None for j in STATES] for i in STATES]
    one = [[(INSERT, "I") if NEXT[i][1] == j else None for j in STATES] for i in STATES]
    both = product(one, one)
    for i in STATES:
        for j in STATES:
            for other in (one, both):
                if other[i][j] is not None:
                    none[i][j] = _better(none[i][j], *other[i][j], "")
    return none


INSERTS = _inserts()


def _matrices() -> list:
    """The transfer matrix of each symbol."""
    out = []
    for symbol in range(1 + len(SYMBOLS)):
        role, cut = next((k for k, v in SYMBOLS.items() if v == symbol), (None, 0))
        edit: list = [[(DELETE, "D") if i == j else None for j in STATES] for i in STATES]
        for i in STATES:
            if symbol != GONE:
                to = NEXT[i][1]
                edit[i][to] = _better(edit[i][to], RENAME + CUT_OFF * cut, "R", "")
                kept = {"s": SYSTEM if i == START else None, "u": to if to == USER else None, "a": to if to == DONE else None}.get(role)
                if kept is not None:
                    edit[i][kept] = _better(edit[i][kept], CUT_OFF * cut, "K", "")
        out.append(product(INSERTS, edit))
    return out


MATRICES = _matrices()


def compress(sequences: list[bytes]) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Re-Pair: rules (the first is symbol ``len(MATRICES)``) and the sequences in terms of them.

    The most frequent pair of neighbours becomes a rule, until none is there twice.
    """
    symbols: list[int] = []
    starts = []
    for one in sequences:
        starts.append(len(symbols))
        symbols.extend(one)
        symbols.append(-1)
    n = len(symbols)
    after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i in range(n - 1):
        if symbols[i] >= 0 and symbols[i + 1] >= 0:
            places[symbols[i], symbols[i + 1]].append(i)
    heap = [(-len(found), pair) for pair, found in places.items() if len(found) > 1]
    heapify(heap)
    rules: list[tuple[int, int]] = []
    while heap:
        size, pair = heappop(heap)
        if -size != len(places[pair]):
            continue  # there is a later entry with the right number
        a, b = pair
        taken, last = [], -1
        for i in sorted(set(places.pop(pair))):
            if symbols[i] == a and after[i] < n and symbols[after[i]] == b and i != last:
                taken.append(i)
                last = after[i]
        if len(taken) < 2:
            continue
        new = len(MATRICES) + len(rules)
        rules.append(pair)
        touched = set()
        for i in taken:
            j = after[i]
            k = after[j]
            symbols[i], symbols[j], after[i] = new, -2, k
            if k < n:
                prior[k] = i
                if symbols[k] >= 0:
                    places[new, symbols[k]].append(i)
                    touched.add((new, symbols[k]))
            h = prior[i]
            if h >= 0 and symbols[h] >= 0:
                places[symbols[h], new].append(h)
                touched.add((symbols[h], new))
        for key in touched:
            if len(places[key]) > 1:
                heappush(heap, (-len(places[key]), key))
    out = []
    for at in starts:
        one = []
        while symbols[at] != -1:
            one.append(symbols[at])
            at = after[at]
        out.append(one)
    return rules, out


def transfers(sequences: list[bytes]) -> list[list]:
    """The matrix of each sequence; equal sequences and equal parts share the work."""
    known = list(dict.fromkeys(sequences))
    rules, short = compress(known)
    matrices = list(MATRICES)
    for a, b in rules:
        matrices.append(product(matrices[a], matrices[b]))
    found = {}
    for one, symbols in zip(known, short):
        whole = UNIT
        for s in symbols:
            whole = product(whole, matrices[s])
        found[one] = whole
    return [found[one] for one in sequences]


UNIT = [[(0, "") if i == j else None for j in STATES] for i in STATES]


def finished(matrix: list) -> tuple[int, str]:
    """Cost and audit of a whole conversation, with the inserts at its end."""
    best = None
    for mid, first in enumerate(matrix[START]):
        for to in (START, DONE):
            if first is not None and INSERTS[mid][to] is not None:
                last = INSERTS[mid][to]
                best = _better(best, first[0] + last[0], first[1], last[1])
    return best[0], flat(best[1])


def plain_rows(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``id, turn, role, text, mark``: nulls of role and text are one space; ``mark`` orders rows of one turn and role."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    return rows.select(F.col(id_col).alias("id"), F.col(turn_col).cast("bigint").alias("turn"), role.alias("role"), text.alias("text")).withColumn("mark", F.md5("text"))


def order_columns() -> list[Column]:
    return [F.col("id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("mark")]


def symbol_rows(plain: DataFrame) -> DataFrame:
    """``id, turn, role, mark, initial, fault, n``: equal rows of a turn counted; ``fault`` is that of the first of them."""
    ends = F.regexp_extract("text", f"(?s)([^{SPACE}])[{SPACE}]*\\z", 1)
    fault = F.when(ends == "", "blank").when(ends.isin(".", "!", "?"), "").otherwise("truncated")
    light = plain.select("id", "turn", "role", "mark", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    light = light.groupBy("id", "turn", "role", "mark").agg(F.count("*").alias("n"), F.min("initial").alias("initial"), F.min("fault").alias("fault"))
    # only texts said in several turns of a conversation meet their first turn
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = light.groupBy("id", "role", "mark").agg(F.min(turn).alias("first"), F.count("*").alias("turns")).filter("turns > 1")
    again = again.select(F.col("id").alias("b_id"), F.col("role").alias("b_role"), F.col("mark").alias("b_mark"), "first")
    met = light.join(again, F.col("id").eqNullSafe(F.col("b_id")) & (F.col("role") == F.col("b_role")) & (F.col("mark") == F.col("b_mark")), "left")
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return met.select("id", "turn", "role", "mark", "initial", F.when(later & (F.col("fault") != "blank"), "duplicate").otherwise(F.col("fault")).alias("fault"), "n")


class Part:
    """What a task has seen of one conversation."""

    def __init__(self, key, turn, initial: str):
        self.key, self.first_turn, self.first_initial = key, turn, initial
        self.last_turn, self.last_initial = None, None
        self.low = self.high = None
        self.turns = self.illegal = 0
        self.faults = Counter()
        self.symbols = bytearray()
        self.matrix, self.kept = UNIT, None

    def add(self, turn, initial: str, fault: str, n: int) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += self.high != turn
            self.high = turn
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in ("su", "ua", "au")
        self.illegal += n - 1  # equal neighbours
        self.last_turn, self.last_initial = turn, initial
        rest = "blank" if fault == "blank" else "duplicate"
        self.faults[fault] += 1
        self.faults[rest] += n - 1
        first = GONE if fault in ("blank", "duplicate") else SYMBOLS[initial if initial in ("s", "u", "a") else OTHER, int(fault == "truncated")]
        self.symbols.append(first)
        self.symbols += bytes(n - 1)


def _then(a: dict, b: dict) -> dict:
    """Counts of two neighbouring parts of one conversation together."""
    out = {k: a[k] + b[k] for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
    out["illegal"] += a["last_initial"] + b["first_initial"] not in ("su", "ua", "au")
    out["turns"] -= a["high"] is not None and a["high"] == b["low"]
    out["low"] = b["low"] if a["low"] is None else a["low"]
    out["high"] = a["high"] if b["high"] is None else b["high"]
    return out | {"first_initial": a["first_initial"], "last_initial": b["last_initial"]}


FACTS = ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high")
PART = (
    "whole boolean, first_turn bigint, first_role string, first_mark string, "
    + ", ".join(f"{f} bigint" for f in FACTS)
    + ", first_initial string, last_initial string, costs array<bigint>, audits array<string>"
)


def audits(plain: DataFrame) -> DataFrame:
    """``id, gaps, blank, duplicate, truncated, illegal, cost, audit`` for every conversation with a row."""
    kind = plain.schema["id"].dataType.simpleString()
    rows = symbol_rows(plain).repartitionByRange(*order_columns()).sortWithinPartitions(*order_columns())

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[Part] = []
        part, first, held = None, True, 0

        def solve(parts: list[Part]) -> None:
            for p, m in zip(parts, transfers([bytes(p.symbols) for p in parts])):
                p.matrix = m if p.matrix is UNIT else product(p.matrix, m)
                p.symbols = bytearray()

        def rows_of(parts: list[Part], id_type) -> pa.RecordBatch:
            columns: dict[str, list] = defaultdict(list)
            for p in parts:
                entries = [finished(p.matrix)] if p.kept else [(e[0], flat(e[1])) if e else (None, None) for row in p.matrix for e in row]
                first_turn, first_role, first_mark = p.first_turn
                facts = [p.faults["blank"], p.faults["duplicate"], p.faults["truncated"], p.illegal, p.turns, p.low, p.high]
                values = [p.key, p.kept, first_turn, first_role, first_mark, *facts, p.first_initial, p.last_initial, [c for c, _ in entries], [a for _, a in entries]]
                for name, value in zip(names, values):
                    columns[name].append(value)
            types = [id_type, pa.bool_(), pa.int64(), pa.string(), pa.string(), *[pa.int64()] * len(FACTS), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string())]
            return pa.record_batch([pa.array(columns[n], t) for n, t in zip(names, types)], names)

        names = ["id"] + [f.split()[0] for f in PART.split(", ")]
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, turn, role, mark, initial, fault, n in zip(*(c.to_pylist() for c in batch.columns)):
                if part is None or key != part.key:
                    if part is not None:
                        part.kept = not first
                        ready.append(part)
                        first = False
                    part = Part(key, (turn, role, mark), initial)
                while n > 0:  # a row said very often comes in pieces
                    piece = min(n, FLUSH)
                    part.add(turn, initial, fault, piece)
                    fault = "blank" if fault == "blank" else "duplicate"
                    n -= piece
                    held += piece
                    if held >= FLUSH:
                        solve([*ready, part])
                        if ready:
                            yield rows_of(ready, id_type)
                        ready, held = [], 0
        if part is not None:
            part.kept = False  # the first and the last conversation of a task may go on elsewhere
            ready.append(part)
            solve(ready)
            yield rows_of(ready, id_type)

    parts = cut_lineage(rows.mapInArrow(fold, f"id {kind}, {PART}"))

    def chain(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(known=group.first_turn.notna()).sort_values(["known", "first_turn", "first_role", "first_mark"])
        facts, matrix = None, UNIT
        for row in group.to_dict("records"):
            row |= {k: None if pd.isna(row[k]) else int(row[k]) for k in FACTS}
            flat_entries = [None if pd.isna(c) else (int(c), a) for c, a in zip(row["costs"], row["audits"])]
            matrix = product(matrix, [flat_entries[4 * i : 4 * i + 4] for i in STATES])
            facts = row if facts is None else _then(facts, row)
        cost, audit = finished(matrix)
        return pd.DataFrame({"id": [group.id.iloc[0]], **{k: [facts[k]] for k in FACTS}, "cost": [cost], "audit": [audit]})

    ends = parts.filter("not whole").groupBy("id").applyInPandas(chain, f"id {kind}, " + ", ".join(f"{f} bigint" for f in FACTS) + ", cost bigint, audit string")
    whole = parts.filter("whole").select("id", *FACTS, F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"))
    gaps = F.coalesce(F.expr("high - low + 1 - turns"), F.lit(0)).alias("gaps")
    return whole.unionByName(ends).select("id", gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit")


OUT = "place bigint, role string, text string, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string"


def edited(plain: DataFrame, found: DataFrame, ids: DataFrame) -> DataFrame:
    """The repaired rows of each conversation in order, after a row of place 0 with its counts and audit.

    The three sides meet by a sort, and a task reads them as a stream, holding one audit at a time.
    """
    kind = plain.schema["id"].dataType.simpleString()
    known = [F.col(c) for c in (*COUNTS, "audit")]
    no = lambda **kinds: [F.lit(None).cast(t).alias(c) for c, t in kinds.items()]
    row_part, audit_part = {"turn": "bigint", "role": "string", "mark": "string", "text": "string"}, {**dict.fromkeys(COUNTS, "bigint"), "audit": "string"}
    every = (
        ids.select("id", F.lit(0).alias("kind"), *no(**row_part), *no(**audit_part))
        .unionByName(found.select("id", F.lit(1).alias("kind"), *no(**row_part), *known))
        .unionByName(plain.select("id", F.lit(2).alias("kind"), "turn", "role", "mark", "text", *no(**audit_part)))
    )
    first, *rest = order_columns()
    dealt = every.repartition("id").sortWithinPartitions(first, "kind", *rest)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, started, audit, at, state, place = None, False, "", 0, START, 0

        def inserts() -> None:
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                role, state = NEXT[state]
                place += 1
                out.append((key, place, role, "", *[None] * 7))
                at += 1

        def batch_of(rows: list[tuple], id_type) -> pa.RecordBatch:
            names = ["id", *(f.split()[0] for f in OUT.split(", "))]
            types = [id_type, pa.int64(), pa.string(), pa.string(), *[pa.int64()] * len(COUNTS), pa.string()]
            columns = list(zip(*rows)) or [()] * len(names)
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

        waiting = None  # the row of place 0 that is still to be filled by an audit
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for new, what, _turn, role, _mark, text, *counts, letters in zip(*(c.to_pylist() for c in batch.columns)):
                if what == 0:
                    if started:
                        if waiting is not None:
                            out.append(waiting)
                        inserts()
                    key, started, audit, at, state, place = new, True, "", 0, START, 0
                    waiting = (new, 0, None, None, *[0] * len(COUNTS), "")
                elif what == 1:
                    audit = letters
                    out.append((key, 0, None, None, *counts, letters))
                    waiting = None
                else:
                    inserts()
                    letter = audit[at]
                    at += 1
                    if letter == "D":
                        continue
                    if letter == "R":
                        role, state = NEXT[state]
                    else:
                        state = {"s": SYSTEM, "u": USER, "a": DONE}[role[0]]
                    place += 1
                    out.append((key, place, role, text, *[None] * 7))
            yield batch_of(out, id_type)
            out = []
        if started:
            if waiting is not None:
                out.append(waiting)
            inserts()
            yield batch_of(out, id_type)

    return dealt.mapInArrow(edit, f"id {kind}, {OUT}")


def repair(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", ids: DataFrame | None = None
) -> DataFrame:
    """Per conversation a row of place 0 with counts, cost and audit, then its repaired rows from place 1 on, in order.

    Rows go by turn, nulls first; rows of one turn by role, then MD5 of the text, so equal rows are neighbours, and the order
    of the input doesn't matter. Null roles and texts count as one space; a null id is a conversation of its own. A role without
    a character can't be kept. ``ids`` names conversations that are returned even without any row: zeros and an empty audit.
    Only the four columns are read, so other columns may have any name. No task holds all rows of a conversation; its audit,
    one string, does pass one task.
    """
    plain = plain_rows(rows, id_col, turn_col, role_col, text_col)
    every = (rows if ids is None else ids).select(F.col(id_col).alias("id")).distinct()
    return edited(plain, audits(plain), every)


def digests(repaired: DataFrame) -> DataFrame:
    """``id``, counts, ``audit`` and the SHA-256 of ``role:text`` of the repaired rows, joined by line feeds.

    Reads the result of ``repair`` as it comes, in one pass and without a shuffle; texts go through the digest one by one.
    """
    names = ["id", *COUNTS, "audit", "repaired_sha256"]
    kinds = [repaired.schema["id"].dataType.simpleString(), *["bigint"] * len(COUNTS), "string", "string"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, state, out = None, None, []
        for batch in batches:
            for key, place, role, text, *counts in zip(*(c.to_pylist() for c in batch.columns)):
                if place == 0:
                    if head is not None:
                        out.append((*head, state.hexdigest()))
                    head, state = (key, *counts), hashlib.sha256()
                else:
                    state.update((("\n" if place > 1 else "") + f"{role}:{text}").encode())
            types = [batch.schema.field(0).type, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * len(names), types)], names)
            out = []
        if head is not None:
            yield pa.record_batch([pa.array([v], t) for v, t in zip((*head, state.hexdigest()), types)], names)

    return repaired.mapInArrow(digest, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
