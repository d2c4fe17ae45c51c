"""Repair of conversation structure by a run-length dynamic program.

A row of a conversation is a symbol: the initial of its role and its first
fault. What has been said so far is one of four states (nothing, a system, user or
assistant turn last), so a symbol is a 4 x 4 matrix of least costs, with
the insertions that may come before the row, and rows in sequence are a min-plus
product. Equal consecutive symbols are collapsed to runs; a run of n is
advanced by the cached binary powers of its matrix that n is made of.

Rows are ordered over all partitions and cut into fragments of bounded size, so a
conversation of any length is spread over many tasks:

1. every fragment gives the product of its runs;
2. the products of a conversation, a few numbers each, give the cost to go after every fragment;
3. every fragment is unrolled against it: the first letter, in ASCII order, that keeps the cost least.
   Where a conversation has several fragments this is done from all four states, and
   the states in which they begin follow from one another afterwards;
4. the edits meet their rows again in one exchange by conversation, in which texts pass by one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentledger.sources.shared import durable

START, SYSTEM, USER, ASSISTANT = range(4)  # states, named by the turn that came last
STATES = range(4)
INITIALS, FAULTS = "sua", ("none", "blank", "duplicate", "truncated")
FIRST = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}  # what can be inserted, or a row's role changed to
ROLE = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1  # costs; keeping is free
NEVER = 1 << 60
CLOSE = (0, 2 * INSERT, INSERT, 0)  # cost of ending in each state
SPACE = " \t\n\x0b\x0c\r"
FRAGMENT_BITS = 16  # a fragment has at most 2**16 rows
Vector = tuple[int, int, int, int]


def _options(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Edit, cost and next state of all that can be done with a row, in ASCII order; insertions come before rows and are not among them."""
    role, fault = INITIALS[symbol // 4 : symbol // 4 + 1], FAULTS[symbol % 4]
    found = [("D", DELETE, state)]
    if fault in ("none", "truncated"):
        extra = TRUNCATED if fault == "truncated" else 0
        if (state, role) in FIRST:
            found.append(("K", extra, FIRST[state, role]))
        found.append(("R", REROLE + extra, FIRST[state, WANTED[state]]))
    return found


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), NEVER)


UNIT = np.where(np.eye(4, dtype=bool), 0, NEVER).astype(np.int64)


@lru_cache(maxsize=None)
def power(symbol: int, k: int) -> np.ndarray:
    """Least costs over 2**k rows of one symbol, from state to state; 16 symbols have at most 16 x 64 of them."""
    if k:
        return times(power(symbol, k - 1), power(symbol, k - 1))
    insert, row = UNIT.copy(), np.full((4, 4), NEVER, np.int64)
    for state in STATES:
        insert[state, FIRST[state, WANTED[state]]] = INSERT
        for _, cost, after in _options(symbol, state):
            row[state, after] = min(row[state, after], cost)
    return times(times(times(insert, insert), times(insert, insert)), row)


@lru_cache(maxsize=1 << 16)
def _advance(symbol: int, k: int, after: Vector) -> Vector:
    return tuple((power(symbol, k) + np.array(after)).min(axis=1).tolist())


def advance(symbol: int, count: int, after: Vector) -> Vector:
    """Cost to go before `count` rows of one symbol, given that after them."""
    least = min(after)
    now = tuple(x - least for x in after)  # few different vectors, so the cache finds them
    k = 0
    while count:
        if count & 1:
            now = _advance(symbol, k, now)
            low = min(now)
            least += low
            now = tuple(x - low for x in now)
        count >>= 1
        k += 1
    return tuple(x + least for x in now)


def runs(symbols: bytes) -> list[tuple[int, int]]:
    return [(symbol, sum(1 for _ in own)) for symbol, own in groupby(symbols)]


@lru_cache(maxsize=1 << 12)
def _product(collapsed: tuple) -> tuple[int, ...]:
    total = UNIT
    for symbol, count in collapsed:
        for k in range(count.bit_length()):
            if count >> k & 1:
                total = times(total, power(symbol, k))
    return tuple(total.ravel().tolist())


def product(symbols: bytes) -> tuple[int, ...]:
    """The 16 costs of a whole fragment."""
    collapsed = tuple(runs(symbols))
    return _product(collapsed) if len(collapsed) < 64 else _product.__wrapped__(collapsed)


def unroll(symbols: bytes, after: Vector, state: int, last: bool) -> tuple[str, int]:
    """The ASCII-least letters of the cheapest edits of a fragment, and the state it ends in.

    `after` is the cost to go behind the fragment; insertions that end the conversation belong to its `last` one.
    """
    collapsed, ends = runs(symbols), [tuple(after)]
    for symbol, count in reversed(collapsed):
        ends.append(advance(symbol, count, ends[-1]))
    ends.reverse()
    letters = []
    for (symbol, count), end in zip(collapsed, ends[1:]):
        to_go = [end]
        for _ in range(count):
            to_go.append(advance(symbol, 1, to_go[-1]))
        while len(to_go) > 1:
            now, then = to_go[-1], to_go[-2]
            edits = _options(symbol, state)
            inserted = FIRST[state, WANTED[state]]
            edits.insert(1, ("I", INSERT, inserted))  # between D and K
            for letter, cost, to in edits:
                if cost + (now if letter == "I" else then)[to] == now[state]:
                    break
            letters.append(letter)
            state = to
            if letter != "I":
                to_go.pop()
    while last and CLOSE[state]:
        letters.append("I")
        state = FIRST[state, WANTED[state]]
    return "".join(letters), state


def _legal(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """System then user, user then assistant, assistant then user; numbers are places in INITIALS."""
    return ((before == 0) & (after == 1)) | ((before == 1) & (after == 2)) | ((before == 2) & (after == 1))


NUMBERS = "blank long, duplicate long, truncated long, illegal long"
FRAGMENT = f"symbols binary, product array<long>, {NUMBERS}, first_role int, last_role int, first_turn long, last_turn long, turns long"


def _arrow(conv: pa.DataType, columns: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in list(kinds.items())}
    return pa.schema([("conv_id", conv), *((n, kinds[k]) for n, k in (c.split(" ") for c in columns.split(", ")))])


def _batch(schema: pa.Schema, conv: pa.Array, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([conv, *(c if isinstance(c, pa.Array) else pa.array(c, k.type) for c, k in zip(columns, list(schema)[1:]))], schema=schema)


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each fragment contributes: its symbols, their product, its counts and its ends."""
    for batch in batches:
        schema = _arrow(batch.schema.field("conv_id").type, f"block long, {FRAGMENT}")
        own = batch.column("rows")
        ends = own.offsets.to_numpy().astype(np.int64)
        ends = ends - ends[0]
        rows = own.flatten()
        symbol = rows.field("symbol").to_numpy(zero_copy_only=False).astype(np.int64)
        missing = rows.field("turn").is_null().to_numpy(zero_copy_only=False)
        turn = rows.field("turn").fill_null(0).to_numpy(zero_copy_only=False)
        role, fault, raw = symbol // 4, symbol % 4, symbol.astype(np.uint8).tobytes()
        n = len(symbol)
        starts = np.zeros(n + 1, bool)
        starts[ends[:-1]] = True
        starts = starts[:n]
        prior = np.arange(n) - 1
        bad = ~starts & ~_legal(role[prior], role) if n else starts
        new = ~missing & (starts | missing[prior] | (turn[prior] != turn)) if n else starts
        total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[ends])
        filled, unnamed = np.diff(ends) > 0, total(missing)
        timed = np.diff(ends) > unnamed
        at = lambda values, places, known: pa.array(np.where(known, values[np.where(known, places, 0)], 0) if n else np.zeros(len(known), np.int64), mask=~known)
        texts = [raw[a:b] for a, b in zip(ends, ends[1:])]
        yield _batch(schema, batch.column("conv_id"), [
            batch.column("block"), texts, [product(t) for t in texts],
            *(total(fault == k) for k in (1, 2, 3)), total(bad),
            at(role, ends[:-1], filled).cast(pa.int32()), at(role, ends[1:] - 1, filled).cast(pa.int32()),
            at(turn, ends[:-1] + unnamed, timed), at(turn, ends[1:] - 1, timed), total(new),
        ])


CHAIN = f"block long, first boolean, last boolean, several boolean, after array<long>, gaps long, {NUMBERS}, cost long"


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every fragment the cost to go behind it; with the last one, what there is to say of the whole conversation."""
    for batch in batches:
        schema = _arrow(batch.schema.field("conv_id").type, CHAIN)
        made, owner = [], []
        for i, parts in enumerate(batch.column("parts").to_pylist()):
            after, afters = CLOSE, []
            for part in reversed(parts):
                afters.append(after)
                after = tuple((np.array(part["product"]).reshape(4, 4) + np.array(after)).min(axis=1).tolist())
            sums = {k: sum(p[k] for p in parts) for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
            filled = [p for p in parts if p["first_role"] is not None]
            sums["illegal"] += sum(not _legal(a["last_role"], b["first_role"]) for a, b in zip(filled, filled[1:]))
            timed = [p for p in parts if p["first_turn"] is not None]
            sums["turns"] -= sum(a["last_turn"] == b["first_turn"] for a, b in zip(timed, timed[1:]))
            gaps = timed[-1]["last_turn"] - timed[0]["first_turn"] + 1 - sums["turns"] if timed else 0
            whole = (gaps, sums["blank"], sums["duplicate"], sums["truncated"], sums["illegal"], after[START])
            for k, (part, behind) in enumerate(zip(parts, reversed(afters))):
                last = k == len(parts) - 1
                made.append((part["block"], k == 0, last, len(parts) > 1, list(behind), *(whole if last else [None] * 6)))
                owner.append(i)
        yield _batch(schema, batch.column("conv_id").take(pa.array(owner, pa.int64())), list(zip(*made)) or [()] * (len(schema) - 1))


UNROLLED = "block long, audits array<string>, exits array<int>"


def _unrolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        schema = _arrow(batch.schema.field("conv_id").type, UNROLLED)
        found = []
        for symbols, after, last, several in zip(*(batch.column(c).to_pylist() for c in ("symbols", "after", "last", "several"))):
            found.append([unroll(symbols, tuple(after), s, last) for s in (STATES if several else [START])])
        yield _batch(schema, batch.column("conv_id"), [batch.column("block"), [[a for a, _ in x] for x in found], [[e for _, e in x] for x in found]])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each of a conversation's fragments begins."""
    for batch in batches:
        schema = _arrow(batch.schema.field("conv_id").type, "block long, entry int")
        blocks, states, owner = [], [], []
        for i, parts in enumerate(batch.column("parts").to_pylist()):
            state = START
            for part in parts:
                blocks.append(part["block"])
                states.append(state)
                owner.append(i)
                state = part["exits"][state]
        yield _batch(schema, batch.column("conv_id").take(pa.array(owner, pa.int64())), [blocks, states])


EDITS = "place long, edit string, role string, text string"


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and the letters of their fragment, which comes before them, in order: one row for each edit."""
    letters, state, place, conv = iter(""), START, 0, None
    made: list[tuple] = []

    def inserted(letter: str | None) -> str | None:
        """Go on to the next letter that is no insertion."""
        nonlocal state, place
        while letter == "I":
            role = WANTED[state]
            made.append((conv, place, "I", ROLE[role], ""))
            state, place = FIRST[state, role], place + 1
            letter = next(letters, None)
        return letter

    schema = None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        schema = _arrow(kind, EDITS)
        columns = (batch.column(c) for c in ("conv_id", "first", "audit", "entry", "role", "text"))
        for own, first, audit, entry, role, text in zip(*columns):
            if audit.is_valid:
                inserted(next(letters, None))  # of the fragment before
                conv, letters, state, place = own.as_py(), iter(audit.as_py()), entry.as_py(), 0 if first.as_py() else place
                continue
            letter, name = inserted(next(letters)), role.as_py()
            if letter == "R":
                name = ROLE[WANTED[state]]
            made.append((conv, place, letter, name, text.as_py()))
            place += 1
            if letter != "D":
                state = FIRST[state, name[0]]
        out, made[:] = list(zip(*made)), []
        if out:
            yield _batch(schema, pa.array(out[0], kind), out[1:])
    inserted(next(letters, None))
    if made:
        out = list(zip(*made))
        yield _batch(schema, pa.array(out[0], schema.field("conv_id").type), out[1:])


class Repair(NamedTuple):
    """`report`: a row for each conversation. `edits`: a row for each edit, those of a conversation together and in order."""

    report: DataFrame
    edits: DataFrame


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["conv_id"].eqNullSafe(b["conv_id"]) & (a["block"] == b["block"])


def repair(rows: DataFrame, fragment_bits: int = FRAGMENT_BITS) -> Repair:
    """Faults, gaps and the cheapest edits of the conversations in `rows`.

    `rows` has `conv_id`, `turn`, `role`, `text` and may have `present`: a row that is not names its
    conversation only, which so is reported without rows. Rows of a conversation go by turn, nulls first, then by a digest
    of role and text; rows that repeat stand next to each other. A null role or text is one space, and rows with a null
    conv_id are one conversation. Columns of other names are not read, an empty table gives no rows.

    `report`: `conv_id`, `gaps`, `blank`, `duplicate`, `truncated`, `illegal`, `cost`. `edits`: `conv_id`, `place`, `edit` (K, R, D
    or I), and `role`, `text` as they are after it; those with D go.
    """
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    trimmed = F.rtrim(text, F.lit(SPACE))
    initial = F.substring(role, 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    read = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        (F.col("present") if "present" in rows.columns else F.lit(True)).alias("present"),
        (trimmed == "").alias("blank"),
        F.when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), 0).otherwise(3).alias("cut"),
        (4 * number).alias("number"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("id"),
    )
    order = ["conv_id", "turn", "digest", "id"]
    placed = read.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()).drop("id")
    stored = durable(placed.withColumn("block", F.shiftright("at", fragment_bits)))

    said = stored.where("present AND NOT blank").groupBy("conv_id", "digest")
    again = durable(said.agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("from")).where("n > 1").select("conv_id", "digest", "from"))
    met = stored.join(again, stored["conv_id"].eqNullSafe(again["conv_id"]) & (stored["digest"] == again["digest"]), "left")
    fault = F.when(F.col("blank"), 1).when(F.col("at") > F.col("from"), 2).otherwise(F.col("cut"))
    symbol = F.when(F.col("present"), F.struct("at", (F.col("number") + fault).cast("int").alias("symbol"), "turn"))
    grouped = met.groupBy(stored["conv_id"], "block").agg(F.sort_array(F.collect_list(symbol)).alias("rows"))  # at most 2**fragment_bits rows each
    conv = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"
    fragments = durable(grouped.mapInArrow(_fragments, f"{conv}, block long, {FRAGMENT}"))

    part = F.struct("block", *(c.split(" ")[0] for c in FRAGMENT.split(", ")[1:]))
    whole = fragments.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))  # 25 numbers for each fragment
    chains = durable(whole.mapInArrow(_chains, f"{conv}, {CHAIN}"))
    asked = fragments.select("conv_id", "block", "symbols").join(chains.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "after", "last", "several"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
    unrolled = durable(asked.mapInArrow(_unrolled, f"{conv}, {UNROLLED}"))
    states = unrolled.where(F.size("exits") > 1).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "exits"))).alias("parts"))
    entries = durable(states.mapInArrow(_entries, f"{conv}, block long, entry int"))

    begun = unrolled.join(entries, _same(unrolled, entries), "left").select(
        unrolled["conv_id"], unrolled["block"], F.coalesce("entry", F.lit(START)).alias("entry"), "audits"
    )
    firsts = chains.select("conv_id", "block", "first")
    heads = begun.join(firsts, _same(begun, firsts)).select(
        begun["conv_id"], begun["block"], F.lit(-1).cast("long").alias("at"), "first", F.element_at("audits", F.col("entry") + 1).alias("audit"), "entry",
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
    )
    bodies = stored.where("present").select("conv_id", "block", "at", F.lit(None).alias("first"), F.lit(None).alias("audit"), F.lit(None).alias("entry"), "role", "text")
    together = heads.union(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "block", "at")
    edits = together.mapInArrow(_edits, f"{conv}, {EDITS}")
    report = chains.where("last").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return Repair(report, edits)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letters and SHA-256 of one conversation after another, line by line."""
    schema, conv, letters, digest, lines = None, None, [], hashlib.sha256(), 0

    def closed() -> pa.RecordBatch:
        return _batch(schema, pa.array([conv], schema.field("conv_id").type), [["".join(letters)], [digest.hexdigest()]])

    for batch in batches:
        schema = schema or _arrow(batch.schema.field("conv_id").type, "audit string, repaired_sha256 string")
        for own, place, edit, role, text in zip(*(batch.column(c) for c in ("conv_id", "place", "edit", "role", "text"))):
            if place.as_py() == 0:
                if letters:
                    yield closed()
                conv, letters, digest, lines = own.as_py(), [], hashlib.sha256(), 0
            letters.append(edit.as_py())
            if letters[-1] != "D":
                digest.update(f"{chr(10) if lines else ''}{role.as_py()}:{text.as_py()}".encode())
                lines += 1
    if letters:
        yield closed()


def digests(edits: DataFrame) -> DataFrame:
    """`conv_id`, `audit`, `repaired_sha256` of the `edits` of `repair`, as it returns them.

    SHA-256 goes from line to line, so a conversation's lines pass one task, one at a time and never together.
    """
    conv = f"conv_id {edits.schema['conv_id'].dataType.simpleString()}"
    return edits.mapInArrow(_digested, f"{conv}, audit string, repaired_sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `turn`, `role`, `text`, `present`: rows damaged by the remainder of a CRC of conversation and turn by 20.

    0 drops a row, 1 empties its text, 2 takes its sentence ends away, 3 repeats it, 4 makes its role user. Nulls are one space.
    """
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20
    marked = conversations.select("conv_id", "turn", named("role").alias("role"), named("text").alias("text"), hit.alias("hit"))
    copies = F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("hit") != 0).alias("present"), copies.alias("copy")).drop("copy")
