"""Repair of damaged conversations by the lightest derivation.

A repair is a derivation whose items say how far a conversation has been read and
which role was written last. Deductions keep, rerole or delete the next row, or insert
one. An item's value is (cost, audit), the audit being the initials of the edits so
far; deductions add to both at the end. Derivations of one item and of equal cost are
no prefixes of each other, so this is monotone, and no value falls below that of the
item it came from: items leave the agenda in ascending order, each with its lightest
value, and the search ends when the goal leaves it (Knuth's generalisation of the
shortest path).

Rows are put in order by a range sort, which deals a long conversation over tasks.
Each task derives its segments, for every role that may stand before one. Deductions
with two antecedents, the part read so far and a segment, join the segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.llm.common import require, slices, stored
from lakeloom.session import conf_scope

#: Rows of a conversation derived at once; codes of up to so many items are remembered.
RUN_ROWS = 512
REMEMBERED = 32
SPACE = " \t\n\x0b\x0c\r"
#: What was written last: nothing, a system row, a user row, an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, MEND = 0, 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}

Value = tuple[int, str]


class Repair(NamedTuple):
    """``summary`` has a row a conversation, ``rows`` the repaired rows with edits."""

    summary: DataFrame
    rows: DataFrame


def _next(state: int) -> int:
    return ASSISTANT if state == USER else USER


def _deductions(code: str, run: int, state: int) -> Iterator[tuple[int, str, int]]:
    """Cost, initials and state after the next item: a row by the initial of its role
    (upper case: truncated), or "-", a run of rows that have to go."""
    if code == "-":
        yield DELETE * run, "D" * run, state
        return
    yield DELETE, "D", state
    extra = MEND if code.isupper() else 0
    role = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(code.lower())
    if role == _next(state) or (role, state) == (SYSTEM, START):
        yield KEEP + extra, "K", role
    yield REROLE + extra, "R", _next(state)


@lru_cache(maxsize=20_000)
def lightest(codes: str, runs: tuple[int, ...], entry: int = START, goals: frozenset[int] = frozenset()) -> dict[int, Value]:
    """Lightest (cost, audit) of reading all rows by the state reached, from ``entry``.
    With ``goals`` the search ends with the first of these states. No row is inserted
    within a run of deletions: after it the cost is equal and the audit smaller."""
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, entry)]
    final: set[tuple[int, int]] = set()
    found: dict[int, Value] = {}
    while agenda:
        cost, audit, at, state = heappop(agenda)
        if (at, state) in final:
            continue
        final.add((at, state))
        if at == len(codes):
            found[state] = cost, audit
            if state in goals:
                return {state: (cost, audit)}
        else:
            for more, letters, then in _deductions(codes[at], runs[at], state):
                if (at + 1, then) not in final:
                    heappush(agenda, (cost + more, audit + letters, at + 1, then))
        if (at, _next(state)) not in final:
            heappush(agenda, (cost + INSERT, audit + "I", at, _next(state)))
    return found


def joined(values: dict[int, Value], ways: list[tuple[int, int, int, str]]) -> tuple[dict[int, Value], dict[int, tuple[int, str]]]:
    """Values after one more segment, and by state the way taken: where it entered, and
    its audit. ``ways`` are (entry, exit, cost, audit)."""
    after: dict[int, Value] = {}
    taken: dict[int, tuple[int, str]] = {}
    for entry, leave, cost, audit in ways:
        if entry in values:
            value = values[entry][0] + cost, values[entry][1] + audit
            if leave not in after or value < after[leave]:
                after[leave], taken[leave] = value, (entry, audit)
    return after, taken


def _key(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _folded(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies, faults and two keys: that of the row
    and that of its conversation, role and text."""
    role, text = (F.coalesce(F.col(name), F.lit(" ")).alias(name) for name in ("role", "text"))
    distinct = rows.select("conv_id", "turn", role, text).groupBy("conv_id", "turn", "role", "text").agg(
        F.count("*").alias("copies"))
    conv = F.coalesce(F.concat(F.length(F.col("conv_id").cast("string")), F.lit(":"), F.col("conv_id").cast("string")), F.lit("-"))
    said = (F.length("role"), F.lit(":"), F.col("role"), F.col("text"))
    core = F.rtrim(F.col("text"), F.lit(SPACE))
    return distinct.withColumns({
        "row": _key(conv, F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit("-")), F.lit(":"), *said),
        "same": _key(conv, F.lit(":"), *said),
        "blank": core == "", "cut": ~F.substring(core, -1, 1).isin(".", "!", "?")})


def _faults(folded: DataFrame) -> DataFrame:
    """Rows without their text: kinds of fault and the code that ``lightest`` reads."""
    light = folded.drop("text")
    repeated = stored(light.groupBy("same").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).where("n > 1")
                      .select("same", F.col("first.turn").alias("first_turn"), F.lit(True).alias("again")), "repair-repeated")
    later = F.coalesce(F.col("again"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    initial = F.substring("role", 1, 1)
    code = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    return light.join(repeated, "same", "left").select(
        "conv_id", "turn", "role", "row", "copies", "blank", (~F.col("blank") & later).alias("later"),
        (~F.col("blank") & ~later & F.col("cut")).alias("cut"), initial.alias("initial"),
        F.when(F.col("blank") | later, "-").when(F.col("cut"), F.upper(code)).otherwise(code).alias("code"))


def _segments(run_rows: int):
    """Segments of the sorted rows of a task, with their derivations.

    A conversation at an end of the task may go on in another one; all others begin
    and end here, and those of one segment need no more than their goal."""
    def segment(rows: list[tuple], opens: bool, closes: bool) -> dict:
        codes, runs = "", []
        for _, _, _, _, copies, _, code in rows:
            codes += code
            runs.append(copies if code == "-" else 1)
            if code != "-" and copies > 1:
                codes, runs = codes + "-", [*runs, copies - 1]
        goals = frozenset((START, ASSISTANT)) if opens and closes else frozenset()
        derive = lightest if len(codes) <= REMEMBERED else lightest.__wrapped__
        initials = [row[5] for row in rows]
        return {
            "conv_id": rows[0][0], "turn": rows[0][1], "role": rows[0][2], "segment": rows[0][3],
            "rows": [row[3] for row in rows], "copies": [row[4] for row in rows], "initials": initials,
            "ways": [{"entry": entry, "leave": leave, "cost": cost, "audit": audit}
                     for entry in ((START,) if opens else (START, SYSTEM, USER, ASSISTANT))
                     for leave, (cost, audit) in derive(codes, tuple(runs), entry, goals).items()],
            "illegal": sum(row[4] - 1 for row in rows) + sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            "first": initials[0], "last": initials[-1]}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[tuple] = []
        earlier, whole = 0, False  # segments of this conversation so far; does it begin in this task
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if held and held[0][0] != row[0]:
                    yield segment(held, whole and not earlier, not earlier)
                    held, earlier, whole = [], 0, True
                elif len(held) >= run_rows:
                    yield segment(held, whole and not earlier, False)
                    held, earlier = [], earlier + 1
                held.append(row)
        if held:
            yield segment(held, whole and not earlier, False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        kind = first.schema.field(0).type, first.schema.field(1).type
        schema = pa.schema([
            ("conv_id", kind[0]), ("turn", kind[1]), ("role", pa.string()), ("segment", pa.binary()), ("rows", pa.list_(pa.binary())),
            ("copies", pa.list_(pa.int64())), ("initials", pa.list_(pa.string())), ("ways", pa.list_(pa.struct([
                ("entry", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
            ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string())])
        made: list[dict] = []
        for one in cut(_chained(first, batches)):
            made.append(one)
            if len(made) >= 256:
                yield pa.RecordBatch.from_pylist(made, schema)
                made = []
        if made:
            yield pa.RecordBatch.from_pylist(made, schema)
    return run


def _chained(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join the segments of each conversation, in order. One row a segment says what
    was done in it, one more (without segment) sums the conversation up."""
    held: list[tuple[bytes, dict[int, tuple[int, str]]]] = []
    values: dict[int, Value] = {}
    conv, illegal, last, schema = None, 0, "", None

    def closed() -> list[dict]:
        (cost, audit), state = min((values[goal], goal) for goal in (START, ASSISTANT) if goal in values)
        out = [{"conv_id": conv, "segment": None, "entry": 0, "audit": audit, "base": 0, "cost": cost, "illegal": illegal}]
        for segment, taken in reversed(held):
            state, letters = taken[state]
            out.append({"conv_id": conv, "segment": segment, "entry": state, "audit": letters, "base": 0, "cost": 0, "illegal": 0})
        base = 0
        for row in reversed(out[1:]):
            row["base"] = base
            base += len(row["audit"]) - row["audit"].count("D")
        return out

    for batch in batches:
        schema = schema or pa.schema([
            ("conv_id", batch.schema.field(0).type), ("segment", pa.binary()), ("entry", pa.int32()), ("audit", pa.string()),
            ("base", pa.int64()), ("cost", pa.int64()), ("illegal", pa.int64())])
        done: list[dict] = []
        for row in batch.to_pylist():
            if held and row["conv_id"] != conv:
                done += closed()
                held = []
            if not held:
                conv, illegal, values = row["conv_id"], 0, {START: (0, "")}
            else:
                illegal += last + row["first"] not in LEGAL
            illegal, last = illegal + row["illegal"], row["last"]
            values, taken = joined(values, [(way["entry"], way["leave"], way["cost"], way["audit"]) for way in row["ways"]])
            held.append((row["segment"], taken))
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if held:
        yield pa.RecordBatch.from_pylist(closed(), schema)


def written(copies: list[int], initials: list[str], entry: int, audit: str) -> Iterator[tuple[int | None, str, str | None]]:
    """What an audit writes: the row it comes from (None: inserted), the edit and the
    new role (None: its own)."""
    names = {USER: "user", ASSISTANT: "assistant"}
    state, at, used = entry, 0, 0
    for letter in audit:
        if letter == "I":
            state = _next(state)
            yield None, letter, names[state]
            continue
        if used == copies[at]:
            at, used = at + 1, 0
        used += 1
        if letter == "R":
            state = _next(state)
            yield at, letter, names[state]
        elif letter == "K":
            state = SYSTEM if initials[at] == "s" else _next(state)
            yield at, letter, None


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        schema = pa.schema([("conv_id", batch.schema.field(0).type), ("place", pa.int64()), ("row", pa.binary()),
                            ("edit", pa.string()), ("new_role", pa.string())])
        out = [
            {"conv_id": row["conv_id"], "place": row["base"] + step, "row": None if at is None else row["rows"][at],
             "edit": edit, "new_role": role}
            for row in batch.to_pylist()
            for step, (at, edit, role) in enumerate(written(row["copies"], row["initials"], row["entry"], row["audit"]))]
        yield pa.RecordBatch.from_pylist(out, schema)


def repair(rows: DataFrame, run_rows: int = RUN_ROWS) -> Repair:
    """The cheapest repair of every conversation (columns conv_id, turn, role, text).

    A conversation's rows stand by turn, nulls first; rows of one turn by role, then
    by a hash of the row, equal ones side by side. A row's first fault counts: blank (no
    character but ASCII white space), duplicate (role and text seen earlier), truncated
    (its last such character is none of ".!?"). Blank and duplicate rows have to be
    deleted (4). Others are kept if their role fits, rerole costs 3, delete 4, a
    truncated row that stays 3 more; a row with empty text may be inserted anywhere (3).
    The initials of the roles become "" or "s?(ua)+". Of the cheapest repairs the one
    with the smallest audit is taken.

    ``summary``: conv_id, gaps (turns missing between the first and the last), blank,
    duplicate, truncated, illegal (neighbours whose initials are none of su, ua, au),
    cost, audit. ``rows``: conv_id, place (from 0), turn (null if inserted), role, text,
    edit. A null conv_id is a conversation, a null role or text one space, an empty
    table gives no rows. Other columns are ignored.
    """
    require(rows, "conv_id", "turn", "role", "text")
    with conf_scope(rows.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "4096"}):
        return _repair(rows, run_rows)


def _repair(rows: DataFrame, run_rows: int) -> Repair:
    kinds = {name: rows.schema[name].dataType.simpleString() for name in ("conv_id", "turn")}
    folded = stored(_folded(rows), "repair-folded")
    faults = stored(_faults(folded), "repair-faults")
    order = ["conv_id", "turn", "role", "row"]
    segments = stored(
        faults.select(*order, "copies", "initial", "code").repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            _segments(run_rows),
            f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, segment binary, rows array<binary>, "
            "copies array<long>, initials array<string>, ways array<struct<entry int, leave int, cost long, audit string>>, "
            "illegal long, first string, last string"), "repair-segments")
    order = ["conv_id", "turn", "role", "segment"]
    chain = stored(
        segments.select(*order, "ways", "illegal", "first", "last").repartition("conv_id").sortWithinPartitions(*order).mapInArrow(
            _chain, f"conv_id {kinds['conv_id']}, segment binary, entry int, audit string, base long, cost long, illegal long"),
        "repair-chain")
    edits = segments.select("segment", "conv_id", "rows", "copies", "initials").join(
        chain.where("segment is not null").select("segment", "entry", "audit", "base"), "segment").select(
        "conv_id", "rows", "copies", "initials", "entry", "audit", "base")
    edits = stored(edits.mapInArrow(
        _expand, f"conv_id {kinds['conv_id']}, place long, row binary, edit string, new_role string"), "repair-edits")
    kept = edits.where("row is not null").join(folded.select("row", "turn", "role", "text"), "row").select(
        "conv_id", "place", "turn", F.coalesce("new_role", "role").alias("role"), "text", "edit")
    added = edits.where("row is null").select(
        "conv_id", "place", F.lit(None).cast(kinds["turn"]).alias("turn"), F.col("new_role").alias("role"), F.lit("").alias("text"), "edit")

    counts = faults.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("later"), F.col("copies")).otherwise(F.col("copies") - 1)).alias("duplicate"),
        F.sum(F.col("cut").cast("long")).alias("truncated")).groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")])
    totals = chain.where("segment is null").select(F.col("conv_id").alias("of"), "illegal", "cost", "audit")
    summary = counts.join(totals, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    return Repair(summary, kept.unionByName(added))


def fingerprints(rows: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines in order of place. A hash
    goes through its bytes one after the other, so a conversation's rows pass through
    one task; it holds a batch of them at a time."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, schema = None, None, None
        for batch in batches:
            schema = pa.schema([("conv_id", batch.schema.field(0).type), ("repaired_sha256", pa.string())])
            done = []
            for part in slices(batch, "text"):
                for one, role, text in zip(*(column.to_pylist() for column in part.columns)):
                    if digest is None or one != conv:
                        if digest is not None:
                            done.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
                        conv, digest = one, hashlib.sha256()
                    else:
                        digest.update(b"\n")
                    digest.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": digest.hexdigest()}], schema)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "role", "text").mapInArrow(
        run, f"conv_id {kind}, repaired_sha256 string")
