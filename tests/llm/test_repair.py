"""Repairs against a plain table of all states, and against all edit sequences."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from lakeloom.llm import repair
from lakeloom.llm.queries_repair import damage, op12_conversation_repair
from tests.llm.conftest import SF

BLANK = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id long, turn long, role string, text string, row string, place int, code string, copies int"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        dice = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if dice == 0:
            continue
        text = "" if dice == 1 else re.sub("[.!?]", "", text) if dice == 2 else text
        out += [(conv, turn, "user" if dice == 4 else role, text)] * (2 if dice == 3 else 1)
    return out


def faults_of(rows):
    seen, faults = set(), []
    for role, text in rows:
        core = BLANK.findall(text)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    return faults


def brute(rows):
    """Cost, audit and repaired rows of one conversation (role, text): the best of each
    state after each row, inserting up to three rows before every row."""
    table = {"": (0, "", ())}  # by the last roles written: "", "s", "u", "a"

    def insert(table):
        for _ in range(3):
            for state, (cost, audit, out) in list(table.items()):
                role = "assistant" if state == "u" else "user"
                new = (cost + 3, audit + "I", out + ((role, ""),))
                if role[0] not in table or new < table[role[0]]:
                    table[role[0]] = new

    for (role, text), fault in zip(rows, faults_of(rows)):
        insert(table)
        after = {}
        for state, (cost, audit, out) in table.items():
            ways = [(state, 4, "D", ())]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                fits = "u" if state != "u" else "a"
                if role[:1] == fits or (role[:1], state) == ("s", ""):
                    ways.append((role[0], extra, "K", ((role, text),)))
                ways.append((fits, 3 + extra, "R", (("user" if fits == "u" else "assistant", text),)))
            for then, more, letter, row in ways:
                new = (cost + more, audit + letter, out + row)
                if then not in after or new < after[then]:
                    after[then] = new
        table = after
    insert(table)
    return min(table[state] for state in ("", "a") if state in table)


def row_hash(conv, turn, role, text):
    start = "-" if conv is None else f"{len(str(conv))}:{conv}"
    return hashlib.sha256(f"{start}:{'-' if turn is None else turn}:{len(role)}:{role}{text}".encode()).digest()


def expected(rows):
    rows = [(conv, turn, " " if role is None else role, " " if text is None else text) for conv, turn, role, text in rows]
    out = {}
    for conv in {row[0] for row in rows}:
        own = sorted(((turn is not None, turn or 0, role, text) for c, turn, role, text in rows if c == conv),
                     key=lambda r: (*r[:3], row_hash(conv, r[1] if r[0] else None, *r[2:])))
        said = [(role, text) for _, _, role, text in own]
        faults = faults_of(said)
        turns = {turn for known, turn, _, _ in own if known}
        cost, audit, repaired = brute(said)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                     faults.count("truncated"), illegal, cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())
    return out


def run(frame, **given):
    mended = repair.repair(frame, **given)
    hashes = {row.conv_id: row.repaired_sha256 for row in repair.fingerprints(mended.rows).collect()}
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return {row.conv_id: (*[row[name] for name in names], hashes.get(row.conv_id, hashlib.sha256(b"").hexdigest()))
            for row in mended.summary.collect()}


def frame_of(spark, rows):
    return spark.createDataFrame([(*row, "r", 1, "c", 2) for row in rows], SCHEMA)


def drawn(seed, conversations, longest):
    random = np.random.default_rng(seed)
    roles, texts = ["user", "assistant", "system", "tool", "User", ""], ["Yes.", "No", "", "Why?", " \t", "Go!\n", "a.b", "Ok. "]
    return [(conv, turn, roles[min(random.integers(0, 9), 5) if random.random() < 0.5 else turn % 2], texts[random.integers(0, 8)])
            for conv in range(conversations) for turn in sorted(random.choice(3 * longest, random.integers(1, longest + 1), replace=False).tolist())]


def test_query_matches_a_plain_table(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = expected(damaged(rows))
    got = {row[0]: tuple(row)[1:] for row in op12_conversation_repair(spark, SF).collect()}
    assert set(got) == {row[0] for row in rows}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {conv: want.get(conv, nothing) for conv in got}


def test_drawn_conversations(spark):
    rows = drawn(3, 300, 9)
    assert run(frame_of(spark, rows)) == expected(rows)


@pytest.mark.parametrize("run_rows", [1, 3, 512])
def test_long_conversations_in_segments(spark, run_rows):
    rows = drawn(5, 4, 160)
    assert run(frame_of(spark, rows), run_rows=run_rows) == expected(rows)


def test_audits_are_the_least_of_all_edit_sequences():
    """Every sequence of edits with up to two rows inserted in a gap."""
    gaps = ["", "I", "II"]
    for codes in map("".join, itertools.chain.from_iterable(itertools.product("suaxU-", repeat=n) for n in range(4))):
        best = None
        for letters in itertools.product("KRD", repeat=len(codes)):
            for inserts in itertools.product(gaps, repeat=len(codes) + 1):
                audit = inserts[0] + "".join(a + b for a, b in zip(letters, inserts[1:]))
                cost, out, good, rows = 0, "", True, iter(codes)
                for letter in audit:
                    if letter == "I":
                        cost, out = cost + 3, out + ("a" if out.endswith("u") else "u")
                        continue
                    code = next(rows)
                    if letter == "D":
                        cost += 4
                        continue
                    good &= code != "-"
                    cost += 3 * code.isupper() + 3 * (letter == "R")
                    out += code.lower() if letter == "K" else "a" if out.endswith("u") else "u"
                if good and re.fullmatch("(s?(ua)+)?", out) and (best is None or (cost, audit) < best):
                    best = cost, audit
        found = repair.lightest(codes, (1,) * len(codes), repair.START, frozenset((repair.START, repair.ASSISTANT)))
        assert list(found.values()) == [best], codes


def test_values_join_over_segments():
    """Whole derivations equal those joined from parts, from every cut."""
    codes = "sUaxu-aAuUxa"
    whole = repair.lightest(codes, (1,) * len(codes))
    for cut in range(1, len(codes)):
        values = {repair.START: (0, "")}
        for part in (codes[:cut], codes[cut:]):
            ways = [(entry, leave, *value) for entry in range(4) for leave, value in repair.lightest(part, (1,) * len(part), entry).items()]
            values, _ = repair.joined(values, ways)
        assert values == whole


def test_odd_rows(spark):
    rows = [(1, 0, "system", "Hi."), (1, 1, "user", None), (1, 1, "user", "A."), (1, 1, "user", "A."), (1, None, None, "B."),
            (1, None, "user", "C."), (1, 9, "user", "A."), (None, 3, "assistant", "D."), (None, None, "user", "E."), (2, None, None, None),
            (3, 1, "user", "x" * 300_000), (3, 2, "assistant", "é☃𝒳."), (4, -5, "user", "Q.\u0085"), (5, 1, "üser", "Z.")]
    assert run(frame_of(spark, rows)) == expected(rows)
    assert run(frame_of(spark, [])) == {}


def test_many_copies_of_a_row(spark):
    rows = [(1, 0, "user", "A.")] * 3000 + [(1, 1, "assistant", "B.")] + [(1, 2, "user", " ")] * 50
    got = run(frame_of(spark, rows))[1]
    assert got[2] == 2999 and got[1] == 50 and got[5] == 4 * 3049 and got[6] == "K" + "D" * 2999 + "K" + "D" * 50


def test_repaired_rows(spark):
    mended = repair.repair(frame_of(spark, [(1, 0, "system", "S."), (1, 1, "user", "Q?"), (1, 2, "user", "R?"), (1, 3, "assistant", "A.")]))
    rows = sorted(mended.rows.collect(), key=lambda row: row.place)
    assert [(row.turn, row.role, row.text, row.edit) for row in rows] == [
        (0, "system", "S.", "K"), (1, "user", "Q?", "K"), (None, "assistant", "", "I"), (2, "user", "R?", "K"), (3, "assistant", "A.", "K")]


def test_damage(spark):
    rows = [(conv, turn, "assistant", "A. B! C?") for conv in (*range(40), None) for turn in (None, 0, 1)]
    got = sorted((tuple(row) for row in damage(frame_of(spark, rows)).collect()), key=repr)
    assert got == sorted(damaged(rows), key=repr)
