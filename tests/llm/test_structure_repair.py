"""Repairs against a search over all edits, turn by turn."""

import random
import re
import zlib
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import structure_repair

TURNS = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def best(turns: list[tuple[str, str, str]], delete: int = 2) -> tuple[int, str, tuple]:
    """Least (cost, audit, repaired turns) by trying every edit, with at most four insertions in a row."""

    @lru_cache(maxsize=None)
    def from_(i: int, last: str, inserted: int):
        found = []
        if i == len(turns):
            if last in ("", "a"):
                found.append((0, "", ()))
        else:
            role, text, fault = turns[i]

            def go(letter, cost, to, left):
                rest = from_(i + 1, to, 0)
                if rest:
                    found.append((cost + rest[0], letter + rest[1], left + rest[2]))

            go("D", delete, last, ())
            if fault in ("truncated", "none"):
                extra = 5 * (fault == "truncated")
                if role[:1] and role[0] in NEXT[last]:
                    go("K", extra, role[0], ((role, text),))
                for name in ("user", "assistant"):
                    if name[0] in NEXT[last]:
                        go("R", 1 + extra, name[0], ((name, text),))
        if inserted < 4:
            for name in ("user", "assistant"):
                if name[0] in NEXT[last]:
                    rest = from_(i, name[0], inserted + 1)
                    if rest:
                        found.append((5 + rest[0], "I" + rest[1], ((name, ""),) + rest[2]))
        return min(found, default=None)

    return from_(0, "", 0)


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def reported(rows, turns) -> set[tuple]:
    out = set()
    for conv in {r[0] for r in rows}:
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2], t[3]))
        seen, judged, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, "none": 0}
        for _, _, role, text in own:
            last = WORD.findall(text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "none"
            seen.add((role, text))
            judged.append((role, text, fault))
            count[fault] += 1
        numbers = {t[1] for t in own if t[1] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, left = best(judged)
        digest = sha256("\n".join(f"{role}:{text}" for role, text in left).encode()).hexdigest()
        out.add((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest))
    return out


def made(seed, convs, longest):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "Sudo"]
    texts = ["Fine.", "Well?\n ", "cut off", "", None, " \t\n", "No!", "more", "é.", "." * 70 + "x"]
    rows = []
    for conv in range(convs):
        for turn in range(draw.randrange(1, longest)):
            orderly = draw.random() < 0.6
            role = ["user", "assistant"][turn % 2] if orderly else draw.choice(roles)
            text = f"{conv} {turn}." if draw.random() < 0.5 else draw.choice(texts)
            rows.append((conv, draw.choice([turn, turn, turn, turn + 3, None]), role, text))
    return rows


def reports(spark, rows):
    frame = spark.createDataFrame(rows, TURNS).withColumns({n: F.lit("mine") for n in ("place", "fault", "n", "content", "symbol", "stretch", "again")})
    return {tuple(r) for r in structure_repair.report(frame, structure_repair.damaged(frame)).collect()}


@pytest.mark.parametrize("stretch", [4096, 3])
def test_every_conversation(spark, monkeypatch, stretch):
    monkeypatch.setattr(structure_repair, "STRETCH", stretch)
    rows = made(3, 150, 12)
    rows += [(None, 0, "user", "Without a conversation."), (None, 1, "assistant", "Nor this.")]
    rows += [(900, k, "user", "Same.") for k in range(9)] + [(901, None, "system", "Only."), (902, None, None, None)]
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(dropped, 0, "user", "Gone.")]
    found = reports(spark, rows)
    assert found == reported(rows, hurt(rows))
    assert any("R" in row[7] for row in found)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest()) in found


def test_a_long_conversation_goes_over_stretches(spark):
    rows = [(1, k, ["user", "assistant"][k % 2], f"Turn {k}.") for k in range(9000)] + [(2, k, "system", f"s {k}.") for k in range(3000)]
    repair = structure_repair.Repair(spark.createDataFrame(rows, TURNS))
    parts = repair.stretches.collect()
    assert max(len(p["audit"]) for p in parts) <= structure_repair.STRETCH + 2 and len(parts) > 3
    audit = {c: "".join(p["audit"] for p in sorted(parts, key=lambda p: p["stretch"]) if p["conv_id"] == c) for c in (1, 2)}
    assert audit[1] == "K" * 9000
    # One system turn may stay, of the other 2999 one goes; or all of them get a new role.
    assert sum(p["cost"] for p in parts if p["conv_id"] == 2) == 3000 and audit[2] == "DK" + "R" * 2998
    left = repair.repaired_turns().filter("conv_id = 1").groupBy("edit").count().collect()
    assert [tuple(r) for r in left] == [("K", 9000)]


@pytest.mark.parametrize("delete", [2, 30])
def test_insertions_where_they_pay(monkeypatch, delete):
    """With deletions this dear, turns are put in instead; at their own price that never pays."""
    monkeypatch.setattr(structure_repair, "DELETE", delete)
    structure_repair.power.cache_clear()
    draw, audits = random.Random(1), []
    for _ in range(300):
        symbols = "".join(draw.choice(structure_repair.SYMBOLS) * draw.choice([1, 1, 2, 5]) for _ in range(draw.randrange(1, 5)))
        turns = [(structure_repair._role(s), "", structure_repair.FAULTS[structure_repair.SYMBOLS.index(s) % 3]) for s in symbols]
        cost, audit, _ = best(turns, delete)
        after = structure_repair.final_costs()
        assert structure_repair.ahead(structure_repair.stretch_matrix(symbols), after)[structure_repair.NOTHING] == cost
        assert structure_repair.unrolled(symbols, after, structure_repair.NOTHING, True)[0] == audit
        audits.append(audit)
    structure_repair.power.cache_clear()
    assert any("I" in audit for audit in audits) == (delete > 2)


def test_powers_are_products():
    for symbol in structure_repair.SYMBOLS:
        whole = np.where(np.eye(4, dtype=bool), 0, structure_repair.NEVER)
        for length in range(1, 12):
            whole = structure_repair.product(whole, structure_repair.power(symbol, 0))
            assert (structure_repair.stretch_matrix(symbol * length) == whole).all()


def test_repaired_turns_follow_the_grammar(spark):
    rows = hurt(made(5, 80, 9))
    left = structure_repair.Repair(spark.createDataFrame(rows, TURNS)).repaired_turns().collect()
    for conv in {r["conv_id"] for r in left}:
        turns = sorted((r for r in left if r["conv_id"] == conv), key=lambda r: (r["stretch"], r["n"]))
        assert re.fullmatch("(s?(ua)+)?", "".join(t["role"][0].lower() if t["role"] != "Sudo" else "S" for t in turns))


def test_no_turns(spark):
    none = spark.createDataFrame([], TURNS)
    assert structure_repair.report(none, none).collect() == []
    assert structure_repair.Repair(none).repaired_turns().collect() == []
    one = spark.createDataFrame([(4, 1, "user", "x.")], TURNS)
    assert [tuple(r)[:8] for r in structure_repair.report(one, none).collect()] == [(4, 0, 0, 0, 0, 0, 0, "")]
