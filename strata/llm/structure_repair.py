"""Cheapest repair of conversations by a run-length dynamic program.

Every turn has a symbol: its role (system, user, assistant or another) and its
fault (to be deleted, truncated or none). A repaired conversation has at most
one system turn, first, and then pairs of user and assistant, or nothing at all.
What is left of it is one of four states, so a turn is a 4 x 4 matrix over
(min, +), a run of equal symbols a power of it, and a stretch of turns a product
of such powers. Powers come from cached squarings.

A conversation is cut into stretches of a bounded number of turns. Their
matrices give, from the end, what each state costs from each border on; with
that, every stretch unrolls its choices by itself for each state it may begin
in, and a walk over the stretches picks the ones that follow on each other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.ordering import placed, tie_order
from strata.llm.shared import SPACE_BYTES
from strata.session import settled

#: Turns of a stretch, at most.
STRETCH = 4096
#: Costs of the edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: More than any repair costs.
NEVER = 1 << 60
#: States: nothing yet, after system, after user, after assistant. A repair may end in the first or the last.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (0, NEVER, NEVER, 0)
#: State after the turn that may follow by insertion or by a new role, and that role.
FOLLOWS = (USER, USER, ASSISTANT, USER)
ROLE_NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Letters of the symbols: role (s, u, a, other) times fault (deleted, truncated, none).
SYMBOLS = "abcdefghijkl"
ROLES, FAULTS = "sua?", ("delete", "truncated", "none")


def kept_state(state: int, role: str) -> int | None:
    """State after a turn of this role that is kept; none where it may not stand."""
    if role == "s":
        return SYSTEM if state == NOTHING else None
    follows = FOLLOWS[state]
    return follows if role == {USER: "u", ASSISTANT: "a"}[follows] else None


def options(state: int, symbol: str) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of a turn, without insertions."""
    role, fault = ROLES[SYMBOLS.index(symbol) // 3], FAULTS[SYMBOLS.index(symbol) % 3]
    found = [("D", DELETE, state)]
    if fault != "delete":
        extra = TRUNCATED if fault == "truncated" else 0
        if (after := kept_state(state, role)) is not None:
            found.append(("K", extra, after))
        found.append(("R", REROLE + extra, FOLLOWS[state]))
    return found


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), NEVER)


def _inserted() -> np.ndarray:
    """Costs from state to state by insertions only."""
    one = np.full((4, 4), NEVER, np.int64)
    for state in range(4):
        one[state, state] = 0
        one[state, FOLLOWS[state]] = min(one[state, FOLLOWS[state]], INSERT)
    return product(product(one, one), product(one, one))


INSERTED = _inserted()


@lru_cache(maxsize=1024)
def power(symbol: str, exponent: int) -> np.ndarray:
    """Costs of 2 ** exponent turns of one symbol, each with insertions before it."""
    if exponent:
        half = power(symbol, exponent - 1)
        return product(half, half)
    turn = np.full((4, 4), NEVER, np.int64)
    for state in range(4):
        for _, cost, after in options(state, symbol):
            turn[state, after] = min(turn[state, after], cost)
    return product(INSERTED, turn)


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(symbol, len(list(same))) for symbol, same in groupby(symbols)]


def stretch_matrix(symbols: str) -> np.ndarray:
    """Costs of all turns of a stretch, from state to state."""
    whole = np.where(np.eye(4, dtype=bool), 0, NEVER)
    for symbol, length in runs(symbols):
        for exponent in range(length.bit_length()):
            if length >> exponent & 1:
                whole = product(whole, power(symbol, exponent))
    return whole


def ahead(matrix: np.ndarray, costs: np.ndarray) -> np.ndarray:
    """Costs before a stretch, from those after it."""
    return np.minimum((matrix + costs[None, :]).min(1), NEVER)


def final_costs() -> np.ndarray:
    """Costs after the last turn: of what has to be inserted until the repair may end."""
    return ahead(INSERTED, np.array(ACCEPTED, np.int64))


def unrolled(symbols: str, after: np.ndarray, begin: int, last: bool) -> tuple[str, int]:
    """The least audit among the cheapest repairs of a stretch, and the state it ends in.

    ``after`` has the costs of each state after the stretch. Edits of a turn come
    after insertions before it; those at the end belong to the last stretch. At
    each step the least letter is taken that still reaches the least cost; as no
    two ways on share a letter, and none ends where another goes on, their
    audit is the least of all.
    """
    # Costs after each turn, from the back.
    behind, costs = [], np.asarray(after, np.int64)
    for symbol, length in reversed(runs(symbols)):
        one = power(symbol, 0)
        for _ in range(length):
            behind.append(costs.tolist())
            costs = ahead(one, costs)
    behind.reverse()
    edits, state, least = [], begin, costs.tolist()
    for symbol, costs in zip(symbols, behind, strict=True):
        while True:
            ways = [(edit, cost + costs[to], to) for edit, cost, to in options(state, symbol)]
            ways.append(("I", INSERT + least[FOLLOWS[state]], FOLLOWS[state]))
            edit, _, state_after = min(way for way in ways if way[1] == least[state])
            edits.append(edit)
            state = state_after
            if edit != "I":
                break
        least = costs
    if last:
        while ACCEPTED[state]:
            edits.append("I")
            state = FOLLOWS[state]
    return "".join(edits), state


# --- turns ---


def _stripped_end(text: Column) -> Column:
    """The last character that is no white space; empty for a blank text."""
    return F.substring(F.rtrim(text, F.lit(SPACE_BYTES.decode())), -1, 1)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that the checksum of ``conv_id:turn`` decides.

    Null values are one space, in the checksum as in roles and texts. Conversation
    id and turn keep their nulls.
    """
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role = F.when(draw == 4, "user").otherwise(space("role"))
    copies = F.sequence(F.lit(1), F.when(draw == 3, 2).otherwise(1))
    rows = conversations.filter(draw != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
    return rows.drop("copy")


def judged(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns with their places, and for each place: (blank, duplicate, truncated or none), stretch and symbol.

    Turns are ordered by ``turn``, null first, those of the same number as
    ``tie_order`` says. A turn without a role or text has empty ones. All turns
    without a conversation id are one conversation.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    content = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    slim = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), content.alias("content"), *[v.alias(n) for n, v in tie_order(role, text).items()])
    rows = placed(slim, "conv_id", ["turn", "_role", "_text", "_digest"], "ordered-turns")
    again = rows.groupBy("conv_id", "content").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).filter("n > 1")
    again = settled(again.select(F.col("conv_id").alias("_conv"), F.col("content").alias("_content"), "first"), "repeated-turns")
    facts = rows.select("conv_id", "turn", "place", "content", F.substring("role", 1, 1).alias("initial"), _stripped_end(F.col("text")).alias("end"))
    found = facts.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("content") == F.col("_content")), "left")
    fault = F.when(F.col("end") == "", "blank").when(F.col("place") > F.col("first"), "duplicate").when(~F.col("end").isin(".", "!", "?"), "truncated").otherwise("none")
    role_at = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    fault_at = F.when(F.col("fault").isin("blank", "duplicate"), 0).when(F.col("fault") == "truncated", 1).otherwise(2)
    symbol = F.substring(F.lit(SYMBOLS), role_at * 3 + fault_at + 1, F.lit(1))
    facts = found.select("conv_id", "turn", "place", fault.alias("fault"), "initial", F.floor(F.col("place") / STRETCH).alias("stretch"))
    return rows, settled(facts.withColumn("symbol", symbol).drop("initial"), "judged-turns")


LEGAL = {"su", "ua", "au"}


def illegal_pairs(roles: str) -> int:
    return sum(a + b not in LEGAL for a, b in zip(roles, roles[1:]))


def _role(symbol: str) -> str:
    return ROLES[SYMBOLS.index(symbol) // 3]


def _costed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of stretches (conv_id, stretch, symbols): matrix, illegal pairs inside, first and last symbol."""
    for batch in batches:
        symbols = batch.column("symbols").to_pylist()
        matrices = [stretch_matrix(s).ravel().tolist() for s in symbols]
        illegal = [illegal_pairs("".join(map(_role, s))) for s in symbols]
        made = [pa.array(matrices, pa.list_(pa.int64())), pa.array(illegal, pa.int64()), pa.array([s[0] for s in symbols]), pa.array([s[-1] for s in symbols])]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("stretch"), *made], names=["conv_id", "stretch", "matrix", "illegal", "head", "tail"])


def _from_the_end(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of conversations (conv_id, stretches in order): per stretch the costs after it; cost and illegal pairs with the first."""

    def rows(batch):
        for conv, stretches in zip(batch.column("conv_id").to_pylist(), batch.column("stretches").to_pylist(), strict=True):
            after, costs = [], final_costs()
            for part in reversed(stretches):
                after.append(costs.tolist())
                costs = ahead(np.array(part["matrix"], np.int64).reshape(4, 4), costs)
            illegal = sum(p["illegal"] for p in stretches) + sum(_role(a["tail"]) + _role(b["head"]) not in LEGAL for a, b in zip(stretches, stretches[1:]))
            sums, n = (illegal, int(costs[NOTHING])), len(stretches)
            for k, part in enumerate(stretches):
                yield conv, part["stretch"], after[n - 1 - k], k == n - 1, *(sums if k == 0 else (0, 0))

    for batch in batches:
        types = [batch.schema.field("conv_id").type, pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.int64(), pa.int64()]
        yield from _batched(rows(batch), ["conv_id", "stretch", "after", "last", "illegal", "cost"], types)


def _batched(rows: Iterable[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while some := list(islice(rows, 10_000)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), types, strict=True)], names=names)


def _choices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of stretches (conv_id, stretch, symbols, after, last): end state and audit for each state to begin in."""
    for batch in batches:
        ends, audits = [], []
        for symbols, after, last in zip(*(batch.column(n).to_pylist() for n in ("symbols", "after", "last")), strict=True):
            found = [unrolled(symbols, np.array(after, np.int64), begin, last) for begin in range(4)]
            ends.append([state for _, state in found])
            audits.append([audit for audit, _ in found])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("stretch"), pa.array(ends, pa.list_(pa.int32())), pa.array(audits, pa.list_(pa.string()))], names=["conv_id", "stretch", "ends", "audits"]
        )


def _begins(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of conversations (conv_id, stretches in order with their end states): the state each stretch begins in."""

    def rows(batch):
        for conv, stretches in zip(batch.column("conv_id").to_pylist(), batch.column("stretches").to_pylist(), strict=True):
            state = NOTHING
            for part in stretches:
                yield conv, part["stretch"], state
                state = part["ends"][state]

    for batch in batches:
        yield from _batched(rows(batch), ["conv_id", "stretch", "begin"], [batch.schema.field("conv_id").type, pa.int64(), pa.int32()])


def _same_stretch() -> Column:
    return F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("stretch") == F.col("_stretch"))


def _named(frame: DataFrame) -> DataFrame:
    return frame.withColumnsRenamed({"conv_id": "_conv", "stretch": "_stretch"})


class Repair:
    """Faults, edits and repaired turns of conversations (conv_id, turn, role, text).

    ``facts`` has a row per turn, ``stretches`` (conv_id, stretch, begin, audit,
    illegal, cost) one for at most ``STRETCH`` turns of a conversation: the audits
    of its stretches in order are its audit, their sums its illegal pairs and cost.
    A conversation without turns has none. No turns give no rows.
    """

    def __init__(self, turns: DataFrame):
        self.id_type = turns.schema["conv_id"].dataType.simpleString()
        self.rows, self.facts = judged(turns)
        of = lambda *columns: F.sort_array(F.collect_list(F.struct(*columns)))
        symbols = self.facts.groupBy("conv_id", "stretch").agg(F.array_join(F.transform(of("place", "symbol"), lambda t: t["symbol"]), "").alias("symbols"))
        symbols = settled(symbols, "stretches")
        costed = symbols.mapInArrow(_costed, f"conv_id {self.id_type}, stretch long, matrix array<long>, illegal long, head string, tail string")
        whole = costed.groupBy("conv_id").agg(of("stretch", "matrix", "illegal", "head", "tail").alias("stretches"))
        after = settled(whole.mapInArrow(_from_the_end, f"conv_id {self.id_type}, stretch long, after array<long>, last boolean, illegal long, cost long"), "costs-after")
        asked = symbols.join(_named(after), _same_stretch()).select("conv_id", "stretch", "symbols", "after", "last")
        choices = settled(asked.mapInArrow(_choices, f"conv_id {self.id_type}, stretch long, ends array<int>, audits array<string>"), "choices")
        begins = choices.groupBy("conv_id").agg(of("stretch", "ends").alias("stretches")).mapInArrow(_begins, f"conv_id {self.id_type}, stretch long, begin int")
        chosen = choices.join(_named(begins), _same_stretch()).select("conv_id", "stretch", "begin", F.get("audits", F.col("begin")).alias("audit"))
        self.stretches = settled(chosen.join(_named(after), _same_stretch()).select("conv_id", "stretch", "begin", "audit", "illegal", "cost"), "audits")

    def _with_edits(self, *by: str) -> DataFrame:
        """Each stretch's audit, followed by its turns, dealt and sorted by ``by`` and place."""
        turns = self.rows.select("conv_id", F.floor(F.col("place") / STRETCH).alias("stretch"), "place", "role", "text", F.lit(None).cast("int").alias("begin"))
        audits = self.stretches.select("conv_id", "stretch", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"), "begin")
        return turns.unionByName(audits).repartition(*by).sortWithinPartitions("conv_id", "stretch", "place").select("conv_id", "stretch", "place", "role", "text", "begin")

    def repaired_turns(self) -> DataFrame:
        """(conv_id, stretch, n, edit, role, text): the repaired conversations' turns, n counting from 0 in a stretch."""
        return self._with_edits("conv_id", "stretch").mapInArrow(_repaired_rows, f"conv_id {self.id_type}, stretch long, n long, edit string, role string, text string")

    def digests(self) -> DataFrame:
        """(conv_id, repaired_sha256) of ``role:text`` lines. The digest of a conversation reads its turns in order, as a stream."""
        return self._with_edits("conv_id").mapInArrow(_repaired_digests, f"conv_id {self.id_type}, repaired_sha256 string")


def repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, stretch, edit, role, text) of what each edit leaves; a deleted turn gives a row without text.

    Rows are a stretch's audit with the state it begins in, then its turns.
    """

    def insertions() -> Iterator[tuple]:
        nonlocal state
        while edits and edits[-1] == "I":
            edits.pop()
            state = FOLLOWS[state]
            yield at, stretch, "I", ROLE_NAMES[state], ""

    edits, state, at, stretch = [], NOTHING, None, None
    for batch in batches:
        for conv, part, place, role, text, begin in zip(*(batch.column(n) for n in ("conv_id", "stretch", "place", "role", "text", "begin")), strict=True):
            if place.as_py() == -1:
                yield from insertions()
                at, stretch, edits, state = conv.as_py(), part.as_py(), list(reversed(text.as_py())), begin.as_py()
                continue
            yield from insertions()
            edit = edits.pop()
            if edit == "D":
                yield at, stretch, edit, None, None
                continue
            own = role.as_py()
            state = FOLLOWS[state] if edit == "R" else kept_state(state, own[0])
            yield at, stretch, edit, ROLE_NAMES[state] if edit == "R" else own, text.as_py()
    yield from insertions()


def _repaired_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = iter(batches)
    first = next(batches, None)
    if first is None:
        return
    id_type, rows, size, at, n = first.schema.field("conv_id").type, [], 0, None, 0

    def packed():
        conv, part, places, edits, roles, texts = zip(*rows, strict=True)
        return pa.record_batch(
            [pa.array(conv, id_type), pa.array(part, pa.int64()), pa.array(places, pa.int64()), pa.array(edits), pa.array(roles, pa.string()), pa.array(texts, pa.string())], names=["conv_id", "stretch", "n", "edit", "role", "text"]
        )

    def all_batches():
        yield first
        yield from batches

    for conv, stretch, edit, role, text in repaired(all_batches()):
        if edit == "D":
            continue
        if (conv, stretch) != at:
            at, n = (conv, stretch), 0
        rows.append((conv, stretch, n, edit, role, text))
        n, size = n + 1, size + len(text)
        if size > 4_000_000 or len(rows) >= 10_000:
            yield packed()
            rows, size = [], 0
    if rows:
        yield packed()


def _repaired_digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    batches = iter(batches)
    first = next(batches, None)
    if first is None:
        return
    id_type = first.schema.field("conv_id").type

    def all_batches():
        yield first
        yield from batches

    def packed():
        ids, hashes = zip(*done, strict=True)
        return pa.record_batch([pa.array(ids, id_type), pa.array(hashes)], names=["conv_id", "repaired_sha256"])

    done, at, digest, empty = [], None, None, True
    for conv, _, edit, role, text in repaired(all_batches()):
        if digest is None or conv != at:
            if digest is not None:
                done.append((at, digest.hexdigest()))
            at, digest, empty = conv, hashlib.sha256(), True
            if len(done) >= 10_000:
                yield packed()
                done = []
        if edit != "D":
            digest.update((("" if empty else "\n") + role + ":" + text).encode())
            empty = False
    if digest is not None:
        done.append((at, digest.hexdigest()))
    if done:
        yield packed()


def report(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for each conversation id of ``conversations``, with faults and repair of its ``turns``.

    (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).
    """
    repair = Repair(turns)
    fault = lambda name: F.sum((F.col("fault") == name).cast("long")).alias(name)
    faults = repair.facts.groupBy("conv_id").agg(*[fault(name) for name in ("blank", "duplicate", "truncated")])
    numbers = repair.facts.filter(F.col("turn").isNotNull()).groupBy("conv_id", "turn").agg(F.first("conv_id").alias("_c"))
    span = numbers.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).cast("long").alias("gaps"))
    audits = repair.stretches.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("stretch", "audit"))), lambda part: part["audit"]), "").alias("audit"),
    )
    out = conversations.select("conv_id").distinct()
    for frame in (span, faults, audits, repair.digests()):
        out = out.join(frame.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    none = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of nothing
    return out.select("conv_id", *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in counts], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))
