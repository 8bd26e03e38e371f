"""Prefix trie against a walk over sets of prefixes, and parentheses against a stack."""

import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string"
FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def walked(paths: dict[int, list[tuple[str, str]]]) -> set[tuple]:
    """Every node of the trie of whole paths, by sets."""
    members: dict[tuple, list[int]] = {}
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(conv)
    out = set()
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        childless = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in members)]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(paths[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        children = sum(len(n) == len(node) + 1 for n in below)
        out.add((min(convs), len(node), parent, len(convs), children, len(childless), saved, sha256(ends.encode()).hexdigest()))
    return out


def rebuilt(rows) -> dict[int, list[tuple[str, str]]]:
    own: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [t[2:] for t in sorted(turns)] for conv, turns in own.items()}
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        out[conv] = own.get(conv - conv % 20, [])[:h] + turns[h:]
    return out


def nodes(frame) -> list[tuple]:
    return [tuple(r[n] for n in FIELDS) for r in frame.collect()]


def test_nodes_one_by_one(spark):
    draw = random.Random(11)
    say = lambda: (draw.choice(["user", "assistant", None]), draw.choice(["a b", "a", "", None, " c\td\n", "e" * 70 + draw.choice("xy")]))
    rows = [(conv, turn, *say()) for conv in range(90) if conv != 40 for turn in range(draw.randrange(0, 6))]
    rows += [(conv, turn, "user", "shared") for conv in range(200, 240) for turn in range(5)]  # copies but for their bases
    rows += [(7, None, "system", "first"), (7, 0, "user", "tie"), (7, 0, "user", "ties"), (8, 3, "user", "again"), (8, 3, "user", "again"), (None, 0, "user", "of none")]
    rows += [(5_000_000_000, k, "user", f"long {k // 2}") for k in range(2500)]
    draw.shuffle(rows)
    frame = spark.createDataFrame(rows, TURNS).withColumns({n: F.lit("mine") for n in ("n", "depth", "key", "place", "owner", "block")})
    found = nodes(prefix_trie.trie(*prefix_trie.rebuilt(frame)))
    paths = rebuilt(rows)
    assert any(not path for path in paths.values())
    short = {c: p for c, p in paths.items() if len(p) < 2000}
    deep = next(c for c in paths if c not in short)
    # The long path by itself is checked by its length and ends; walking all pairs of it would take too long.
    wanted = {n for n in walked(short) if n[1] > 0}
    assert wanted - set(found) <= {n for n in walked(short) if n[1] == 1}
    assert len(found) == len(set(found)) == len(walked(short)) + sum(1 for n in found if n[0] == deep)
    chain = sorted(n for n in found if n[0] == deep)
    assert chain[-1][1] == len(paths[deep]) and all(n[3] == 1 and n[5] == 1 and n[6] == 0 for n in chain)
    root = next(n for n in found if n[1] == 0)
    assert root[2] is None and root[3] == len(paths) and root[0] == min(paths)


@pytest.mark.parametrize("seed", range(3))
def test_shared_spines_go_over_shards(spark, seed):
    draw = random.Random(seed)
    rows, spine = [], [f"s{k}" for k in range(40)]
    for conv in range(60):
        cut = draw.randrange(0, 41)
        path = spine[:cut] + [f"{draw.randrange(2)} w{k}" for k in range(draw.randrange(0, 4))]
        rows += [(conv * 20 + 3, k, "user", text) for k, text in enumerate(path)]
    paths = rebuilt(rows)
    found = nodes(prefix_trie.trie(*prefix_trie.rebuilt(spark.createDataFrame(rows, TURNS))))
    assert set(found) == walked(paths) and len(found) == len(set(found))


def test_one_path_for_copies(spark):
    rows = [(20 * conv, turn, "user", f"t {turn}") for conv in range(300) for turn in range(30)]
    found = nodes(prefix_trie.trie(*prefix_trie.rebuilt(spark.createDataFrame(rows, TURNS))))
    assert len(found) == 31 and {n[3] for n in found} == {300}
    assert next(n for n in found if n[1] == 0)[6] == 299 * 2 * 30


def test_no_conversations(spark):
    none = spark.createDataFrame([], TURNS)
    assert nodes(prefix_trie.trie(*prefix_trie.rebuilt(none))) == []
    ids = spark.createDataFrame([(None, 1, "user", "x")], TURNS)
    assert nodes(prefix_trie.trie(*prefix_trie.rebuilt(ids))) == []


@pytest.mark.parametrize("seed", range(20))
def test_parentheses_by_a_stack(seed):
    draw = random.Random(seed)
    depths = [draw.randrange(0, 300)]
    for _ in range(draw.choice([0, 1, 5, 300, 3000])):
        depths.append(depths[-1] + 1 if draw.random() < 0.6 else max(0, depths[-1] + 1 - int(draw.expovariate(0.2))))
    depths, weights, leaf = np.array(depths), np.array([draw.randrange(9) for _ in depths]), draw.random() < 0.5
    written = prefix_trie.Parentheses(depths, leaf)
    leaves, saved, ends = written.subtrees(weights)
    n = len(depths)
    is_leaf = [depths[i + 1] <= depths[i] for i in range(n - 1)] + [leaf]
    for i in range(n):
        end = next((j for j in range(i + 1, n) if depths[j] <= depths[i]), n)
        closed = end < n or (i == n - 1 and leaf)
        assert bool(ends[i]) == closed
        assert leaves[i] == sum(is_leaf[i:end]) and saved[i] == weights[i:end].sum()
