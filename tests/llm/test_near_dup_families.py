"""Families below the similarity: no link is lost, and pairs grow in proportion."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import near_dups
from tests.llm import brute

DOCS = "doc_id long, text string"


def template_pages(n, own_words, seed=0):
    """Pages that share 120 words and have some of their own, each between shared ones."""
    draw = random.Random(seed)
    shared = [f"t{i}" for i in range(120)]
    for _ in range(n):
        page = shared.copy()
        for place in sorted(draw.sample(range(0, 120, 8), own_words)):
            page[place] = f"o{draw.randrange(10**9)}"
        yield " ".join(page)


def watched(monkeypatch, spark, texts, size, percent):
    """Component of each text, and the number of pairs that were confirmed on whole texts."""
    held = {}
    settled = near_dups.settled

    def recording(rows, purpose):
        held.setdefault(purpose, []).append(out := settled(rows, purpose))
        return out

    monkeypatch.setattr(near_dups, "settled", recording)
    frame = spark.createDataFrame(list(enumerate(texts)), DOCS)
    rows = near_dups.NearDuplicates(frame, size, percent).groups().collect()
    monkeypatch.setattr(near_dups, "settled", settled)
    led = sum(f.count() for f in held["candidates"])
    met = sum(f.agg(F.sum(F.size("members"))).first()[0] or 0 for f in held["probes"])
    return {r["doc_id"]: r["component_id"] for r in rows}, led, met


def test_pairs_of_a_family_grow_in_proportion(spark, monkeypatch):
    seen = {}
    for n in (200, 400):
        texts = list(template_pages(n, 4))
        found, led, met = watched(monkeypatch, spark, texts, 3, 85)
        assert found == {i: i for i in range(n)}
        seen[n] = (led, met)
    assert all(met <= 4 * n for n, (_, met) in seen.items()), seen
    # Every class is held against the two leaders of each of its 40 buckets.
    assert all(led <= 2 * near_dups.BANDS * n for n, (led, _) in seen.items()), seen
    assert seen[400][0] + seen[400][1] <= 3 * (seen[200][0] + seen[200][1]), seen


@pytest.mark.parametrize("seed", range(2))
def test_links_inside_of_families_are_found(spark, monkeypatch, seed):
    """Near copies hidden among pages that are almost as near, small blocks included."""
    monkeypatch.setattr(near_dups, "FAMILY", 8)
    monkeypatch.setattr(near_dups, "BLOCK", 5)
    draw = random.Random(seed)
    texts = list(template_pages(60, 4, seed))
    for text in draw.sample(texts, 15):
        words = text.split()
        words[draw.randrange(len(words))] = f"n{draw.randrange(10**9)}"
        texts.append(" ".join(words))
    texts += list(template_pages(20, 2, seed + 9))
    draw.shuffle(texts)
    found, _, _ = watched(monkeypatch, spark, texts, 3, 85)
    want = brute.components(list(enumerate(texts)), 3, 85)
    assert found == want and 0 < sum(i != c for i, c in want.items())


@pytest.mark.parametrize("percent", [80, 85, 100])
def test_sets_that_are_alike_share_a_rare_key(percent):
    draw = np.random.default_rng(percent)
    for _ in range(300):
        n = int(draw.integers(1, 400))
        a = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
        gone = draw.random() * (100 - percent) / 100
        kept = a[draw.random(len(a)) >= gone]
        more = draw.integers(0, 1 << 63, int(draw.integers(0, max(1, int(len(a) * (100 - percent) / 100)) + 1)), dtype=np.uint64)
        b = np.unique(np.concatenate([kept, more]))
        if not len(b):
            continue
        counts = draw.integers(0, 5, near_dups.COUNTERS)
        mine, theirs = (dict(zip(*(part.tolist() for part in near_dups.rare_keys(s, counts, percent)))) for s in (a, b))
        if near_dups.similar(a, b, percent):
            assert any(key in theirs and (side == near_dups.EITHER or theirs[key] != side) for key, side in mine.items())


def test_size_classes_hold_their_sizes():
    for size in [*range(1, 400), 10_000, 123_457, 10**7]:
        number = near_dups.size_class(size)
        assert near_dups.least_of_class(number) <= size < near_dups.least_of_class(number + 1)


def test_a_repeated_row_gives_its_text_once(spark):
    rows = [(1, "a b c d e f g")] * 50 + [(2, "a b c d e f g h")]
    near = near_dups.NearDuplicates(spark.createDataFrame(rows, DOCS), 3, 80)
    assert near._texts_of(near.classes.select("id")).count() == near.classes.count()
    assert {r["component_id"] for r in near.groups().collect()} == {1}
