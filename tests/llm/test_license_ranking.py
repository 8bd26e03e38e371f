"""License notices are won by what their template saves in compression."""

import random
import re

import pytest

from strata.llm import licenses
from tests.llm.test_llm import documents

PAIR = {
    "short": ["Shared under the Foo License."],
    "long": ["Shared under the Foo License with an exception for all works that only link to it."],
}
ONE_WORD_OFF = "Shared under the Foo License with one exception for all works that only link to it."


def least_differences(own, words):
    """Missing and added words of the best alignment, by a plain table; words around the aligned part are free."""
    rows = [[0] * (len(words) + 1)]
    for word in own:
        row = [rows[-1][0] + 1]
        for j, other in enumerate(words, 1):
            row.append(min(rows[-1][j] + 1, row[j - 1] + 1, rows[-1][j - 1] if word == other else 1 << 20))
        rows.append(row)
    return min(rows[-1])


def test_the_ranking_decides(monkeypatch):
    known = licenses.Templates(PAIR)
    # The short wording has no difference, the long one has two and saves far more.
    (place, block, name, saved, differing), = known.notices(ONE_WORD_OFF)
    assert (place, block, name, sorted(differing)) == (0, ONE_WORD_OFF, "long", ["+one", "-an"])
    (*_, name, fewer, differing), = known.notices(PAIR["short"][0])
    assert (name, differing) == ("short", []) and fewer < saved

    class Silent:
        def compress(self, data):
            return b""

    known.plain = Silent()
    for own in known.all:
        own.coder = Silent()
    assert [n[2] for n in known.notices(ONE_WORD_OFF)] == ["short"]


def test_a_candidate_is_ranked_by_every_template():
    known = licenses.Templates(licenses.TEMPLATES)
    text = "words before it " + licenses.TEMPLATES["BSD-3-Clause"][-1] + " words after it"
    words = licenses.wording(text)
    ranks = known.ranked(words, 3, 3)
    assert ranks[0][1].name == "BSD-3-Clause" and [g for g, _ in ranks] == sorted((g for g, _ in ranks), reverse=True)
    # The conditions of the two-clause license stand in it without a difference, and save less.
    two = licenses.TEMPLATES["BSD-2-Clause"][-1]
    assert least_differences(licenses.wording(two), words) <= 0.2 * len(licenses.wording(two))
    assert {n[2] for n in known.notices(text)} == {"BSD-3-Clause"}


@pytest.mark.parametrize("seed", range(3))
def test_differences_are_least_and_no_variant_is_lost(seed):
    known, chance = licenses.Templates(licenses.TEMPLATES), random.Random(seed)
    prose = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu", "ve") for b in ("ran", "sel", "tom", "dur", "nip")]
    for own in known.all:
        words, left = list(own.own), chance.randint(0, own.limit) // 2
        for i in chance.sample(range(1, len(words) - 1), max(0, len(words) - 2)):
            if left and words[i] not in own.needed and not re.search(licenses.CUES, words[i]):
                words[i], left = chance.choice(prose), left - 1
        text = " ".join([*chance.choices(prose, k=300), *words, *chance.choices(prose, k=300)])
        if not re.search(licenses.CUES, text):
            continue
        notices = known.notices(text)
        assert own.name in {n[2] for n in notices}, text
        for _, _, name, saved, differing in notices:
            costs = [least_differences(w.own, licenses.wording(text)) for w in known.all if w.name == name]
            assert len(differing) in costs and saved > 0


def test_short_notices(spark):
    texts = {
        "License: MIT": "MIT",
        "License: Apache-2.0": "Apache-2.0",
        "Licensed under GPLv3.": "GPL-3.0",
        "This project uses the MIT license.": "MIT",
        "Released under the BSD 2-Clause License.": "BSD-2-Clause",
        licenses.TEMPLATES["ISC"][-1]: "ISC",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0": "EPL-2.0",
        "They use no license at all.": None,
    }
    found = {r["doc_id"]: r["license"] for r in licenses.license_blocks(documents(spark, list(texts))).collect()}
    assert [found.get(i) for i in range(len(texts))] == list(texts.values())
