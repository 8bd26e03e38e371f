"""Plain Python versions of what the corpus operators compute."""

from __future__ import annotations

import math
import re
from collections import Counter

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def signed(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def xx(value: bytes | int, seed: int = 42) -> int:
    """Spark's xxhash64 of one value, unsigned."""
    return xxhash.xxh64_intdigest(value if isinstance(value, bytes) else value.to_bytes(8, "little", signed=True), seed)


def grams(text: str | None, buckets: int) -> list[int]:
    hashes = [signed(xx(w.encode())) for w in words(text)]
    pairs = [signed(xx(b, xx(a))) for a, b in zip(hashes, hashes[1:])]
    return [h % buckets for h in hashes + pairs]


def base(text: str | None) -> dict:
    found = words(text)
    seen = Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    hit = {i + k for i in range(len(found) - 4) if seen[tuple(found[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return {
        "n_words": len(found),
        "word_chars": sum(map(len, found)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
        "base_failed": len(found) < 10 or 100 * len(hit) > 20 * len(found),
    }


def quality(docs: list[tuple], labels: list[tuple], buckets: int) -> dict:
    """By doc_id: the figures, the score and the verdict. All labels are used, by turns of their hashes."""
    known: dict = {}
    for doc_id, value in labels:
        known.setdefault(doc_id, set()).add(value)
    good = {k: v == {1} for k, v in known.items() if len(v) == 1}
    fits = {k for kind in (True, False) for k in sorted((k for k in good if good[k] is kind), key=lambda k: (signed(xx(k)), k))[::2]}
    raw, target = Counter(), Counter()
    for doc_id, text in docs:
        found = grams(text, buckets)
        raw.update(found)
        if good.get(doc_id) and doc_id in fits:
            target.update(found)
    share = lambda n, total: math.log((n + 0.5) / (total + 0.5 * buckets))
    ratio = {b: round((share(target[b], target.total()) - share(raw[b], raw.total())) * 1e6) for b in raw}
    out = {}
    for doc_id, text in docs:
        found = grams(text, buckets)
        out[doc_id] = base(text) | {"score": sum(ratio[b] for b in found) // len(found) if found else 0}
    judged = [(row["score"], good[k]) for k, row in out.items() if k in good and k not in fits and not row["base_failed"]]
    scores = sorted({s for s, _ in judged})
    cut, best = -(1 << 62), -1
    n_good, n_bad = sum(g for _, g in judged), sum(not g for _, g in judged)
    for i, s in enumerate(scores if n_good and n_bad else []):
        if sum(g for x, g in judged if x < s) > math.floor(n_good * (1 - 0.99)):
            continue
        gain = sum(g for x, g in judged if x >= s) * n_bad + sum(not g for x, g in judged if x < s) * n_good
        if gain > best:
            best, cut = gain, (s + scores[i - 1]) // 2 if i else -(1 << 62)
    for row in out.values():
        row["kept"] = not row["base_failed"] and row["score"] >= cut
    return out


def shingles(text: str | None, size: int) -> set:
    found = words((text or "").translate(LOWER))
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()


def components(docs: list[tuple], size: int, percent: int) -> dict:
    """By place in the list: the place of the first member of the group, compared pair by pair."""
    sets, root = [shingles(text, size) for _, text in docs], list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in range(len(docs))}


def contamination(text: str | None, items: list[tuple], window: int = 13) -> tuple[int, int, set]:
    found, hit, which = ALNUM.findall((text or "").translate(LOWER)), set(), set()
    for item, body in items:
        own = ALNUM.findall((body or "").translate(LOWER))
        size = min(window, len(own))
        if not size:
            continue
        wanted = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
        for i in range(len(found) - size + 1):
            if tuple(found[i : i + size]) in wanted:
                hit.update(range(i, i + size))
                which.add(str(item))
    return len(found), len(hit), which


def longest_matches(text: str | None, items: list[tuple], window: int = 13) -> dict[str, tuple[int, int, int]]:
    """Per item words, start and place in the item of the longest common run of a window or more."""
    found, best = ALNUM.findall((text or "").translate(LOWER)), {}
    for item, body in items:
        own = ALNUM.findall((body or "").translate(LOWER))
        for start in range(len(found)):
            for place in range(len(own)):
                n = 0
                while start + n < len(found) and place + n < len(own) and found[start + n] == own[place + n]:
                    n += 1
                if n >= min(window, len(own)) and (str(item) not in best or n > best[str(item)][0]):
                    best[str(item)] = (n, start, place)
    return best
