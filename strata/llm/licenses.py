"""License scans by conditional compression.

A text that a template explains compresses far better once the template is
given as a raw dictionary. The words around the cues of a text are a candidate
block; every template compresses it, and the templates are ranked by the bytes
they save. In this order their wordings are aligned with the block, words before
and after the aligned part being free, until the rest saves less on the whole
block than the confirmed notices of its cues alone, but for noise. Templates that save nothing
are not looked at. Of notices that overlap, the one that saves more is kept.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.shared import identity

_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'


def _gnu(name: str, version: str, dated: str, spdx: str) -> tuple[str, ...]:
    """The header of source files in its usual forms, the head of the full text, the short identifiers."""
    grant = "This program is free software; you can redistribute it and/or modify it under the terms of"
    return (
        f"This work is licensed under the {name}, version {version}.",
        f"{grant} the {name} as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version.",
        f"{grant} version {version} of the {name} as published by the Free Software Foundation.",
        f"{grant} the {name} version {version} as published by the Free Software Foundation.",
        f"Licensed under the {name} version {version}.",
        f"Licensed under the {name} v{version}.",
        f"{name} Version {version}, {dated}",
        *(f"{head}: {spdx}{end}" for head in ("SPDX-License-Identifier", "License") for end in ("", "-only", "-or-later")),
        f"License: {spdx.split('-')[0]}v{version}",
        f"Licensed under {spdx.split('-')[0]}v{version}.",
    )


def _commons(terms: str, short: str) -> tuple[str, ...]:
    return (
        f"Licensed under {short} 4.0.",
        f"This work is licensed under a Creative Commons {terms} 4.0 International License.",
        f"Licensed under the Creative Commons {terms} 4.0 License.",
        f"Creative Commons {terms} 4.0 International Public License",
        f"SPDX-License-Identifier: {short.replace(' ', '-')}-4.0",
    )


#: Notices, headers and full texts by which works state a license: name, wordings. Of the long full texts the head stands.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Distributed under the MIT License.",
        "Licensed under the terms of the MIT License.",
        "This project uses the MIT License.",
        "License: MIT",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. '
        + _AS_IS,
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Released under the Apache License, Version 2.0.",
        "Licensed under the Apache License 2.0.",
        "Apache License Version 2.0, January 2004",
        "License: Apache-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-2.0": _gnu("GNU General Public License", "2", "June 1991", "GPL-2.0"),
    "GPL-3.0": _gnu("GNU General Public License", "3", "29 June 2007", "GPL-3.0"),
    "LGPL-3.0": _gnu("GNU Lesser General Public License", "3", "29 June 2007", "LGPL-3.0"),
    "AGPL-3.0": _gnu("GNU Affero General Public License", "3", "19 November 2007", "AGPL-3.0"),
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Licensed under the ISC License.",
        "License: ISC",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "EPL-2.0": (
        "Licensed under the Eclipse Public License 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "MPL-2.0": (
        "This file is subject to the terms of the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "Mozilla Public License Version 2.0 1. Definitions",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-4.0": _commons("Attribution", "CC BY"),
    "CC-BY-SA-4.0": _commons("Attribution-ShareAlike", "CC BY-SA"),
    "CC-BY-NC-4.0": _commons("Attribution-NonCommercial", "CC BY-NC"),
    "CC0-1.0": (
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide under CC0 1.0.",
        "Licensed under CC0 1.0.",
        "Creative Commons Legal Code CC0 1.0 Universal",
        "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "all-rights-reserved": ("All rights reserved.",),
}
#: Every wording above has one of these, a wrapped one too.
CUES = r"(?i)licen[sc]|rights\W+reserved|public\W+domain|free\W+of\W+charge|redistribution\W+and\W+use|hereby\W+granted|legal\W+code"
LEVEL = 3
#: Bytes by which the size of a block varies with how its letters are coded; no notice within the tolerance saves less than their negative.
NOISE = 8
#: Share of a wording's words that may differ.
TOLERANCE = 0.2

FOUND = T.ArrayType(
    T.StructType(
        [T.StructField("license", T.StringType()), T.StructField("saved", T.IntegerType()), T.StructField("differences", T.ArrayType(T.StringType()))]
    )
)


def wording(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text.lower())


#: Words that tell licenses apart, beside all with a digit. Those of a wording must all be there.
NAMES = frozenset("mit apache isc eclipse gnu general public lesser affero bsd mozilla cc by-sa by-nc domain unencumbered unlicense rights reserved endorse attribution attribution-sharealike attribution-noncommercial".split())
#: Words that make another license of it where the wording does not have them.
RIVALS = frozenset("lesser library affero noncommercial non-commercial sharealike share-alike noderivatives noderivs".split())
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
_BORDER = re.compile(r"\n|(?<=[.!?])[ \t]+(?=(\S))")
_FAR = 1 << 20


def essential(words: Iterable[str]) -> list[str]:
    return sorted({word for word in words if word in NAMES or any(c.isdigit() for c in word)})


class Wording:
    """One wording of a license, with its compressor and its alignment.

    A missing (-) and an added (+) word cost 1 each. What the text has before
    and after the aligned part is free, but words missing at its ends count with
    as many words that stand in their place in the same block.
    """

    def __init__(self, name: str, text: str):
        self.name, self.own = name, wording(text)
        data = zstandard.ZstdCompressionDict(" ".join(self.own).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        self.coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False)
        self.needed = frozenset(essential(self.own))
        self.limit = int(TOLERANCE * len(self.own) + 1e-9)
        #: Words before and after a word of a notice that can belong to it.
        self.reach = len(self.own) + self.limit - 1
        self.rivals = RIVALS - set(self.own)

    def fits(self, words: set[str]) -> bool:
        return self.needed <= words and sum(word not in words for word in self.own) <= self.limit

    def _rows(self, words: np.ndarray, ids: dict[str, int], rival: np.ndarray, before: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each word of the wording: least costs by words of the text used, when it is the last match, and in any case."""
        added = np.concatenate([[0], np.cumsum(np.where(rival, _FAR, 1))])
        inside = np.full(len(words) + 1, _FAR)
        free = True
        for i, word in enumerate(self.own):
            match = np.full(len(words) + 1, _FAR)
            start = i + np.minimum(i, before) if free and i <= self.limit else _FAR
            match[1:] = np.where(words == ids.get(word, -1), np.minimum(inside[:-1], start), _FAR)
            free = free and word not in self.needed
            inside = np.minimum(match, inside + (_FAR if word in self.needed else 1))
            inside = np.minimum(np.minimum.accumulate(inside - added) + added, _FAR)
            yield match, inside

    def _tails(self) -> dict[int, int]:
        """Words that may be missing at the end, by the number of words used."""
        tails, n = {}, len(self.own)
        for i in range(n, max(0, n - self.limit) - 1, -1):
            tails[i] = n - i
            if i and self.own[i - 1] in self.needed:
                break
        return tails

    def aligned(self, text: list[str], words: np.ndarray, ids: dict[str, int], before: np.ndarray, after: np.ndarray) -> list[tuple[int, int, list[str]]]:
        """(first word, end, differences) of the parts that have this wording, none over another."""
        rival = np.isin(words, [ids[w] for w in self.rivals if w in ids])
        tails, ends = self._tails(), np.full(len(words) + 1, _FAR)
        charge = np.concatenate([[0], after])
        for i, (match, _) in enumerate(self._rows(words, ids, rival, before), 1):
            if i in tails:
                ends = np.minimum(ends, match + tails[i] + np.minimum(tails[i], charge))
        found: list[tuple[int, int, list[str]]] = []
        good = np.flatnonzero(ends <= self.limit)
        for end in good[np.argsort(ends[good], kind="stable")].tolist():
            if any(a < end <= b for a, b, _ in found):
                continue
            low = max(0, end - len(self.own) - self.limit - 1)
            rows = list(self._rows(words[low:end], ids, rival[low:end], before[low:end]))
            hit = self._traced(rows, text, low, end, int(ends[end]), tails, before, int(charge[end]))
            if not any(a < hit[1] and hit[0] < b for a, b, _ in found):
                found.append(hit)
        return found

    def _traced(self, rows, text, low, end, cost, tails, before, charge) -> tuple[int, int, list[str]]:
        i = next(i for i, gone in tails.items() if rows[i - 1][0][end - low] + gone + min(gone, charge) == cost)
        j = end
        # Backwards: the words of a place are taken from the last to the first, additions before what is missing.
        out = ["+" + w for w in text[end : end + min(tails[i], charge)][::-1]] + ["-" + w for w in self.own[i:][::-1]]
        while True:
            value = int(rows[i - 1][0][j - low])
            i, j = i - 1, j - 1
            if i <= self.limit and not self.needed & set(self.own[:i]) and i + min(i, int(before[j])) == value:
                k = min(i, int(before[j]))
                return j, end, [*("-" + w for w in self.own[:i]), *("+" + w for w in text[j - k : j]), *out[::-1]]
            gone, more = [], []
            while int(rows[i - 1][0][j - low]) != value:
                if i > 1 and int(rows[i - 2][1][j - low]) + 1 == value and self.own[i - 1] not in self.needed:
                    i -= 1
                    gone.append("-" + self.own[i])
                else:
                    j -= 1
                    more.append("+" + text[j])
                value -= 1
            out += more + gone


class Templates:
    """The wordings, and a compressor without any."""

    def __init__(self, templates: Mapping[str, Iterable[str]], cues: str = CUES):
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.cues = re.compile(cues)
        self.all = [Wording(name, text) for name, texts in templates.items() for text in texts]
        self.reach = max([0, *(w.reach for w in self.all)])

    def ranked(self, words: list[str], first: int, last: int) -> list[tuple[int, Wording]]:
        """(bytes saved, wording) of the templates that may make the block around these cues smaller, the largest saving first.

        The block of a template reaches as far as a notice of it can. Words are
        compressed in lower case with single spaces, as wraps and capitals are
        no differences.
        """
        alone: dict[int, tuple[bytes, int]] = {}
        saved = []
        for own in self.all:
            if own.reach not in alone:
                data = " ".join(words[max(0, first - own.reach) : last + own.reach + 1]).encode()
                alone[own.reach] = data, len(self.plain.compress(data))
            data, size = alone[own.reach]
            saved.append((size - len(own.coder.compress(data)), own))
        return sorted((x for x in saved if x[0] > -NOISE), key=lambda x: -x[0])

    def notices(self, text: str) -> list[tuple[int, str, str, int, list[str]]]:
        """(place, block, license, bytes saved, differing words) of each notice of the text, in order."""
        starts = [0, *(end for _, end in borders(text))]
        cues = [m.start() for m in self.cues.finditer(text)]
        marks = list(_WORD.finditer(text))
        if not cues or not marks:
            return []
        words = [m[0].lower() for m in marks]
        at = np.array([m.start() for m in marks])
        block = np.searchsorted(starts, at, "right") - 1
        first, last = np.searchsorted(block, block, "left"), np.searchsorted(block, block, "right")
        before, after = np.arange(len(words)) - first, last - np.arange(len(words)) - 1
        found = []
        cued = np.unique(np.maximum(np.searchsorted(at, cues, "right") - 1, 0))
        for group in self._candidates(cued, block):
            a, b = max(0, int(group[0]) - self.reach), min(len(words), int(group[-1]) + self.reach + 1)
            found += self._confirmed(group, words[a:b], a, np.minimum(before[a:b], np.arange(b - a)), np.minimum(after[a:b], np.arange(b - a)[::-1]))
        taken: list[tuple] = []
        for hit in sorted(found, key=lambda x: (-x[0], len(x[1]), x[2:5])):
            if all(hit[4] <= x[3] or x[4] <= hit[3] for x in taken):
                taken.append(hit)
        out = []
        for saved, differing, name, start, end in sorted(taken, key=lambda x: x[3]):
            place, stop = int(block[start]), int(block[end - 1]) + 1
            whole = text[starts[place] : starts[stop] if stop < len(starts) else len(text)]
            out.append((place, _trimmed(whole) if stop < len(starts) else whole, name, saved, differing))
        return out

    def _candidates(self, cued: np.ndarray, block: np.ndarray) -> Iterator[np.ndarray]:
        """Cues of one line or sentence that lie in the reach of the first of them."""
        start = 0
        for k in range(1, len(cued) + 1):
            if k == len(cued) or block[cued[k]] != block[cued[start]] or cued[k] - cued[start] > self.reach:
                yield cued[start:k]
                start = k

    def _confirmed(self, cues: np.ndarray, words: list[str], a: int, before: np.ndarray, after: np.ndarray) -> list[tuple[int, list[str], str, int, int]]:
        """(bytes saved, differences, license, first word, end) of the notices over the cues, from the best template on."""
        there = set(words)
        ids = {word: k for k, word in enumerate(sorted(there))}
        coded = np.array([ids[word] for word in words])
        hits: list[tuple[int, list[str], str, int, int]] = []
        for gain, own in self.ranked(words, int(cues[0]) - a, int(cues[-1]) - a):
            over = [max((x[0] for x in hits if x[3] <= cue < x[4]), default=NOISE) for cue in cues.tolist()]
            if gain < min(over) - 2 * NOISE:
                break
            if not own.fits(there):
                continue
            for start, end, differing in own.aligned(words, coded, ids, before, after):
                if ((cues >= a + start) & (cues < a + end)).any():
                    part = " ".join(words[start:end]).encode()
                    saved = len(self.plain.compress(part)) - len(own.coder.compress(part))
                    hits.append((saved, differing, own.name, a + start, a + end))
        return hits


def borders(text: str) -> list[tuple[int, int]]:
    """Where blocks end and the next begin: at lines, and where a sentence ends and the next begins with a capital."""
    return [m.span() for m in _BORDER.finditer(text) if m[1] is None or unicodedata.category(m[1]) == "Lu"]


def _trimmed(whole: str) -> str:
    """Blocks without the border that follows the last one."""
    return whole[:-1] if whole.endswith("\n") else whole.rstrip(" \t")


def _confirm(templates: Mapping[str, Iterable[str]], cues: str):
    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, cues)
        for batch in batches:
            rows = [(k, *notice) for k, text in enumerate(batch.column("text").to_pylist()) for notice in known.notices(text)]
            out = batch.select(["doc_id", "doc"]).take(pa.array([r[0] for r in rows], pa.int64()))
            types = [pa.int32(), pa.string(), pa.string(), pa.int32(), pa.list_(pa.string())]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(types, 1)]
            yield pa.RecordBatch.from_arrays([*out.columns, *columns], names=[*out.schema.names, "place", "block", "license", "saved", "differences"])

    return apply


def license_blocks(
    docs: DataFrame, templates: Mapping[str, Iterable[str]] = TEMPLATES, cues: str = CUES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, doc, place, block, license, saved, differences) for each license wording in a text.

    ``block`` is the line or sentence of the wording, or all that it goes over;
    ``place`` is the number of the first one, from 0. Every cue, which each
    template must have, makes a candidate of the words around it in the reach of
    the longest template; every template compresses it, and they are confirmed in
    the order of the bytes they save. A confirmed wording has all names and versions of its
    template and differs in a fifth of its words at most; ``differences`` lists
    missing (-) and added (+) words. ``saved`` is what the template saves on the
    words of the notice; of several that overlap the largest saving wins. Texts that are null or empty have no blocks, repeated
    rows each give theirs, and a null id stays null.
    """
    rows = docs.filter(F.col(text_col).rlike(cues)).select(
        F.col(id_col).alias("doc_id"), identity(F.col(id_col), F.col(text_col)).alias("doc"), F.col(text_col).alias("text")
    )
    schema = T.StructType([rows.schema["doc_id"], rows.schema["doc"], T.StructField("place", T.IntegerType()), T.StructField("block", T.StringType()), *FOUND.elementType.fields])
    return rows.mapInArrow(_confirm(templates, cues), schema)
