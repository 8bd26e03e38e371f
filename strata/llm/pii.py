"""Personal data: base patterns, and a linear-chain conditional random field.

The patterns find what is written by the book. The random field reads tokens
by their shapes and those of their neighbours, and adds what is not: numbers
cut up in other ways, addresses with odd signs. It is trained on a small labelled
table. A token without a digit or an at sign can only be outside; runs of other
tokens are thus independent of one another given the words around them, and all
runs of a batch are decoded by one Viterbi pass over numpy arrays.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
#: A value begins with the label of its kind and goes on with the other one.
INSIDE = tuple(f"{kind} goes on" for kind in KINDS)
LABELS = ("outside", *KINDS, *INSIDE)
Span = tuple[int, int, str]

#: The contract's patterns. The looks behind only skip starts that can't succeed, so that no text takes quadratic time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile("[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
#: What signs between values in one token leave of it, and the signs that values do not begin or end with.
_UNIT = re.compile(r"[^\x20\x09-\x0D,;|/]+")
_EDGE = ".,;:!?\"'<>[]|/ \t\x0b\x0c\r"
#: Pieces of one value, at most: as many as it may have digits, and more.
PIECES = 24


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            done = domain.end()
            yield start, done, "email"
            at = text.find("@", done)
        else:
            done = max(done, at + 1)
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by start and then by kind as listed."""
    found = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        for match in _IP.finditer(text):
            # A long part is over 255 whatever it is, unless zeros lead it.
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
                found.append((*match.span(), "ip"))
        for match in _CARD.finditer(text):
            digits = re.sub("[ -]", "", match[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((*match.span(), "card"))
        for match in _PHONE.finditer(text) if "+" in text else ():
            if 10 <= len(_DIGIT.findall(match[0])) <= 15:
                found.append((*match.span(), "phone"))
    return in_order(found)


def in_order(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda span: (span[0], KINDS.index(span[2]), span[1]))


def listed(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# --- features ---------------------------------------------------------------


def shape(token: str) -> str:
    """The token with letters as x and X, digits as d, runs cut to two."""
    out: list[str] = []
    for c in token[:80]:
        s = "d" if "0" <= c <= "9" else "X" if c.isupper() else "x" if c.isalpha() else c
        if len(out) < 2 or out[-1] != s or out[-2] != s:
            out.append(s)
    return "".join(out)


def token_features(tokens: list[str], i: int) -> list[str]:
    token = tokens[i]
    core = token.strip(".,;:!?\"'<>[]")
    digits = sum("0" <= c <= "9" for c in core)
    around = lambda k: shape(tokens[k].strip(".,;:!?\"'<>[]")) if 0 <= k < len(tokens) else "-"
    alike = 0
    while alike < 8 and i > alike and around(i - alike - 1) == around(i):
        alike += 1
    word = lambda k: tokens[k].lower().strip(".,;:!?\"'<>[]") if 0 <= k < len(tokens) and not _DIGIT.search(tokens[k]) else "-"
    return [
        "bias",
        "shape=" + shape(core),
        "before=" + around(i - 1),
        "after=" + around(i + 1),
        "two before=" + around(i - 2) + " " + around(i - 1),
        f"alike before={alike}",
        f"sign before={tokens[i - 1][-1] if i and tokens[i - 1][-1] in '.,;:|/' else '-'}",
        "word before=" + word(i - 1),
        f"digits={min(digits, 20)}",
        f"length={min(len(core), 24)}",
        f"dots={core.count('.')}",
        f"at={'@' in core}",
        f"plus={core[:1] == '+'}",
        f"letters={any(c.isalpha() for c in core)}",
        f"signs={''.join(sorted(set(re.sub('[^-()/.+@:=#$%_&]', '', core))))}",
    ]


def is_candidate(token: str) -> bool:
    return "@" in token or bool(_DIGIT.search(token))


# --- training ---------------------------------------------------------------


def labelled_table(rows: int = 600, seed: int = 7) -> list[tuple[list[str], list[str]]]:
    """Small labelled table of (tokens, labels), made from patterns of writing by rule."""
    draw = random.Random(seed)
    digits = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    letters = lambda n: "".join(draw.choice("abcdefghijklmnoprstuvw") for _ in range(n))
    plain = lambda: letters(draw.randint(2, 9))

    def card() -> str:
        body = digits(15)
        return next(body + d for d in "0123456789" if luhn(body + d))

    cut = lambda number, sign: sign.join(number[k : k + 4] for k in range(0, 16, 4))
    positive = {
        "email": [lambda: f"{letters(5)}.{digits(2)}@mail{digits(1)}.example.com", lambda: f"{letters(6)}@{letters(5)}.org", lambda: f"{letters(4)}_{letters(4)}@{letters(5)}.co.{letters(2)}", lambda: f"{letters(5)}'{letters(3)}@{letters(6)}.net"],
        "ip": [lambda: ".".join(str(draw.randint(0, 255)) for _ in range(4)), lambda: ".".join(str(draw.randint(0, 255)) for _ in range(4)) + ":" + digits(4)],
        "card": [card, lambda: cut(card(), "-"), lambda: cut(card(), " "), lambda: cut(card(), ".")],
        "phone": [lambda: f"+1 ({digits(3)}) 555-{digits(4)}", lambda: f"+{digits(2)} {digits(3)} {digits(7)}", lambda: f"({digits(3)}) 555-{digits(4)}", lambda: f"{digits(3)}-555-{digits(4)}", lambda: f"+{digits(11)}"],
    }
    negative = [
        lambda: str(draw.randint(1900, 2030)), lambda: digits(draw.randint(1, 6)), lambda: f"{digits(1)}.{digits(1)}", lambda: f"v{digits(1)}.{digits(1)}.{digits(2)}",
        lambda: f"20{digits(2)}-0{draw.randint(1, 9)}-{draw.randint(10, 28)}", lambda: f"{draw.randint(10, 23)}:{draw.randint(10, 59)}", lambda: f"${digits(3)}.{digits(2)}", lambda: f"{digits(2)}%",
        lambda: f"password={letters(2)}{digits(3)}{letters(4)}{digits(4)}", lambda: f"token = \"{digits(4)}{letters(5)}{digits(8)}\"", lambda: f"AKIA{letters(6).upper()}{digits(4)}{letters(4).upper()}", lambda: f"{letters(5)}{digits(2)}", lambda: digits(draw.randint(7, 12)), lambda: f"@{letters(6)}", lambda: f"{digits(1)}.{digits(1)}.{digits(1)}",
        lambda: f"{digits(3)}-{digits(2)}", lambda: f"#{digits(5)}", lambda: f"https://{letters(5)}.org/{digits(4)}", lambda: f"{digits(20)}", lambda: f"{letters(3).upper()}-{digits(6)}",
    ]
    table = []
    for row in range(rows):
        tokens, labels = [], []
        for _ in range(draw.randint(1, 3)):
            for _ in range(draw.randint(1, 4)):
                tokens.append(plain())
                labels.append("outside")
            kind = draw.choice(KINDS) if draw.random() < 0.55 else None
            # Values of one kind may stand side by side, as in lists and columns.
            side_by_side = draw.randint(2, 4) if kind and draw.random() < 0.4 else 1
            way = draw.choice(positive[kind]) if kind else draw.choice(negative)
            between = draw.choice(["", ",", ";"])
            for k in range(side_by_side):
                made = way() + (between if k < side_by_side - 1 else draw.choice(["", "", ".", ","]))
                begun = False
                for token in made.split(" "):
                    tokens.append(token)
                    labels.append("outside" if not kind or not is_candidate(token) else INSIDE[KINDS.index(kind)] if begun else kind)
                    begun = True
        tokens.append(plain())
        labels.append("outside")
        table.append((tokens, labels))
    return table


class ChainField:
    """Weights of features and of neighbouring labels; both ends count as outside."""

    def __init__(self, features: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.features, self.emit, self.move = features, emit, move

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        """Label scores of tokens from their features; unknown features count nothing."""
        out = np.zeros((len(rows), len(LABELS)))
        find = self.features.get
        flat = [(i, f) for i, names in enumerate(rows) for name in names if (f := find(name)) is not None]
        if flat:
            at, which = np.array(flat).T
            np.add.at(out, at, self.emit[which])
        return out

    def decode(self, runs: list[np.ndarray]) -> list[np.ndarray]:
        """Best label sequences of the runs, by one Viterbi pass over all of them, longest first."""
        if not runs:
            return []
        order = sorted(range(len(runs)), key=lambda k: -len(runs[k]))
        lengths = np.array([len(runs[k]) for k in order])
        steps = int(lengths[0])
        best = np.zeros((len(runs), len(LABELS)))
        back = np.zeros((steps, len(runs), len(LABELS)), np.int8)
        for t in range(steps):
            alive = int(np.searchsorted(-lengths, -t, "left"))  # runs longer than t
            emit = np.stack([runs[k][t] for k in order[:alive]])
            if t == 0:
                best[:alive] = self.move[0] + emit
            else:
                paths = best[:alive, :, None] + self.move[None]
                back[t, :alive] = paths.argmax(1)
                best[:alive] = paths.max(1) + emit
        last = (best + self.move[:, 0]).argmax(1)
        out: list[np.ndarray] = [np.empty(0, np.int8)] * len(runs)
        for place, k in enumerate(order):
            path = np.empty(lengths[place], np.int8)
            label = last[place]
            for t in range(lengths[place] - 1, -1, -1):
                path[t] = label
                label = back[t, place, label]
            out[k] = path
        return out


def candidate_runs(tokens: list[str]) -> list[tuple[int, int]]:
    """Runs of tokens that can be inside a span."""
    runs, start = [], None
    for i, token in enumerate(tokens):
        if is_candidate(token):
            start = i if start is None else start
        elif start is not None:
            runs.append((start, i))
            start = None
    if start is not None:
        runs.append((start, len(tokens)))
    return runs


def train(table: list[tuple[list[str], list[str]]], steps: int = 150, rate: float = 0.15, decay: float = 1e-3) -> ChainField:
    """Maximum likelihood by forward and backward sums and adaptive gradient steps."""
    runs = [(token_rows, [LABELS.index(l) for l in labels[a:b]]) for tokens, labels in table for a, b in candidate_runs(tokens) for token_rows in [[token_features(tokens, i) for i in range(a, b)]]]
    runs.sort(key=lambda run: -len(run[0]))  # the runs that are longer than t stand first
    names = sorted({f for rows, _ in runs for row in rows for f in row})
    features = {name: i for i, name in enumerate(names)}
    k, longest = len(LABELS), max(len(rows) for rows, _ in runs)
    emit, move = np.zeros((len(names), k)), np.zeros((k, k))
    caches = [np.full_like(emit, 1e-6), np.full_like(move, 1e-6)]
    hot = np.array([(r, t, features[f]) for r, (rows, _) in enumerate(runs) for t, row in enumerate(rows) for f in row])
    truth = np.full((len(runs), longest), -1)
    for r, (_, labels) in enumerate(runs):
        truth[r, : len(labels)] = labels
    mask, lengths = truth >= 0, (truth >= 0).sum(1)
    alive = [int((lengths > t).sum()) for t in range(longest)]
    one = np.eye(k)[np.maximum(truth, 0)] * mask[..., None]
    gold_move = np.zeros((k, k))
    for _, labels in runs:
        for a, b in zip([0, *labels], [*labels, 0]):
            gold_move[a, b] += 1

    def logsum(x, axis):
        top = x.max(axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)

    for _ in range(steps):
        score = np.zeros((len(runs), longest, k))
        np.add.at(score, (hot[:, 0], hot[:, 1]), emit[hot[:, 2]])
        ahead = np.zeros_like(score)
        ahead[:, 0] = move[0] + score[:, 0]
        for t in range(1, longest):
            n = alive[t]
            ahead[:n, t] = logsum(ahead[:n, t - 1, :, None] + move, 1) + score[:n, t]
        behind = np.zeros_like(score)
        behind[np.arange(len(runs)), lengths - 1] = move[:, 0]
        for t in range(longest - 2, -1, -1):
            n = alive[t + 1]
            behind[:n, t] = logsum(move + (score[:n, t + 1] + behind[:n, t + 1])[:, None, :], 2)
        total = logsum(ahead[np.arange(len(runs)), lengths - 1] + move[:, 0], 1)
        likely = np.exp(np.where(mask[..., None], ahead + behind - total[:, None, None], -np.inf))
        expected = np.zeros((k, k))
        expected[0] += likely[:, 0].sum(0)
        expected[:, 0] += likely[np.arange(len(runs)), lengths - 1].sum(0)
        for t in range(1, longest):
            n = alive[t]
            both = np.exp(ahead[:n, t - 1, :, None] + move + (score[:n, t] + behind[:n, t])[:, None, :] - total[:n, None, None])
            expected += both.sum(0)
        slope = np.zeros_like(emit)
        np.add.at(slope, hot[:, 2], (one - likely)[hot[:, 0], hot[:, 1]])
        for weights, gradient, cache in ((emit, slope - decay * emit, caches[0]), (move, gold_move - expected - decay * move, caches[1])):
            cache += gradient**2
            weights += rate * gradient / np.sqrt(cache)
    return ChainField(features, emit, move)


# --- documents --------------------------------------------------------------


def plausible(kind: str, value: str) -> bool:
    """What a span must have, whatever its signs."""
    digits = len(_DIGIT.findall(value))
    return {
        "email": "@" in value[1:-1] and "." in value.partition("@")[2],
        "ip": bool(re.match(r"[0-9]{1,3}(\.[0-9]{1,3}){3}(:[0-9]+)?\Z", value)) and all(int(p) <= 255 for p in value.partition(":")[0].split(".")),
        "card": 14 <= digits <= 19 and luhn("".join(_DIGIT.findall(value))),
        "phone": 10 <= digits <= 15 and not re.search("[A-Za-z@]", value),
    }[kind]


def is_single(kind: str, value: str) -> bool:
    """A plausible value that is surely not put together from others."""
    return plausible(kind, value) and (value.count("@") == 1 if kind == "email" else not any(c.isalpha() for c in value))


def values_in(kind: str, text: str, units: list[tuple[int, int]]) -> list[Span]:
    """Values of the kind in neighbouring units, which are values or pieces of them.

    Of all ways to cut the units the one that leaves the fewest characters of
    them without a value is taken, then the one with the most values.
    """
    best: list[tuple[int, int, tuple[int, int] | None, int]] = [(0, 0, None, 0)]
    for end in range(1, len(units) + 1):
        chosen, held = (*best[end - 1][:2], None, end - 1), 0
        for first in range(end - 1, max(0, end - PIECES) - 1, -1):
            a, b = trimmed(text, units[first][0], units[end - 1][1])
            held += units[first][1] - units[first][0]
            if b > a and is_single(kind, text[a:b]):
                reach = (best[first][0] + held, best[first][1] + 1)
                if reach > chosen[:2]:
                    chosen = (*reach, (a, b), first)
        best.append(chosen)
    found, at = [], len(units)
    while at:
        if span := best[at][2]:
            found.append((*span, kind))
        at = best[at][3]
    return found[::-1]


def trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    while b > a and text[b - 1] in _EDGE:
        b -= 1
    while a < b and text[a] in _EDGE:
        a += 1
    return a, b


def without(taken: list[Span], a: int, b: int) -> Iterator[tuple[int, int]]:
    """What the spans leave of a place; they are in order of their starts."""
    for start, end, _ in taken:
        if start < b and end > a:
            if start > a:
                yield a, start
            a = max(a, end)
    if a < b:
        yield a, b


def field_values(text: str, kind: str, parts: list[tuple[int, int]], taken: list[Span]) -> list[Span]:
    """Values in a run of tokens of one kind, from its parts as labelled; places of ``taken`` are left out.

    Where the base has a piece of a part, only what is left is looked at. Parts
    that are no value by themselves are cut anew, with those like them beside.
    """
    found: list[Span] = []
    loose: list[tuple[int, int]] = []

    def cut_anew() -> None:
        units = [(x.start() + a, x.end() + a) for a, b in loose for x in _UNIT.finditer(text[a:b])]
        found.extend(values_in(kind, text, units))
        loose.clear()

    for part in parts:
        for left in without(taken, *part):
            a, b = trimmed(text, *left)
            if b > a and plausible(kind, text[a:b]) and not (kind == "email" and text[a:b].count("@") > 1):
                cut_anew()
                found.append((a, b, kind))
            else:
                loose.append(left)
            if left[1] < part[1]:
                cut_anew()
    cut_anew()
    return found


def field_spans(texts: list[str], field: ChainField, base: list[list[Span]] | None = None) -> list[list[Span]]:
    """Spans by the random field, in code points, for each text, beside those of ``base``; a long batch is decoded in parts."""
    out: list[list[Span]] = [[] for _ in texts]
    where, feature_rows, cuts = [], [], [0]
    for row, text in enumerate(texts):
        if not ("@" in text or _DIGIT.search(text)):
            continue
        for line in re.finditer(r"[^\n]+", text):
            if not is_candidate(line[0]):
                continue
            marks = list(_TOKEN.finditer(line[0]))
            tokens = [m[0] for m in marks]
            for a, b in candidate_runs(tokens):
                feature_rows += [token_features(tokens, i) for i in range(a, b)]
                cuts.append(len(feature_rows))
                where.append((row, line.start(), marks[a:b]))
    scores = field.scores(feature_rows)
    for (row, offset, marks), path in zip(where, field.decode([scores[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]), strict=True):
        kinds = [(label - 1) % len(KINDS) if label else -1 for label in path.tolist()]
        start = 0
        while start < len(path):
            end = start + 1
            while end < len(path) and kinds[end] == kinds[start]:
                end += 1
            if path[start]:
                begins = [start, *(t for t in range(start + 1, end) if path[t] <= len(KINDS)), end]
                parts = [(offset + marks[a].start(), offset + marks[b - 1].end()) for a, b in zip(begins, begins[1:])]
                low, high = parts[0][0], parts[-1][1]
                taken = [s for s in base[row] if s[0] < high and s[1] > low] if base else []
                out[row] += field_values(texts[row], KINDS[kinds[start]], parts, taken)
            start = end
    return out


def all_spans(texts: list[str], field: ChainField) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text; the field only adds where no base span lies."""
    base = [base_spans(text) for text in texts]
    return [(found, in_order(found + extra)) for found, extra in zip(base, field_spans(texts, field, base), strict=True)]


SLICE = 256


def _found(field: ChainField):
    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), SLICE):
                batch = whole.slice(start, SLICE)
                texts = [text or "" for text in batch.column(1).to_pylist()]
                base, spans = zip(*all_spans(texts, field), strict=True)
                counts = [pa.array([sum(s[2] == kind for s in found) for found in base], pa.int64()) for kind in KINDS]
                digests = pa.array([sha256(listed(found).encode()).hexdigest() for found in base])
                lists = pa.array([listed(found) for found in spans])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *counts, digests, lists], names=[batch.schema.names[0], *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"]
                )

    return apply


def personal_data(docs: DataFrame, field: ChainField | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for each document.

    The counts and the digest are those of the base patterns; ``spans`` lists
    all spans as kind:start:end in code points, ends exclusive, by start and
    kind. Each row gives a row, repeated ones and those without an id too; null
    and empty texts have no spans. Other columns are not looked at.
    """
    schema = T.StructType(
        [T.StructField(id_col, docs.schema[id_col].dataType)]
        + [T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS]
        + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    )
    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(_found(field or train(labelled_table())), schema)
