"""Personal data in texts: patterns, and a semi-Markov conditional random field that adds to them.

The patterns find four kinds of spans. The field scores whole candidate segments by what they look like
from end to end (groups of digits, separators, what stands beside them) and chooses boundaries and kinds
together, by dynamic programming over segments of at most MOST pieces. It is trained on stretches of the texts
themselves in which the patterns' spans are rewritten in ways that the patterns miss (telephone numbers without
a plus sign, in brackets or with dots, addresses with spaces, cards with other separators, addresses of eight
hexadecimal groups), or replaced by dates, times, versions, amounts and serial numbers, which are no personal
data. So it learns what the patterns can't say. It only ever adds spans: those it finds where no pattern's is.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches


KINDS = ["email", "ip", "card", "phone"]

# The patterns of the four kinds. An address starts where its first digits do, which
# keeps the search linear in long runs of digits and finds the same.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_ip(text: str) -> bool:
    parts = [part.lstrip("0") or "0" for part in text.split(".")]
    return all(len(part) <= 3 and int(part) <= 255 for part in parts)


def _is_card(text: str) -> bool:
    return 12 <= len(digits := _digits(text)) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def emails(text: str) -> Iterator[Span]:
    """From each @ leftwards to the start of the address, then the domain: linear also in long runs."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _is_local(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end(), 0
            free = domain.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(free, at + 1))


@cache
def _is_local(char: str) -> bool:
    return bool(re.match(r"[A-Za-z0-9._%+-]", char))


def patterns(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its check, by start and kind."""
    found = list(emails(text)) if "@" in text else []
    if re.search("[0-9]", text):
        for kind, pattern, check in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
            found += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if check(m.group())]
    return sorted(found, key=lambda span: (span[0], span[2]))


# --- the field -------------------------------------------------------------------------------------

_REGION = re.compile(r"[^\x20\x09-\x0D]+")
_PIECE = re.compile(r"[0-9]+|[A-Za-z]+|[^\x20\x09-\x0D]|[\x20\x09-\x0D]")
MOST = 32  # pieces in a segment
LONGEST = 96  # characters in one
MARGIN = 0.5  # log odds by which a segment has to beat plain text
BLOCK = 2048  # pieces whose segments are scored at a time


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of neighbouring words with a digit or @, a single white space apart. Nothing else can hold a segment."""
    start = end = -1
    for hit in re.finditer("[0-9@]", text):
        if hit.start() < end:
            continue
        at = hit.start()
        while at > max(end, 0) and text[at - 1] not in " \t\n\x0b\x0c\r":
            at -= 1
        if start >= 0 and at - end > 1:
            yield start, end
            start = at
        elif start < 0:
            start = at
        end = _REGION.match(text, at).end()
    if start >= 0:
        yield start, end


_HEX = re.compile(r"[0-9A-Fa-f]{0,4}")
_DATE = re.compile(r"[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{2,4}|[0-9]{4}-[0-9]{4}")
_LABEL = re.compile(r"[A-Za-z0-9-]+")


def _hexadecimal(part: str) -> bool:
    """Colons between groups of up to four hexadecimal digits, all eight or some left out once."""
    groups = part.split(":")
    whole = len(groups) == 8 and "" not in groups
    return (whole or (3 <= len(groups) <= 8 and part.count("::") == 1 and ":::" not in part)) and all(map(_HEX.fullmatch, groups))


def features(text: str, start: int, end: int) -> list[int]:
    """Indices of what holds for a segment as a whole."""
    part = text[start:end]
    before, after, then = text[start - 1 : start], text[end : end + 1], text[end + 1 : end + 2]
    runs = [len(run) for run in re.findall("[0-9]+", part)]
    n = sum(runs)
    signs = {c for c in part if not c.isalnum()}
    numeric = n > 0 and not any(c.isalpha() for c in part)
    name, _, domain = part.partition("@")
    mail = part.count("@") == 1 and bool(name.strip()) and bool(domain.strip())
    labels = domain.strip().split(".") if mail else [""]
    host = len(labels) > 1 and all(_LABEL.fullmatch(label) for label in labels) and labels[-1].isalpha()
    dotted = numeric and len(runs) == 4 and part.count(".") == 3 and signs <= {".", " "}
    v6 = ":" in part and _hexadecimal(part)
    card, phone = numeric and 12 <= n <= 19, numeric and 9 <= n <= 15
    tests = (
        True,
        before.isalnum(), after.isalnum(), bool(before) and before in "._%+-/:,(", bool(after) and (after in "-/:@_" or (after in ".," and then.isalnum())),
        mail, mail and host, "@" in part and not (mail and host), mail and " " in name.strip(), mail and " " in domain.strip(),
        dotted and max(runs) <= 3, dotted and max(runs) > 3, v6, v6 and n == 0,
        numeric and bool(_DATE.fullmatch(part)), ":" in part and not v6,
        card, card and luhn(_digits(part)), len(runs) > 2 and set(runs[:-1]) == {4}, numeric and not signs, numeric and len(signs) > 1,
        phone, part[0] == "+", part[0] == "(" and ")" in part, numeric and runs[-3:] == [3, 3, 4], numeric and n == 10, numeric and runs[0] == 4 and runs[0] != n,
        numeric and signs <= set(" ().-+/"), "," in part, len(runs) > 6, part[-1].isdigit(), part[-1].isalpha(),
        not numeric and not mail and not v6, numeric and n < 7, part[0] in "+(" or part[0].isalnum(), numeric and "(" not in part and ")" in part,
        dotted and " " in signs, "_" in signs or "/" in signs, bool(before) and not before.isspace(),
    )
    return [i for i, holds in enumerate(tests) if holds]


FEATURES = 39


class Field:
    """A semi-Markov conditional random field with one vector of weights for each kind; plain text scores 0."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    @staticmethod
    def segments(text: str, first: int = 0, many: int | None = None, cuts: list[int] | None = None):
        """Boundaries between pieces, the candidate segments as pairs of their indices, and their features.

        With ``many`` the segments that begin at so many pieces from ``first`` on.
        """
        cuts = cuts or [m.start() for m in _PIECE.finditer(text)] + [len(text)]
        last = len(cuts) - 1
        solid = [not text[c].isspace() for c in cuts[first : min(last, first + (many or last) + MOST)]]
        pairs = [
            (i, j)
            for i in range(first, min(last, first + (many or last)))
            if solid[i - first]
            for j in range(i + 1, min(i + MOST, last) + 1)
            if solid[j - 1 - first] and 7 <= cuts[j] - cuts[i] <= LONGEST
        ]
        table = np.zeros((len(pairs), FEATURES))
        for row, (i, j) in enumerate(pairs):
            table[row, features(text, cuts[i], cuts[j])] = 1
        return cuts, pairs, table

    def best(self, text: str) -> list[Span]:
        """The spans of the most likely segmentation that beat plain text by MARGIN each.

        Segments are scored block by block, of which only those better than plain text are kept; the choice is one
        over the whole text, so where the blocks meet makes no difference.
        """
        cuts = [m.start() for m in _PIECE.finditer(text)] + [len(text)]
        ending: dict[int, list[tuple[int, float, int]]] = {}
        for first in range(0, len(cuts) - 1, BLOCK):
            _, pairs, table = self.segments(text, first, BLOCK, cuts)
            if not pairs:
                continue
            scores = table @ self.weights.T
            kinds, tops = scores.argmax(axis=1), scores.max(axis=1) - MARGIN
            for row in np.flatnonzero(tops > 0).tolist():
                i, j = pairs[row]
                ending.setdefault(j, []).append((i, float(tops[row]), int(kinds[row])))
        if not ending:
            return []
        value, back = [0.0] * len(cuts), [(-1, -1)] * len(cuts)
        for j in range(1, len(cuts)):
            value[j] = value[j - 1]
            for i, top, kind in ending.get(j, ()):
                if value[i] + top > value[j]:
                    value[j], back[j] = value[i] + top, (i, kind)
        found, j = [], len(cuts) - 1
        while j > 0:
            i, kind = back[j]
            if i < 0:
                j -= 1
            else:
                found.append((cuts[i], cuts[j], kind))
                j = i
        return found[::-1]

    @classmethod
    def trained(cls, labelled: list[tuple[str, list[Span]]], rounds: int = 20, rate: float = 0.5, decay: float = 1e-3) -> Field:
        """From texts with their spans, by the gradient of the likelihood (forwards and backwards over segments), with adaptive steps."""
        weights, squares = np.zeros((len(KINDS), FEATURES)), np.full((len(KINDS), FEATURES), 1e-6)
        prepared = []
        for text, spans in labelled:
            cuts, pairs, table = cls.segments(text)
            if pairs:
                place = {pair: row for row, pair in enumerate(pairs)}
                at = {c: i for i, c in enumerate(cuts)}
                gold = [(place.get((at.get(a), at.get(b))), k) for a, b, k in _apart(spans)]
                prepared.append((len(cuts), np.array(pairs), table, [g for g in gold if g[0] is not None]))
        random = np.random.default_rng(len(prepared))
        for _ in range(rounds):
            for k in random.permutation(len(prepared)):
                n, pairs, table, gold = prepared[k]
                expected = _marginals(n, pairs, table @ weights.T)
                wanted = np.zeros_like(expected)
                for row, kind in gold:
                    wanted[row, kind] = 1
                step = (wanted - expected).T @ table - decay * weights
                squares += step**2
                weights += rate * step / np.sqrt(squares)
        return cls(weights)


def _apart(spans: list[Span]) -> list[Span]:
    """Spans that do not overlap, of overlapping ones the first."""
    out: list[Span] = []
    for span in spans:
        if not out or span[0] >= out[-1][1]:
            out.append(span)
    return out


def _marginals(n: int, pairs: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Probability of each segment and kind."""
    inside = np.logaddexp.reduce(scores, axis=1)
    starts, ends = pairs[:, 0].tolist(), pairs[:, 1].tolist()
    by_end: list[list[int]] = [[] for _ in range(n)]
    by_start: list[list[int]] = [[] for _ in range(n)]
    for row, (i, j) in enumerate(zip(starts, ends, strict=True)):
        by_end[j].append(row)
        by_start[i].append(row)
    ahead, behind = np.zeros(n), np.zeros(n)
    for j in range(1, n):
        ahead[j] = np.logaddexp.reduce([ahead[j - 1]] + [ahead[starts[r]] + inside[r] for r in by_end[j]])
    for i in range(n - 2, -1, -1):
        behind[i] = np.logaddexp.reduce([behind[i + 1]] + [behind[ends[r]] + inside[r] for r in by_start[i]])
    return np.exp(ahead[pairs[:, 0]][:, None] + scores + behind[pairs[:, 1]][:, None] - ahead[-1])


def _number(random: Random, digits: int) -> str:
    return str(random.randint(1, 9)) + "".join(str(random.randint(0, 9)) for _ in range(digits - 1))


def variant(kind: int, part: str, random: Random) -> str:
    """A span of a kind as people also write it, mostly so that the patterns miss it."""
    if kind == 0:
        name, _, domain = part.partition("@")
        return random.choice([f"{name} @ {domain}", f"{name}@ {domain}", f"{name} @{domain}", part])
    if kind == 1:
        if random.random() < 0.3:
            return random.choice([". ", " .", "."]).join(part.split("."))
        groups = [f"{random.randrange(1 << random.choice([4, 8, 16, 16])):{random.choice(['x', '04x'])}}" for _ in range(8)]
        low = random.randint(1, 5)
        short = ":".join(groups[:low]) + "::" + ":".join(groups[low : low + random.randint(1, 7 - low)])
        return random.choice([":".join(groups), short]) if len(short) > 6 else ":".join(groups)
    digits = _digits(part)
    if kind == 2:
        sign = random.choice([".", "/", "_", ". ", "", "-"])
        return sign.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    country, (a, b, c) = random.choice(["1", "44", "49", "33"]), (digits[-10:-7], digits[-7:-4], digits[-4:])
    a = a if len(a) == 3 else _number(random, 3)
    own = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"({a}) {b} {c}", f"{a}/{b}-{c}"]
    abroad = [f"00{country} {a} {b} {c}", f"{country}-{a}-{b}-{c}", f"+{country}/{a}/{b}-{c}", f"{country} ({a}) {b}-{c}", f"+{country} ({a}) {b}-{c}"]
    return random.choice(own + abroad)


def decoy(random: Random) -> str:
    """Something of digits and signs that is no personal data."""
    year, month, day = random.randint(1900, 2030), random.randint(1, 12), random.randint(1, 28)
    serial = _number(random, random.randint(12, 19))
    while luhn(serial):
        serial = _number(random, random.randint(12, 19))
    return random.choice(
        [
            f"{year}-{month:02}-{day:02}", f"{day:02}/{month:02}/{year}", f"{day}.{month}.{year}", f"{year}-{year + 9}",
            f"{day % 24:02}:{random.randint(0, 59):02}:{random.randint(0, 59):02}", f"{day % 24:02}:{random.randint(0, 59):02}",
            f"{random.randint(0, 9)}.{random.randint(0, 40)}.{random.randint(0, 9)}", f"v{random.randint(0, 9)}.{random.randint(10, 40)}-rc{day}",
            f"{random.randint(1, 999)},{_number(random, 3)},{_number(random, 3)}", f"{_number(random, 6)}.{day:02}", serial, _number(random, random.randint(7, 9)),
            f"{_number(random, 4)} {_number(random, 4)}", f"{_number(random, 3)} {_number(random, 3)}", f"@{random.choice('abc')}{_number(random, 6)}",
            f"{_number(random, 2)}:{_number(random, 3)}-{_number(random, 3)}", f"978-{day % 9}-{_number(random, 2)}-{_number(random, 6)}-{month % 10}",
        ]
    )


def rewritten(text: str, random: Random, keep: bool) -> tuple[str, list[Span]]:
    """A text with the patterns' spans as variants, labelled, or (not ``keep``) as decoys, unlabelled."""
    out, spans, at, size = [], [], 0, 0
    for start, end, kind in _apart(patterns(text)):
        part = variant(kind, text[start:end], random) if keep else decoy(random)
        out += [text[at:start], part]
        size += start - at
        if keep:
            spans.append((size, size + len(part), kind))
        size += len(part)
        at = end
    return "".join(out) + text[at:], spans


def labelled(stretches: list[str], seed: int = 7, times: int = 4) -> list[tuple[str, list[Span]]]:
    """Each stretch as it is, labelled by the patterns, and several times rewritten with variants and with decoys."""
    random = Random(seed)
    out = [(text, patterns(text)) for text in stretches]
    for text, spans in list(out):
        if spans:
            out += [rewritten(text, random, keep) for _ in range(times) for keep in (True, False)]
    return out


def sample(docs: DataFrame, text_col: str, rows: int, stretches: int, longest: int = 160, each: int = 20) -> list[str]:
    """At most ``stretches`` stretches of up to ``longest`` characters, from about ``rows`` texts picked by hash.

    Of a text the first ``each`` stretches count. All four bounds hold for the training alone.
    """

    text_batches(docs.sparkSession)

    @F.arrow_udf("array<string>")
    def found(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            out.append([text[max(a - 1, 0) : b + 1] for a, b in regions(text or "") if b - a <= longest][:each])
        return pa.array(out, pa.list_(pa.string()))

    total = max(docs.count(), 1)
    picked = docs.where(F.pmod(F.xxhash64(text_col), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1, rows / total))))
    parts = picked.select(F.explode(found(F.col(text_col))).alias("part")).distinct()
    return [row.part for row in parts.orderBy(F.xxhash64("part"), "part").limit(stretches).collect()]


def spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Spans of the patterns, and these with what the field adds."""
    base = patterns(text)
    added = []
    for a, b in regions(text):
        if b - a >= 7:
            low, high = max(a - 1, 0), min(b + 1, len(text))
            added += [(s + low, e + low, k) for s, e, k in field.best(text[low:high])]
    taken: list[list[int]] = []  # what the patterns cover
    for s, e, _ in base:
        if taken and s < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([s, e])
    ends = [e for _, e in taken]
    fresh = []
    for s, e, k in _apart(sorted(added)):
        after = bisect_right(ends, s)
        if after == len(ends) or e <= taken[after][0]:
            fresh.append((s, e, k))
    return base, sorted(base + fresh, key=lambda span: (span[0], span[2]))


def _joined(found: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in found)


def train(docs: DataFrame, text_col: str = "text", rows: int = 5_000, stretches: int = 400) -> Field:
    """A field from a bounded sample of the texts, labelled and rewritten as ``labelled`` says; both bounds are parameters."""
    return Field.trained(labelled(sample(docs, text_col, rows, stretches)))


def found(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: ``doc_id, n_email, n_ip, n_card, n_phone`` (of the patterns), ``base, spans``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind, joined by commas.
    A null text is empty and has none; of two spans of one kind none overlap. A stretch of any length is
    segmented as a whole. Repeated rows count each; an empty table gives no rows. Other columns are not read.
    """

    text_batches(docs.sparkSession)

    @F.arrow_udf("struct<n_email:bigint,n_ip:bigint,n_card:bigint,n_phone:bigint,base:string,spans:string>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for value in texts:
                base, every = spans(value.as_py() or "", field)
                counts = [sum(k == kind for _, _, k in base) for kind in range(len(KINDS))]
                out.append([*counts, _joined(base), _joined(every)])
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.StructArray.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
                ["n_email", "n_ip", "n_card", "n_phone", "base", "spans"],
            )

    return docs.select(F.col(id_col).alias("doc_id"), find(F.col(text_col)).alias("f")).select("doc_id", "f.*")


def redacted(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets."""

    text_batches(docs.sparkSession)

    @F.arrow_udf("string")
    def redact(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            parts, at = [], 0
            for start, end, kind in _apart(spans(text, field)[1]) if text else ():
                parts += [text[at:start], f"<{KINDS[kind]}>"]
                at = end
            out.append(None if text is None else "".join(parts) + text[at:])
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, redact(F.col(text_col)))
