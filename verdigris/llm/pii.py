"""Personal data by weak supervision.

Candidate spans get votes from four kinds of labelers: patterns, gazetteers, context words and checks.
No labeler knows which spans the base patterns took: a span that they miss gets the votes of its like.
Expectation-maximisation over the vote patterns of the whole table estimates how reliable each labeler
is and how likely each pattern is personal data. A logistic regression on the votes and the shape of a
span is trained on these likelihoods; it decides on the spans that the base patterns leave out.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigris.llm.common import SLICE, slices, text_of
from verdigris.sources.storage import stored

# The kinds in the order in which spans are listed, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# Looser patterns that only propose candidates.
_LOOSE = {
    "email": re.compile(r"(?<!\w)[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?[(\[]at[)\]] ?[A-Za-z0-9-]+(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]+)+", re.I),
    "ip": re.compile(r"(?<![\w.])[0-9]{1,3}(?:[.\-_][0-9]{1,3}){3}(?![\w.])"),
    "card": re.compile(r"(?<![\w.+-])[0-9]{4}(?:[ .\-_]?[0-9]{4}){2}[ .\-_]?[0-9]{3,4}(?![\w-])"),
    "phone": re.compile(r"(?<![\w.+-])(?:(?:\+|00)[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![\w-])"),
}
# Gazetteers, and words that stand before a span of the kind.
_TOP_DOMAINS = frozenset("com org net edu gov mil int io de fr es uk us it nl eu info biz co".split())
_CONTEXT = {
    "email": "email e-mail mail contact write".split(), "ip": "ip address host server login".split(),
    "card": "card visa mastercard credit debit payment pan".split(), "phone": "phone tel telephone call mobile fax cell".split(),
}
CONTEXT_CHARS = 40
# Reliabilities of the checks, as yes for personal data and for the rest. They are given and not estimated: of
# random digits one in ten has a right check digit, and what is no four bytes is no address.
_CHECKS = {"email": (0.9, 0.1), "ip": (0.999, 0.1), "card": (0.999, 0.1), "phone": (0.99, 0.1)}
# A proposed span is taken when its likelihood is at least this. The planted cases of test_pii.py have 0.91 and more,
# the decoys there 0.4 and less.
TAKE_FROM = 0.9


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From mark to mark, so that long runs without one cost nothing."""
    free, mark = 0, text.find("@")
    while mark >= 0:
        start = mark
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, mark + 1) if start < mark else None
        if found:
            yield start, found.end()
            free = found.end()
        mark = text.find("@", max(mark + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind and start."""
    spans = [(0, start, end) for start, end in _emails(text)]
    if not _DIGIT.search(text):
        return spans
    for found in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in found.group().split(".")):
            spans.append((1, *found.span()))
    for found in _CARD.finditer(text):
        digits = found.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *found.span()))
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 8 <= sum(letter in "0123456789" for letter in found.group()) <= 15:
                spans.append((3, *found.span()))
    return spans


def _context_vote(text: str, start: int, kind: str) -> str:
    """1 with a word of the kind, 0 with a word of another kind, - with neither."""
    before = set(re.findall(r"[a-z-]+", text[max(0, start - CONTEXT_CHARS) : start].lower()))
    if before & set(_CONTEXT[kind]):
        return "1"
    return "0" if any(before & set(words) for other, words in _CONTEXT.items() if other != kind) else "-"


def _gazetteer_vote(span: str, kind: str) -> str:
    digits = "".join(letter for letter in span if letter in "0123456789")
    if kind == "email":
        return "1" if re.split(r"[^A-Za-z0-9]+", span.rstrip(")]"))[-1].lower() in _TOP_DOMAINS else "0"
    if kind == "ip":
        first = int(re.split(r"[^0-9]", span)[0][-4:])
        return "0" if first in (0, 255) or first > 255 else "1"
    if kind == "card":
        return "1" if digits[0] in "3456" else "0"
    return "0" if digits[0] == "0" and not digits.startswith("00") else "-"


def _pattern_vote(span: str, kind: str) -> str:
    return "1" if kind == "email" and "@" in span or _LOOSE[kind].fullmatch(span) else "0"


def _check_vote(span: str, kind: str) -> str:
    """What the form proves: the mark of an address, four bytes with dots, the check digit, a country code."""
    if kind == "email":
        return "1" if "@" in span else "0"
    if kind == "ip":
        parts = span.split(".")
        return "1" if len(parts) == 4 and all(part.isdigit() and len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in parts) else "0"
    if kind == "card":
        return "1" if luhn("".join(letter for letter in span if letter in "0123456789")) else "0"
    return "1" if span.startswith(("+", "00")) else "0"


def _shape(span: str, kind: str) -> str:
    """Which separators a span has, and for cards whether the check digit is right."""
    separators = "".join(mark for mark in " .-_()[" if mark in span)
    valid = ""
    if kind == "card":
        valid = "v" if luhn("".join(letter for letter in span if letter in "0123456789")) else "x"
    return f"{separators}{valid}"


def signature(text: str, start: int, end: int, kind: str) -> str:
    """kind:votes:shape. Votes are those of pattern, gazetteer, context and check labeler."""
    span = text[start:end]
    votes = _pattern_vote(span, kind) + _gazetteer_vote(span, kind) + _context_vote(text, start, kind) + _check_vote(span, kind)
    return f"{kind}:{votes}:{_shape(span, kind)}"


def _loose_spans(text: str, kind: str) -> list[tuple[int, int]]:
    """Spans of the loose pattern that do not overlap; of cards that do, those with a right check digit go first."""
    pattern = _LOOSE[kind]
    if kind != "card":
        return [match.span() for match in pattern.finditer(text)]
    found, match = [], pattern.search(text)
    while match:
        found.append(match)
        match = pattern.search(text, match.start() + 1)
    found.sort(key=lambda match: (_check_vote(match.group(), kind) != "1", match.start()))
    spans: list[tuple[int, int]] = []
    for match in found:
        at = bisect.bisect(spans, match.span())
        if (not at or spans[at - 1][1] <= match.start()) and (at == len(spans) or match.end() <= spans[at][0]):
            spans.insert(at, match.span())
    return spans


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, bool]]:
    """(kind, start, end, signature, base): base spans, and looser ones that overlap none of them."""
    found = [(kind, start, end, signature(text, start, end, KINDS[kind]), True) for kind, start, end in base]
    digit = _DIGIT.search(text)
    taken = sorted((start, end) for _, start, end in base)
    for kind, name in enumerate(KINDS):
        if not digit and name != "email" or name == "email" and not re.search(r"[(\[]at[)\]]", text, re.I):
            continue
        for start, end in _loose_spans(text, name):
            if all(end <= a or start >= b for a, b in taken):
                found.append((kind, start, end, signature(text, start, end, name), False))
    return found


def _votes(row: str) -> np.ndarray:
    """1, 0 or nan for each labeler."""
    return np.array([{"1": 1.0, "0": 0.0}.get(vote, np.nan) for vote in row.split(":")[1]])


def estimate(counts: dict[str, int], rounds: int = 100) -> dict[str, float]:
    """Likelihood of personal data by signature: two classes, labelers independent given the class.

    Starts from labelers that are right in four of five cases. Each kind has reliabilities of its own;
    those of the check, the fourth vote, are given.
    """
    likely: dict[str, float] = {}
    for kind in KINDS:
        rows = sorted(row for row in counts if row.startswith(f"{kind}:"))
        if not rows:
            continue
        votes = np.stack([_votes(row) for row in rows])
        weight = np.array([counts[row] for row in rows], float)
        given = ~np.isnan(votes)
        cast = np.nan_to_num(votes)
        labelers = votes.shape[1]
        share, hit, alarm = 0.5, np.full(labelers, 0.8), np.full(labelers, 0.2)
        for _ in range(rounds):
            if labelers > 3:
                hit[3], alarm[3] = _CHECKS[kind]
            yes = np.log(share) + (given * (cast * np.log(hit) + (1 - cast) * np.log(1 - hit))).sum(1)
            no = np.log(1 - share) + (given * (cast * np.log(alarm) + (1 - cast) * np.log(1 - alarm))).sum(1)
            chance = 1 / (1 + np.exp(np.clip(no - yes, -50, 50)))
            p, q = weight * chance, weight * (1 - chance)
            # A table with one class only says nothing about the other, which stays possible.
            share = np.clip((p.sum() + 1) / (weight.sum() + 2), 0.05, 0.95)
            # Four pseudo-votes keep a labeler from being called perfect on little evidence.
            hit = np.clip(((p[:, None] * given * cast).sum(0) + 3.2) / ((p[:, None] * given).sum(0) + 4), 0.5, 0.99)
            alarm = np.clip(((q[:, None] * given * cast).sum(0) + 0.8) / ((q[:, None] * given).sum(0) + 4), 0.01, 0.5)
        likely |= dict(zip(rows, map(float, chance)))
    return likely


def _design(row: str) -> dict[str, float]:
    """Features of a signature: kind with each vote, and kind with each mark of the shape."""
    kind, votes, shape = row.split(":")
    named = {f"{kind}/{place}/{vote}": 1.0 for place, vote in enumerate(votes)}
    return named | {f"{kind}/shape/{mark}": 1.0 for mark in shape} | {kind: 1.0}


def train_span_classifier(counts: dict[str, int], likely: dict[str, float], steps: int = 2000) -> dict[str, float]:
    """Likelihood by signature from a logistic regression trained on the estimated likelihoods.

    It sees one row per signature, weighted by the root of its count so that rare ones still speak.
    """
    rows = sorted(counts)
    if not rows:
        return {}
    names = sorted({name for row in rows for name in _design(row)})
    design = np.array([[_design(row).get(name, 0.0) for name in names] for row in rows])
    weight = np.sqrt([counts[row] for row in rows])
    weight /= weight.sum()
    target = np.array([likely[row] for row in rows])
    at = np.zeros(len(names))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -50, 50)))
        at -= 2.0 * (design.T @ (weight * (p - target)) + 1e-4 * at)
    p = 1 / (1 + np.exp(-np.clip(design @ at, -50, 50)))
    return dict(zip(rows, map(float, p)))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, by kind and start, joined by commas."""
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ","
    )


_CANDIDATES = "array<struct<kind:int,start:int,end:int,signature:string,base:boolean>>"


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) per row; a span is (kind, start, end, base, likelihood), in code points.

    Base spans always stay. Added spans never overlap them or each other within a kind. Null and
    empty texts have none. Ids may be null or repeated. The texts are read once; candidates are
    written to shared storage and the driver sees only counts by signature, whose number is bounded
    by the votes and shapes there are.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("signature", pa.string()), ("base", pa.bool_())])
    names = [field.name for field in span]

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            found = [
                [dict(zip(names, row)) for row in candidates(text, base_spans(text))]
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(span))], ["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col))
    proposed = stored(rows.mapInArrow(propose, f"id {kind}, spans {_CANDIDATES}"), "pii-candidates")
    signatures = proposed.select(F.explode("spans.signature").alias("signature")).groupBy("signature").count()
    counts = {row.signature: row["count"] for row in signatures.collect()}
    likely = train_span_classifier(counts, estimate(counts)) if counts else {}
    pairs = [F.lit(item) for pair in likely.items() for item in pair]
    chance = F.create_map(*pairs) if pairs else F.create_map(F.lit(""), F.lit(0.0))
    taken = F.filter(
        F.transform("spans", lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"),
            F.coalesce(chance[s["signature"]], F.lit(0.0)).alias("likelihood"),
        )),
        lambda s: s["base"] | (s["likelihood"] >= TAKE_FROM),
    )
    return proposed.select(F.col("id").alias(id_col), F.array_sort(taken).alias("spans"))


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first stays."""
    parts, free = [], 0
    for kind, start, end in sorted(spans, key=lambda span: (span[1], -span[2])):
        if start >= free:
            parts += [text[free:start], f"[{KINDS[kind]}]"]
            free = end
    return "".join([*parts, text[free:]])
