r"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

*Base spans* (always found): e-mail addresses, IP numbers, payment cards that pass the Luhn sum,
phone numbers with a plus sign; leftmost and non-overlapping per kind.

*Candidates* are the base matches, numbers that fail their check, and looser forms: addresses with
"at" and "dot" spelled out, phone numbers grouped without a plus sign, digit groups separated by
dots or slashes that pass the Luhn sum, and cards and phone numbers that a failing match holds
together with the digits after them.

*Labelers* vote 1 (personal), -1 (not) or 0 (abstain) on each candidate: the strict pattern and
checksum, the shape, a gazetteer (top-level domains, card and area prefixes, reserved networks),
the words to the left, and the characters on either side.

*Model.* Votes and a few small features make one of a bounded number of patterns per kind
(``PATTERNS``), whatever the corpus holds. Spark counts them over all documents; expectation
maximisation on the counts estimates each labeler's reliabilities and a posterior per pattern, and
a logistic regression on votes and features, with the posteriors as soft labels, is the span
classifier. A candidate that is no base span is added from ``THRESHOLD`` on unless it overlaps a
base span or an earlier one.

Texts are read twice, once for the counts and once for the spans; nothing is stored between.
Spans are code points, end exclusive. Defined cases: a null or empty text has no spans; null ids
and repeated rows are rows like any other; a corpus without candidates has no model and no
spans; empty tables give empty results; ``redact`` keeps all other columns as they are and a null
text null.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import extended, lean, small_batches, text_or_empty
from meterline.llm.quality_bayes import logistic

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("strict", "shape", "gazetteer", "words", "edges")
# Votes, three states of separators and four of length, for each kind.
PATTERNS = len(KINDS) * 3 ** len(LABELERS) * 3 * 4
THRESHOLD = 0.7
EM_ROUNDS = 200
# Counts that the priors of a labeler's reliabilities weigh, whatever the corpus holds.
PRIOR, STRICT_PRIOR = 20, 200

# Runs are consumed whole, so a search never starts twice inside one and takes linear time.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)?")
_IP = re.compile(r"[0-9]+(\.[0-9]+\.[0-9]+\.[0-9]+)?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?"
    r"[A-Za-z0-9-]{1,63}(?:\x20?(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}){1,4}(?![A-Za-z0-9-])")
_GROUPED_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9]|[.-][0-9])")
_GROUPED_CARD = re.compile(r"(?<![0-9./])[0-9]{4}([./])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9./])")
# A number that other digits follow, so that the match as a whole is too long.
_PLUS_PHONE = re.compile(r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{3}\)|[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])")
_LONE_CARD = re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])")
_DIGIT = re.compile(r"[0-9]")

# Gazetteers: common top-level domains, first digits of card schemes.
_DOMAINS = frozenset("com org net edu gov mil int info biz io co ai app dev me uk de fr es it nl be ch at pl pt se no dk fi ie eu us ca au nz jp cn in br mx ru".split())
_SCHEMES = ("4", "5", "34", "37", "6", "2")
_WORDS = {
    "email": (re.compile(r"mail|contact|write|reach|address|correo", re.I), re.compile(r"package|commit|handle", re.I)),
    "ip": (re.compile(r"\bip\b|host|server|network|login|address|client", re.I), re.compile(r"version|release|section|chapter|\bv$", re.I)),
    "card": (re.compile(r"card|visa|credit|debit|payment|mastercard|amex|tarjeta|carte|karte", re.I),
             re.compile(r"isbn|order|invoice|serial|tracking|\bref|\bid\b|sku", re.I)),
    "phone": (re.compile(r"phone|\btel|call|fax|mobile|whatsapp|number|t[eé]l[eé]", re.I), re.compile(r"isbn|order|invoice|serial|version|\bid\b", re.I)),
}
_BEFORE = 32


@dataclass
class Candidate:
    kind: int
    begin: int
    end: int
    base: bool
    votes: tuple[int, ...] = field(default=())
    separators: int = 0
    length: int = 0


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        n = ord(digit) - 48
        if k % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _small(part: str) -> bool:
    """Whether a run of digits is 255 at most; runs may be very long."""
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def candidates(text: str, loose: bool = True) -> list[Candidate]:
    """Candidates of a text, by kind, then place; with ``loose`` off the base spans alone."""
    found: list[Candidate] = []
    if "@" in text:
        found += [Candidate(0, m.start(), m.end(), True) for m in _EMAIL.finditer(text) if m[1]]
    if loose and ("[at]" in text or "(at)" in text or " at " in text and " dot " in text):
        found += [Candidate(0, m.start(), m.end(), False) for m in _SPELLED.finditer(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text) if "." in text else ():
            if m[1]:
                ok = all(map(_small, m[0].split(".")))
                if ok or loose:
                    found.append(Candidate(1, m.start(), m.end(), ok))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _digits(m[0])
                ok = 13 <= len(digits) <= 19 and luhn(digits)
                if ok or loose and len(digits) <= 19:
                    found.append(Candidate(2, m.start(), m.end(), ok))
                if loose and not ok:
                    found += [Candidate(2, n.start(), n.end(), False) for n in _LONE_CARD.finditer(text, m.start(), m.end()) if luhn(_digits(n[0]))]
        if loose:
            found += [Candidate(2, m.start(), m.end(), False) for m in _GROUPED_CARD.finditer(text) if luhn(_digits(m[0]))]
        for m in _PHONE.finditer(text) if "+" in text else ():
            ok = 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15
            if ok:
                found.append(Candidate(3, m.start(), m.end(), ok))
            elif loose:
                found += [Candidate(3, n.start(), n.end(), False) for n in _PLUS_PHONE.finditer(text, m.start(), m.end())]
        if loose:
            found += [Candidate(3, m.start(), m.end(), False) for m in _GROUPED_PHONE.finditer(text)]
    found.sort(key=lambda c: (c.kind, c.begin, not c.base, -c.end))
    return found


def label(text: str, c: Candidate) -> Candidate:
    """Add the labelers' votes and the features."""
    value = text[c.begin:c.end]
    digits = _digits(value)
    left = text[max(0, c.begin - _BEFORE):c.begin]
    outer = text[c.begin - 1:c.begin], text[c.end:c.end + 1]
    shape = gazetteer = 0
    strict = 1 if c.base else -1 if c.kind in (1, 2) and not (c.kind == 2 and luhn(digits)) else 0
    if c.kind == 0:
        name, _, domain = value.partition("@")
        ending = re.split(r"[.\]) ]", value)[-1].lower()
        gazetteer = 1 if ending in _DOMAINS else -1 if ending.isdigit() else 0
        shape = (1 if not name.startswith(".") and ".." not in value and not domain.startswith("-") else -1) if domain else 1 if "[at]" in value or "(at)" in value else -1
    elif c.kind == 1:
        parts = value.split(".")
        plain = all(part == "0" or not part.startswith("0") for part in parts)
        shape = 1 if plain and all(map(_small, parts)) else -1
        gazetteer = -1 if parts[0] in ("0", "00") else 1 if _small(parts[0]) and len(parts[0]) >= 2 else 0
    elif c.kind == 2:
        groups = re.split(r"[^0-9]+", value)
        shape = -1 if len(set(digits)) < 3 else 1 if len(groups) == 1 or len(groups[0]) == 4 and len(groups) <= 5 else -1
        gazetteer = 1 if digits.startswith(_SCHEMES) else -1
    else:
        shape = 1 if value.count("(") == value.count(")") and len(set(digits)) > 2 else -1
        area = digits[-10:-7]
        gazetteer = 1 if 10 <= len(digits) <= 13 and area[:1] not in ("0", "1") else -1 if len(digits) < 9 else 0
    good, bad = _WORDS[KINDS[c.kind]]
    words = -1 if bad.search(left) else 1 if good.search(left) else 0
    joined = any(x.isalnum() or x in ("_", "=", "/", "#") for x in outer if x)
    edges = -1 if joined else 1
    c.votes = (strict, shape, gazetteer, words, edges)
    c.separators = min(2, sum(not x.isalnum() for x in value))
    c.length = min(3, (c.end - c.begin) // 8)
    return c


def _row(pattern: tuple[int, ...]) -> list[float]:
    """Regression columns of a pattern (kind, votes, separators, length)."""
    kind, votes, rest = pattern[0], pattern[1:6], pattern[6:]
    return [*(float(kind == k) for k in range(1, len(KINDS))), *(float(v == 1) for v in votes), *(float(v == -1) for v in votes),
            *(float(rest[0] == k) for k in (1, 2)), *(float(rest[1] == k) for k in (1, 2, 3))]


def pattern_of(c: Candidate) -> tuple[int, ...]:
    return (c.kind, *c.votes, c.separators, c.length)


def count_patterns(docs: DataFrame, text: str = "text") -> DataFrame:
    """How often each pattern occurs: columns kind, votes, separators, length as ``p0`` to ``p7``, and n."""
    width = 3 + len(LABELERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task's counts have one entry per pattern at most.
        counts: dict[tuple[int, ...], int] = {}
        for batch in batches:
            for value in batch.column(0):
                body = value.as_py()
                for c in candidates(body):
                    pattern = pattern_of(label(body, c))
                    counts[pattern] = counts.get(pattern, 0) + 1
        rows = np.array([(*p, n) for p, n in counts.items()], np.int64).reshape(len(counts), width + 1)
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, k]) for k in range(width + 1)], names=[*(f"p{k}" for k in range(width)), "n"])

    names = [f"p{k}" for k in range(width)]
    counted = small_batches(docs).select(text_or_empty(text).alias("text")).mapInArrow(lean(run), ", ".join(f"{name} long" for name in [*names, "n"]))
    return counted.groupBy(*names).agg(F.sum("n").alias("n"))


def expectation_maximisation(votes: np.ndarray, n: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of each vote pattern, reliabilities [labeler, class, vote + 1] and the share of class 1.

    Labelers are independent given the class. The first labeler, the strict check, starts the
    classes; the others break its ties. A few prior counts (``PRIOR`` of the others, ``STRICT_PRIOR`` of the strict
    one, as a failed checksum is near proof) keep the classes named as meant when one of them is
    rare; beyond them the data decide every labeler's reliability.
    """
    priors = [np.array([[0.5, 0.3, 0.2], [0.2, 0.3, 0.5]]) * PRIOR] * votes.shape[1]
    priors[0] = np.array([[0.94, 0.05, 0.01], [0.01, 0.24, 0.75]]) * STRICT_PRIOR
    posterior = np.clip(0.5 + 0.45 * votes[:, 0] + (votes[:, 0] == 0) * votes.sum(axis=1) / (2 * votes.shape[1]), 0.02, 0.98)
    reliability, share = np.empty((votes.shape[1], 2, 3)), 0.5
    for _ in range(rounds):
        weight = np.stack([(1 - posterior) * n, posterior * n])
        for j in range(votes.shape[1]):
            counts = np.stack([[weight[y][votes[:, j] == v].sum() for v in (-1, 0, 1)] for y in (0, 1)]) + priors[j]
            reliability[j] = counts / counts.sum(axis=1, keepdims=True)
        share = (weight[1].sum() + 10) / (n.sum() + 20)
        log = np.log([1 - share, share])[:, None] + sum(
            np.log(reliability[j][:, votes[:, j] + 1]) for j in range(votes.shape[1]))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        if np.abs(new - posterior).max() < 1e-9:
            return new, reliability, share
        posterior = new
    return posterior, reliability, share


class SpanModel:
    """The span classifier; a probability is computed once per pattern and process."""

    def __init__(self, weights: np.ndarray) -> None:
        self.weights = weights
        self._known: dict[tuple[int, ...], float] = {}

    def probability(self, pattern: tuple[int, ...]) -> float:
        if pattern not in self._known:
            odds = float(self.weights[0] + np.array(_row(pattern)) @ self.weights[1:])
            self._known[pattern] = 1 / (1 + np.exp(-max(-30.0, min(30.0, odds))))
        return self._known[pattern]


def fit(docs: DataFrame, text: str = "text") -> SpanModel | None:
    """The span classifier of a corpus; None without candidates.

    At most ``PATTERNS`` rows of counts reach the driver.
    """
    rows = np.array([tuple(row) for row in count_patterns(docs, text).orderBy(*(f"p{k}" for k in range(8))).collect()], np.int64)
    if not len(rows):
        return None
    posterior = np.empty(len(rows))
    for kind in range(len(KINDS)):
        mine = rows[:, 0] == kind
        if mine.any():
            posterior[mine] = expectation_maximisation(rows[mine, 1:6], rows[mine, 8].astype(float))[0]
    x = np.array([_row(tuple(row[:8])) for row in rows.tolist()])
    # The posterior is a soft label. Counts enter by their logarithm, so that the classifier
    # learns the votes and features and not the most frequent pattern alone.
    return SpanModel(logistic(x, posterior, weight=np.log1p(rows[:, 8])))


class _Taken:
    """Disjoint intervals in ascending order."""

    def __init__(self) -> None:
        self.begins: list[int] = []
        self.ends: list[int] = []

    def add(self, begin: int, end: int) -> None:
        """An interval that begins no earlier than any before; one that overlaps the last extends it."""
        if self.ends and begin < self.ends[-1]:
            self.ends[-1] = max(self.ends[-1], end)
        else:
            self.begins.append(begin)
            self.ends.append(end)

    def meets(self, begin: int, end: int) -> bool:
        place = bisect_right(self.ends, begin)
        return place < len(self.begins) and self.begins[place] < end


def spans(text: str, model: SpanModel | None) -> list[Candidate]:
    """Base spans and those the model adds, by kind and place.

    Candidates of a kind come in order of place, so what a kind has added is in order too, and a candidate is held against
    the base spans and each kind's additions by bisection.
    """
    found = candidates(text, loose=model is not None)
    base = [c for c in found if c.base]
    taken = [_Taken() for _ in range(len(KINDS) + 1)]
    for c in sorted(base, key=lambda c: c.begin):
        taken[-1].add(c.begin, c.end)
    for c in found:
        if not c.base and model.probability(pattern_of(label(text, c))) >= THRESHOLD and not any(t.meets(c.begin, c.end) for t in taken):
            base.append(c)
            taken[c.kind].add(c.begin, c.end)
    return sorted(base, key=lambda c: (c.kind, c.begin))


_SPAN = pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])


def find(docs: DataFrame, model: SpanModel | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``spans`` of every row."""
    rows = docs.select(*(F.col(name) for name in keep), text_or_empty(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[{"kind": KINDS[c.kind], "begin": c.begin, "end": c.end, "base": c.base} for c in spans(x.as_py(), model)]
                   for x in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.list_(_SPAN))], names=[*batch.schema.names[:-1], "spans"])

    return small_batches(rows).mapInArrow(lean(run), extended(rows, "spans array<struct<kind: string, begin: long, end: long, base: boolean>>"))


def redact_text(text: str, model: SpanModel | None) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans are one."""
    merged: list[list] = []
    for c in sorted(spans(text, model), key=lambda c: (c.begin, c.kind)):
        if merged and c.begin < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], c.end)
        else:
            merged.append([c.begin, c.end, KINDS[c.kind].upper()])
    parts, last = [], 0
    for begin, end, kind in merged:
        parts += [text[last:begin], f"<{kind}>"]
        last = end
    return "".join([*parts, text[last:]]) if parts else text


def redact(docs: DataFrame, text: str = "text", chars: str | None = "n_chars") -> DataFrame:
    """All columns, with the spans in ``text`` replaced; ``chars``, if there, is the new length."""
    model = fit(docs, text)
    at = docs.columns.index(text)
    length = docs.columns.index(chars) if chars in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            bodies = [None if (x := value.as_py()) is None else redact_text(x, model) for value in columns[at]]
            columns[at] = pa.array(bodies, columns[at].type)
            if length is not None:
                old = columns[length]
                new = pa.array([None if body is None else len(body) for body in bodies], old.type)
                columns[length] = pc.if_else(pc.or_(pc.is_null(old), pc.is_null(new)), old, new)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return small_batches(docs).mapInArrow(lean(run), docs.schema)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, the number of base spans by kind, their digest, and all spans as text."""
    def joined(column):
        return F.concat_ws(",", F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    counts = [count(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))
