"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Fixed rules find the base spans.  Wider patterns add candidates; a regex, a
gazetteer, a context, a checksum and a border labeler vote on every candidate,
base spans included, without any labelled row.  Vote patterns are counted over
all documents, and since their number is fixed by the number of labelers, EM
and the training of the classifier work on a table of constant size.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.llm.words import map_slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "ssn", "iban", "secret")
LABELERS = ("regex", "gazetteer", "context", "checksum", "border")
CONTEXT_CHARS = 40
ACCEPT = 0.5

SPAN_TYPE = "array<struct<kind:string,start:long,end:long,base:boolean>>"


class Candidate(NamedTuple):
    kind: int
    start: int
    end: int
    base: bool
    votes: tuple[int, ...]
    length: int


# --- base spans ----------------------------------------------------------------

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Starting inside a run of digits gives nothing that its start does not give.
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Spans of addresses: the domain is matched, then the local part read backwards."""
    found, last = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            found.append((start, m.end()))
            last = m.end()
    return found


def _octets(value: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in value.split("."))


def _digits(value: str) -> str:
    return "".join(c for c in value if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


# --- candidates and votes ------------------------------------------------------

_LOOSE_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_AT = re.compile(r" ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{1,63}){1,8}")
_ASSIGNED = re.compile(r"[=:] ?[\"']?([A-Za-z0-9+/_.-]{8,}+)")
_KEY = re.compile(r"([A-Za-z_-]{2,24}) ?\Z")
_ACCESS = re.compile(r"(?<![A-Z0-9])AKIA[A-Z0-9]{16}(?![A-Z0-9])")

TOP_DOMAINS = frozenset(
    "com org net edu gov mil int info biz io ai app dev eu uk de fr es it nl be ch at pl se no fi dk "
    "pt ie us ca mx br ar cl au nz jp cn in kr sg za ru ua tr gr cz hu ro me co tv".split()
)
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "CH": 21, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22,
    "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24,
}
SECRET_KEYS = frozenset(
    "password passwd pwd token secret key api_key apikey api-key access_key auth credential".split()
)
CUES = {
    "email": ("mail", "contact", "write", "adres", "correo", "courriel"),
    "ip": (" ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "master", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "handy"),
    "ssn": ("ssn", "social", "security"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "secret": ("password", "token", "secret", "key", "login"),
}
DOUBTS = ("version", "isbn", "page", "figure", "section", "order no", "article no", "sample")


def _iban_valid(value: str) -> bool:
    v = value.replace(" ", "")
    moved = v[4:] + v[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _spread_of(value: str) -> int:
    """Whether characters vary as in a random string."""
    return 1 if len(set(value)) >= min(8, len(value) // 2 + 1) and _DIGIT.search(value) else -1


def _own_votes(kind: str, value: str, valid: bool) -> tuple[int, int, int]:
    """Votes of the regex, gazetteer and checksum labelers."""
    digits = _digits(value)
    if kind == "email":
        known = re.split(r"[.\])]| ", value)[-1].lower() in TOP_DOMAINS
        return (1 if valid else 0), (1 if known else -1), (1 if len(value) <= 254 else -1)
    if kind == "ip":
        first = int(value.split(".")[0][-3:] or 0)
        return (1 if valid else -1), (1 if 0 < first < 240 else -1), (1 if valid else -1)
    if kind == "card":
        issuer = digits[0] in "3456" and 14 <= len(digits) <= 19
        return (1 if valid else -1), (1 if issuer else -1), (1 if luhn(digits) else -1)
    if kind == "phone":
        area = value.startswith("+") or digits[0] not in "01"
        return (1 if valid else 0), (1 if area else -1), (1 if 10 <= len(digits) <= 15 else -1)
    if kind == "ssn":
        good = digits[:3] not in ("000", "666") and digits[0] != "9"
        return 1, (1 if good else -1), (1 if digits[3:5] != "00" and digits[5:] != "0000" else -1)
    if kind == "iban":
        length = IBAN_LENGTHS.get(value[:2])
        right = length == len(value.replace(" ", ""))
        return (1 if right else -1), (1 if length else -1), (1 if _iban_valid(value) else -1)
    return (1 if valid else 0), (1 if valid else -1), _spread_of(value)


def _candidate(text: str, kind: str, start: int, end: int, base: bool, valid: bool) -> Candidate:
    value = text[start:end]
    regex, gazetteer, checksum = _own_votes(kind, value, valid)
    before = text[max(0, start - CONTEXT_CHARS) : start].lower()
    context = 1 if any(c in before for c in CUES[kind]) else -1 if any(c in before for c in DOUBTS) else 0
    glued = (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    length = min(7, (end - start) // 6)
    return Candidate(
        KINDS.index(kind), start, end, base, (regex, gazetteer, context, checksum, -1 if glued else 1), length
    )


def candidates(text: str) -> list[Candidate]:
    """Base spans and wider matches of a whole text with their votes."""
    out: list[Candidate] = []

    def add(kind: str, start: int, end: int, base: bool, valid: bool) -> None:
        out.append(_candidate(text, kind, start, end, base, valid))

    if "@" in text:
        for a, b in emails(text):
            add("email", a, b, True, True)
    if "at)" in text or "at]" in text:
        for m in _AT.finditer(text):
            start = m.start()
            # The bracket of the address before is a border, so no character is read twice.
            while start and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                add("email", start, m.end(), False, False)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            ok = _octets(m[0])
            add("ip", m.start(), m.end(), ok, ok)
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19:
                ok = luhn(digits)
                add("card", m.start(), m.end(), ok, ok)
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m[0])) <= 15:
                    add("phone", m.start(), m.end(), True, True)
        for kind, pattern in (("phone", _LOOSE_PHONE), ("ssn", _SSN), ("iban", _IBAN)):
            for m in pattern.finditer(text):
                add(kind, m.start(), m.end(), False, False)
        if "AKIA" in text:
            for m in _ACCESS.finditer(text):
                add("secret", m.start(), m.end(), False, True)
        if "=" in text or ":" in text:
            for m in _ASSIGNED.finditer(text):
                key = _KEY.search(text[max(0, m.start() - 24) : m.start()])
                if key:
                    add("secret", m.start(1), m.end(1), False, key[1].lower().strip("_-") in SECRET_KEYS)
    return out


# --- reliabilities and classifier ------------------------------------------------


class Model(NamedTuple):
    """Weights of the span classifier by kind, and what EM found about the labelers."""

    weights: np.ndarray
    right_if_private: np.ndarray
    prior: np.ndarray

    def accept(self, kind: int, votes: tuple[int, ...], length: int) -> bool:
        return float(_features(kind, votes, length) @ self.weights) > np.log(ACCEPT / (1 - ACCEPT))


def _features(kind: int, votes: tuple[int, ...], length: int) -> np.ndarray:
    x = np.zeros(len(KINDS) + 3 * len(LABELERS) + 8)
    x[kind] = 1
    for j, v in enumerate(votes):
        x[len(KINDS) + 3 * j + v + 1] = 1
    x[len(KINDS) + 3 * len(LABELERS) + length] = 1
    return x


def expectation_maximisation(
    kinds: np.ndarray, votes: np.ndarray, counts: np.ndarray, rounds: int = 50
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of every vote pattern to be private, vote tables and priors by kind.

    A labeler says no, nothing or yes with probabilities that depend on the
    hidden class.  It starts from the share of yes votes; a pseudo count that
    favours right votes keeps the classes from changing places.
    """
    shape = (len(KINDS), 2, votes.shape[1], 3)
    pseudo = np.ones(shape)
    pseudo[:, 1, :, 2] = pseudo[:, 0, :, 0] = 2
    positive = (votes > 0).sum(1)
    private = (positive + 0.5) / (positive + (votes < 0).sum(1) + 1)
    for _ in range(rounds):
        tables, prior = pseudo.copy(), np.ones((len(KINDS), 2))
        for y, p in ((1, private), (0, 1 - private)):
            np.add.at(prior, (kinds, y), counts * p)
            for j in range(votes.shape[1]):
                np.add.at(tables, (kinds, y, j, votes[:, j] + 1), counts * p)
        tables /= tables.sum(-1, keepdims=True)
        prior /= prior.sum(-1, keepdims=True)
        logs = np.log(prior[kinds])
        for j in range(votes.shape[1]):
            logs += np.log(tables[kinds, :, j, votes[:, j] + 1])
        private = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
    return private, tables, prior


def fit(patterns: list[tuple[int, tuple[int, ...], int, int]]) -> Model:
    """Model from (kind, votes, length class, count) patterns; logistic regression by Newton steps."""
    width = len(KINDS) + 3 * len(LABELERS) + 8
    if not patterns:
        return Model(np.zeros(width), np.zeros((len(KINDS), 2, len(LABELERS), 3)), np.zeros((len(KINDS), 2)))
    kinds = np.array([p[0] for p in patterns])
    votes = np.array([p[1] for p in patterns])
    counts = np.array([p[3] for p in patterns], float)
    private, tables, prior = expectation_maximisation(kinds, votes, counts)
    x = np.array([_features(k, v, n) for k, v, n, _ in patterns])
    weights, share = np.zeros(width), counts / counts.sum() * min(counts.sum(), 1e4)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (share * (private - p)) - 0.1 * weights
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(width)
        weights += np.linalg.solve(curve, slope)
    return Model(weights, tables, prior)


def train(documents: DataFrame) -> Model:
    """Count the vote patterns of all candidates of all documents and fit the model.

    At most kinds x 3**labelers x 8 patterns reach the driver, whatever the
    number of documents.
    """

    def votes(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: dict[tuple, int] = {}
        for text in batch.column("text").to_pylist():
            for c in candidates(text) if text else ():
                key = (c.kind, c.votes, c.length)
                counts[key] = counts.get(key, 0) + 1
        return pa.record_batch(
            [
                pa.array([k[0] for k in counts], pa.int32()),
                pa.array([list(k[1]) for k in counts], pa.list_(pa.int32())),
                pa.array([k[2] for k in counts], pa.int32()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            names=["kind", "votes", "length", "count"],
        )

    texts = documents.select(F.col("text").cast("string").alias("text"))
    counted = map_slices(texts, votes, "kind int, votes array<int>, length int, count long")
    rows = counted.groupBy("kind", "votes", "length").agg(F.sum("count").alias("count")).collect()
    return fit(sorted((r.kind, tuple(r.votes), r.length, r["count"]) for r in rows))


class Cover:
    """Spans joined to disjoint ones, in order: a new one is compared with its neighbours alone."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def add(self, start: int, end: int) -> bool:
        """Add a span unless it touches one; whether it was added."""
        k = bisect_right(self.starts, start)
        if (k and self.ends[k - 1] > start) or (k < len(self.starts) and self.starts[k] < end):
            return False
        self.starts.insert(k, start)
        self.ends.insert(k, end)
        return True


def decide(text: str | None, model: Model) -> list[dict]:
    """Base spans and the accepted candidates that touch none of them, by start and kind."""
    found = candidates(text) if text else []
    taken = [c for c in found if c.base]
    cover = Cover((c.start, c.end) for c in taken)
    for c in found:
        if not c.base and model.accept(c.kind, c.votes, c.length) and cover.add(c.start, c.end):
            taken.append(c)
    taken.sort(key=lambda c: (c.start, c.kind, c.end))
    return [{"kind": KINDS[c.kind], "start": c.start, "end": c.end, "base": c.base} for c in taken]


_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
)


def find_private(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id and the spans of personal data of every whole text.

    Spans are in code points with an exclusive end.  Null and empty texts have
    none; equal rows give equal rows; an empty table gives no rows; other
    columns are not looked at.  Nothing but vote counts is shuffled.
    """
    model = model or train(documents)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [decide(t, model) for t in batch.column("text").to_pylist()]
        return pa.record_batch(
            [batch.column("doc_id"), pa.array(spans, _ARROW_SPANS)], names=["doc_id", "spans"]
        )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return map_slices(rows, run, f"doc_id long, spans {SPAN_TYPE}")


def mask(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets.

    Overlapping spans are replaced as one, under the kind that starts first.
    A ``n_chars`` column follows the new text; all other columns stay.  A null
    or empty text stays as it is, equal rows give equal rows, and an empty
    table gives no rows.
    """
    model = model or train(documents)
    columns = documents.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [masked(t, decide(t, model)) for t in batch.column("text").to_pylist()]
        arrays = dict(zip(columns, batch.columns))
        arrays["text"] = pa.array(texts, pa.string())
        if "n_chars" in arrays:
            changed = [None if t is None else len(t) for t in texts]
            arrays["n_chars"] = pa.array(changed, batch.schema.field("n_chars").type)
        return pa.record_batch(list(arrays.values()), names=columns)

    return map_slices(documents, run, documents.schema)


def masked(text: str | None, spans: list[dict]) -> str | None:
    if not spans:
        return text
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at : s["start"]], f"<{s['kind'].upper()}>"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def joined(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
