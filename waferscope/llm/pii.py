"""Personal data in texts: base patterns, and spans added by weak supervision.

Broad patterns propose candidate spans of each kind. Labelers (shape, checksum, gazetteer, context, randomness) vote on each of
them or abstain. Expectation-maximisation over the counted vote patterns of all documents estimates each labeler's
reliability, kind by kind, and with it the chance that a pattern of votes marks personal data. Those chances are the
soft labels of a logistic span classifier, which decides on every candidate. What the base patterns find always stays;
the classifier only adds.

Counts of votes cover all documents. The classifier is fitted on a bounded sample of spans, `most_spans` in expectation.
Every pattern is linear in the length of the text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from waferscope.llm.storage import stored

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
LABELERS = ("shape", "checksum", "gazetteer", "context", "randomness")

# Word lists of the gazetteer and context labelers.
ENDINGS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au jp cn ru br in ch at se".split())
CONTEXT = {
    "email": ("mail", "contact", "write to", "correo", "courriel"),
    "ip": ("ip", "address", "server", "host", "ping", "login from"),
    "card": ("card", "visa", "master", "credit", "debit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "whatsapp", "sms"),
    "secret": ("token", "secret", "password", "passwd", "key", "bearer", "auth"),
}
CARD_STARTS = ("34", "35", "36", "37", "38", "4", "50", "51", "52", "53", "54", "55", "56", "57", "58", "6", "2")

_AFTER_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SPOKEN_AT = re.compile(r" ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,24}){1,4}")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_NAMED_SECRET = re.compile(
    r"(?:token|secret|password|passwd|api[_-]?key)[\"']?[ \t]{0,3}[:=][ \t]{0,3}[\"']?([A-Za-z0-9_/+=-]{12,}+)", re.IGNORECASE
)
_HEX = re.compile(r"(?<![A-Za-z0-9])[0-9a-f]{32,}+(?![A-Za-z0-9])")


class Span(NamedTuple):
    kind: int
    start: int
    end: int
    base: bool


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _local_start(text: str, at: int, least: int, most: int | None = None) -> int:
    start = at
    while start > least and text[start - 1] in _LOCAL and (most is None or at - start < most):
        start -= 1
    return start


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    done = 0
    for found in _AFTER_AT.finditer(text) if "@" in text else ():
        start = _local_start(text, found.start(), done)
        if start < found.start():
            done = found.end()
            yield Span(0, start, done, True)


def _ips(text: str) -> Iterator[Span]:
    for found in _IP.finditer(text):
        parts = [p.lstrip("0") for p in found.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield Span(1, *found.span(), True)


def _cards(text: str) -> Iterator[Span]:
    """Base cards, and as candidates the shorter numbers that pass the same check."""
    for found in _DIGITS.finditer(text):
        digits = _only_digits(found.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield Span(2, *found.span(), len(digits) >= 16)


def _phones(text: str) -> Iterator[Span]:
    for found in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= len(_only_digits(found.group())) <= 15:
            yield Span(3, *found.span(), True)


def _others(text: str) -> Iterator[Span]:
    for found in _SPOKEN_AT.finditer(text):
        at = found.start()
        start = _local_start(text, at, 0, 64)
        if start < at:
            yield Span(0, start, found.end(), False)
    for found in _LOCAL_PHONE.finditer(text):
        yield Span(3, *found.span(), False)
    for found in _NAMED_SECRET.finditer(text):
        yield Span(4, *found.span(1), False)
    for found in _HEX.finditer(text):
        yield Span(4, *found.span(), False)


_ANY_DIGIT = re.compile("[0-9]")


def candidates(text: str) -> list[Span]:
    """Spans by kind and start. Candidates that overlap a base span, or an earlier candidate, are left out.

    Only secrets stay that hold base spans whole: what is around these is secret too.
    """
    digits = _ANY_DIGIT.search(text) is not None
    found = list(_emails(text))
    if digits:
        found += [*_ips(text), *_cards(text), *_phones(text)]
    taken = sorted((s.start, s.end) for s in found if s.base)
    kept = [s for s in found if s.base]
    more = [*(s for s in found if not s.base), *_others(text)]
    if more:
        begins = np.array([a for a, _ in taken], np.int64)
        reach = np.maximum.accumulate(np.array([b for _, b in taken], np.int64)) if taken else begins
        last = 0
        for span in sorted(more, key=lambda s: (s.start, -s.end, s.kind)):
            at = int(np.searchsorted(begins, span.end)) - 1
            free = at < 0 or reach[at] <= span.start
            if not free and KINDS[span.kind] == "secret":
                before = int(np.searchsorted(begins, span.start)) - 1
                free = reach[at] <= span.end and (before < 0 or reach[before] <= span.start)
            if span.start >= last and free:
                kept.append(span)
                last = span.end
    return sorted(kept, key=lambda s: (s.kind, s.start, s.end))


def _entropy(text: str) -> float:
    counts = Counter(text)
    return -sum(n / len(text) * math.log2(n / len(text)) for n in counts.values())


def votes(text: str, span: Span) -> tuple[int, ...]:
    """Each labeler's vote: 1 personal, -1 not, 0 none."""
    kind, body = KINDS[span.kind], text[span.start : span.end]
    before, after = text[max(0, span.start - 40) : span.start].lower(), text[span.end : span.end + 2]
    digits = _only_digits(body)
    shape = checksum = gazetteer = randomness = 0
    if kind == "email":
        shape = 1 if "@" in body and not body.startswith(".") and ".." not in body else 0 if "@" in body else -1
        gazetteer = 1 if re.split(r"[^a-z]+", body.lower())[-1] in ENDINGS else -1
        checksum = 1 if re.search(r"(?:\(|\[)(?:at|dot)", body) else 0
    elif kind == "ip":
        parts = body.split(".")
        shape = -1 if any(len(p) > 1 and p[0] == "0" for p in parts) else 1
        gazetteer = -1 if parts[0] in ("0", "127", "255") else 1
        checksum = -1 if after[:1] == "." and after[1:].isdigit() else 0
    elif kind == "card":
        shape = 1 if len(digits) in (15, 16) else -1
        checksum = 1 if re.fullmatch(r"[0-9]{4}(?:([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4})|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}", body) else 0
        gazetteer = 1 if digits.startswith(CARD_STARTS) else -1
        randomness = -1 if _entropy(digits) < 1.5 else 0
    elif kind == "phone":
        shape = 1 if 10 <= len(digits) <= 13 else -1
        checksum = 1 if re.search(r"[ ().-]", body) else 0
        gazetteer = 1 if body.startswith("+") else -1 if digits.startswith(("0", "1")) else 0
        randomness = -1 if _entropy(digits) < 1.5 else 0
    else:
        shape = 1 if re.fullmatch(r"[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}", body) else 0
        gazetteer = -1 if body.lower() in ("undefined", "placeholder", "your_api_key_here", "changeme") else 0
        randomness = 1 if _entropy(body) >= 3.2 else -1
        checksum = 1 if digits and len(digits) < len(body) else -1
    context = 1 if any(word in before for word in CONTEXT[kind]) else 0
    return shape, checksum, gazetteer, context, randomness


def span_features(text: str, span: Span, cast: tuple[int, ...]) -> list[float]:
    body = text[span.start : span.end]
    size = len(body)
    digits = sum("0" <= c <= "9" for c in body) / size
    letters = sum(c.isalpha() for c in body) / size
    one_hot = [float(span.kind == k) for k in range(len(KINDS))]
    by_kind = [v * h for h in one_hot for v in cast]
    return [min(size, 100) / 40, digits, letters, _entropy(body[:256]) / 4, *one_hot, *by_kind]


@dataclass
class Model:
    # By kind: chance that a candidate is personal, and each labeler's chances of -1, 0 and 1 if it is not and if it is.
    priors: np.ndarray
    reliabilities: np.ndarray
    coefficients: np.ndarray

    def accepts(self, text: str, span: Span) -> bool:
        return span.base or self.chance(span_features(text, span, votes(text, span))) >= 0.5

    def chance(self, features: list[float]) -> float:
        z = float(np.dot(self.coefficients, [*features, 1.0]))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def estimate(patterns: dict[tuple[int, tuple[int, ...]], int], rounds: int = 100) -> tuple[np.ndarray, np.ndarray, dict]:
    """Expectation-maximisation over vote patterns (kind, votes) and their counts.

    Returns priors, reliabilities and the chance of each pattern. It starts from labelers that are mostly right; their
    beginning also weighs as a few observations, so that kinds seen seldom keep sensible reliabilities.
    """
    priors = np.full(len(KINDS), 0.5)
    start = np.array([[0.5, 0.35, 0.15], [0.1, 0.35, 0.55]])
    reliabilities = np.tile(start, (len(KINDS), len(LABELERS), 1, 1))
    keys = list(patterns)
    kinds = np.array([k for k, _ in keys], int)
    cast = np.array([v for _, v in keys], int).reshape(len(keys), len(LABELERS)) + 1
    number = np.array([patterns[k] for k in keys], float)
    chance = np.full(len(keys), 0.5)
    for _ in range(rounds if keys else 0):
        log = np.zeros((len(keys), 2))
        for truth in (0, 1):
            log[:, truth] = np.log(priors[kinds] if truth else 1 - priors[kinds])
            for j in range(len(LABELERS)):
                log[:, truth] += np.log(reliabilities[kinds, j, truth, cast[:, j]])
        chance = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -60, 60)))
        for kind in range(len(KINDS)):
            own = kinds == kind
            right = chance[own] * number[own]
            wrong = (1 - chance[own]) * number[own]
            priors[kind] = (right.sum() + 5) / (number[own].sum() + 10)
            for j in range(len(LABELERS)):
                for truth, mass in ((0, wrong), (1, right)):
                    counted = np.bincount(cast[own, j], weights=mass, minlength=3) + 10 * start[truth]
                    reliabilities[kind, j, truth] = counted / counted.sum()
    return priors, reliabilities, dict(zip(keys, chance, strict=True))


def _fit(x: np.ndarray, soft: np.ndarray) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    b = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.eye(x.shape[1])
        step = np.linalg.solve(curve, x.T @ (p - soft) + b)
        b -= step
        if np.abs(step).max() < 1e-6:
            break
    return b


_SPANS = "array<struct<kind:int,start:int,end:int,base:boolean,votes:array<int>,features:array<double>>>"


def _proposed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, spans) for every row of docs, with each candidate's votes and features."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in found:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows = []
                for text in batch.column(1).to_pylist():
                    spans = []
                    for span in candidates(text or ""):
                        cast = votes(text, span)
                        spans.append((*span, cast, span_features(text, span, cast)))
                    rows.append([dict(zip(names, s, strict=True)) for s in spans])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])

    names = ("kind", "start", "end", "base", "votes", "features")
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.float64()))
    kind = pa.list_(pa.struct(list(zip(names, kinds, strict=True))))
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(batches, f"doc_id long, spans {_SPANS}")


def _trained(proposed: DataFrame, most_spans: int) -> Model:
    spans = proposed.select(F.inline("spans"))
    counts = spans.groupBy("kind", "votes").count().collect()  # kinds x 3^labelers rows at most
    patterns = {(r.kind, tuple(r.votes)): r["count"] for r in counts}
    priors, reliabilities, chance = estimate(patterns)
    total = sum(patterns.values())
    size = len(KINDS) + 4 + len(KINDS) * len(LABELERS)
    if not total:
        return Model(priors, reliabilities, np.zeros(size + 1))
    draw = F.pmod(F.xxhash64("doc_id", "kind", "start"), F.lit(1 << 30)) / (1 << 30)
    sample = proposed.select("doc_id", F.inline("spans")).where(draw < min(1.0, most_spans / total))
    rows = sample.select("kind", "votes", "features").collect()
    if not rows:
        return Model(priors, reliabilities, np.zeros(size + 1))
    soft = np.array([chance[(r.kind, tuple(r.votes))] for r in rows])
    return Model(priors, reliabilities, _fit(np.array([r.features for r in rows]), soft))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_spans: int = 20_000) -> Model:
    return _trained(stored(_proposed(docs, id_col, text_col)), most_spans)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_spans: int = 20_000) -> DataFrame:
    """(doc_id, spans) for every row of docs: spans are (kind, start, end, base) by kind as in KINDS, then start.

    Places are code points, end exclusive; base says that a base pattern found the span. Null and empty texts have no spans.
    Repeated rows and ids, and null ids, keep a row each. No rows: no rows. Texts are read once: candidates are stored,
    then decided by the model that their votes give.
    """
    proposed = stored(_proposed(docs, id_col, text_col))
    model = _trained(proposed, most_spans)
    weights = F.array(*[F.lit(float(c)) for c in model.coefficients])
    products = lambda s: F.zip_with(F.concat(s["features"], F.array(F.lit(1.0))), weights, lambda a, b: a * b)
    score = lambda s: F.aggregate(products(s), F.lit(0.0), lambda a, b: a + b)
    kept = F.filter("spans", lambda s: s["base"] | (score(s) >= 0))
    names = F.array(*[F.lit(k) for k in KINDS])
    plain = F.transform(
        kept,
        lambda s: F.struct(names[s["kind"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base")),
    )
    return proposed.select("doc_id", plain.alias("spans"))


def redact(text: str, model: Model) -> str:
    """The text with each accepted span replaced by its kind in angle brackets; overlapping spans become one."""
    pieces, done = [], 0
    for span in sorted((s for s in candidates(text) if model.accepts(text, s)), key=lambda s: (s.start, -s.end)):
        if span.start >= done:
            pieces += [text[done : span.start], f"<{KINDS[span.kind]}>"]
        done = max(done, span.end)
    return "".join([*pieces, text[done:]])


def redacted(docs: DataFrame, model: Model, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """docs with personal data replaced in the text, and length_col set to the new number of code points."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in found:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = [None if t is None else redact(t, sent.value) for t in batch.column(text_col).to_pylist()]
                place = batch.schema.get_field_index(text_col)
                columns = list(batch.columns)
                columns[place] = pa.array(texts, batch.schema.field(place).type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    changed = docs.mapInArrow(batches, docs.schema)
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        changed = changed.withColumn(length_col, F.when(F.col(text_col).isNull(), F.col(length_col)).otherwise(F.length(text_col)).cast(kind))
    return changed


def digest(spans: list[tuple[str, int, int]]) -> str:
    """Hex digest of spans as kind:start:end, comma-joined."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
