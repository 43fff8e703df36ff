"""Text quality by a regularised quadratic discriminant.

A text becomes a vector of transformed statistics of its signs, words and lines. Each class has a Gaussian over them: its mean
and its covariance, shrunk towards the covariance of both classes and towards a multiple of the identity. A text's score is the
difference of the two log-densities, by Mahalanobis distances from the classes' cached Cholesky factors, through a logistic
curve fitted to the labelled texts.

Means, covariances and the curve are sums over all labelled rows, added up in tasks; no row is sampled. The statistics do not depend on
the language, and neither id, source nor language is read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from waferscope.llm.batches import slices

BYTES_AT_ONCE = 1 << 21
# Kinds of signs: small letters, capitals, other letters, digits, white space, line ends, stops, loud signs, other signs.
SMALL, CAPITAL, OTHER_LETTER, DIGIT, WHITE, LINE_END, STOP, LOUD, OTHER = range(9)
_KINDS = 9
STATISTICS = (
    "chars", "words", "small", "capital", "digit", "white", "line_end", "stop", "loud", "other_sign", "beyond_ascii",
    "entropy", "word_length", "word_spread", "long_words", "short_words", "shouted_words", "signed_words", "plain_words",
    "distinct_words", "commonest_word", "repeated_word", "word_run", "distinct_pairs", "sign_run",
    "line_length", "repeated_lines", "repeated_line_words", "commonest_line", "unstopped_lines",
)
_N = len(STATISTICS)
# Bins of the log-density difference's inverse hyperbolic sine, for the curve.
_BINS = 4_096
_REACH = 12.0


def _kind(sign: str) -> int:
    if sign == "\n":
        return LINE_END
    if sign.isspace():
        return WHITE
    if sign.isdigit():
        return DIGIT
    if sign.isalpha():
        return SMALL if sign.islower() else CAPITAL if sign.isupper() else OTHER_LETTER
    return STOP if sign in ".,;:" else LOUD if sign in "!?" else OTHER


# The kinds of the first 65,536 signs; signs beyond are other signs.
_KIND_OF = np.array([_kind(chr(i)) for i in range(0xD800)] + [OTHER] * 0x800 + [_kind(chr(i)) for i in range(0xE000, 0x10000)], np.uint8)


def _longest_run(same: np.ndarray) -> int:
    """The most neighbours in a row that are the same."""
    if not len(same):
        return 1
    breaks = np.flatnonzero(np.concatenate([[True], ~same, [True]]))
    return int(np.diff(breaks).max())


def _share(part: float, whole: float) -> float:
    """The angle of a share: as wide near 0 and 1 as in the middle, for counts."""
    return float(np.arcsin(np.sqrt(min(1.0, part / whole)))) if whole else 0.0


def statistics(text: str) -> list[float]:
    """The transformed statistics of a text, in the order of STATISTICS; all zero where it has no sign."""
    if not text:
        return [0.0] * _N
    signs = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = np.where(signs < 0x10000, _KIND_OF[np.minimum(signs, 0xFFFF)], OTHER)
    chars = len(signs)
    of = np.bincount(kinds, minlength=_KINDS).tolist()
    letters = of[SMALL] + of[CAPITAL] + of[OTHER_LETTER]
    common = np.bincount(np.minimum(signs, 0x3FF), minlength=1).astype(float)
    p = common[common > 0] / chars
    words = text.split()
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    same = np.fromiter((a == b for a, b in zip(words, words[1:], strict=False)), bool, max(0, n - 1))
    lines = [line for line in map(str.strip, text.split("\n")) if line]
    by_line = Counter(lines)
    repeated = {line: k for line, k in by_line.items() if k > 1}
    # Of distinct words: each counts as often as it occurs.
    shouted = sum(k for w, k in counts.items() if len(w) > 1 and w.isupper())
    signed = sum(k for w, k in counts.items() if not w[0].isalnum() or not any(map(str.isalpha, w)))
    plain = sum(k for w, k in counts.items() if w.isalpha())
    return [
        float(np.log1p(chars)),
        float(np.log1p(n)),
        _share(of[SMALL], chars),
        _share(of[CAPITAL], letters),
        _share(of[DIGIT], chars),
        _share(of[WHITE], chars),
        _share(of[LINE_END], chars),
        _share(of[STOP], chars),
        _share(of[LOUD], chars),
        _share(of[OTHER], chars),
        _share(int((signs > 0x7F).sum()), chars),
        float(-(p * np.log(p)).sum()),
        float(np.log1p(lengths.mean())) if n else 0.0,
        float(np.log1p(lengths.std())) if n else 0.0,
        _share(int((lengths > 14).sum()), n),
        _share(int((lengths < 3).sum()), n),
        _share(shouted, n),
        _share(signed, n),
        _share(plain, n),
        _share(len(counts), n),
        _share(max(counts.values(), default=0), n),
        _share(int(same.sum()), n),
        float(np.log1p(_longest_run(same))),
        _share(pairs, max(1, n - 1)),
        float(np.log1p(_longest_run(signs[1:] == signs[:-1]))),
        float(np.log1p(chars / max(1, len(lines)))),
        _share(sum(repeated.values()) - len(repeated), len(lines)),
        _share(sum((k - 1) * len(line) for line, k in repeated.items()), chars),
        _share(max(by_line.values(), default=1) - 1, len(lines)),
        _share(sum(k for line, k in by_line.items() if line[-1] not in ".!?:;,"), len(lines)),
    ]


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): every row's transformed statistics. A null text counts as empty; repeated rows keep a row each; no rows: no rows."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for start, some in slices(batch.column(1), BYTES_AT_ONCE):
                x = np.array([statistics(text) for text in some])
                rows = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * _N), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(some)), rows], names=["doc_id", "x"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(batches, f"doc_id {kind}, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), _N)


@dataclass(frozen=True)
class Class:
    """A Gaussian: `inverse` is the inverse of its covariance's Cholesky factor, `level` its log-density at the mean."""

    mean: np.ndarray
    inverse: np.ndarray
    level: float

    @staticmethod
    def of(mean: np.ndarray, covariance: np.ndarray) -> Class:
        factor = np.linalg.cholesky(covariance)
        return Class(mean, np.linalg.inv(factor), float(-np.log(np.diag(factor)).sum()))

    def log_density(self, z: np.ndarray) -> np.ndarray:
        """Up to a constant that all classes share."""
        away = (z - self.mean) @ self.inverse.T
        return self.level - 0.5 * (away * away).sum(axis=1)


@dataclass(frozen=True)
class Model:
    """Statistics are centred and scaled, and classes 0 and 1 compared; `fixed` is every score where one class had no rows."""

    centre: np.ndarray
    scale: np.ndarray
    classes: tuple[Class, Class] | None
    slope: float
    shift: float
    fixed: float = 0.5

    def difference(self, x: np.ndarray) -> np.ndarray:
        """The inverse hyperbolic sine of the classes' log-density difference: far ones count as far, not as certain."""
        z = (x - self.centre) / self.scale
        bad, good = self.classes
        return np.arcsinh(good.log_density(z) - bad.log_density(z))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.classes is None:
            return np.full(len(x), self.fixed)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.shift, -500, 500)))


def _sums(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sums and sums of products of each class in a task, as (label, place, value)."""
    held = np.zeros((2, 1 + _N + _N * _N))
    for batch in found:
        labels, x = np.asarray(batch.column(0)), _matrix(batch.column(1))
        for label in (0, 1):
            of = x[labels == label]
            held[label] += np.concatenate([[len(of)], of.sum(axis=0), (of.T @ of).ravel()])
    size = held.shape[1]
    columns = [pa.array(np.repeat([0, 1], size).astype(np.int32)), pa.array(np.tile(np.arange(size, dtype=np.int32), 2)), pa.array(held.ravel())]
    yield pa.RecordBatch.from_arrays(columns, names=["label", "place", "value"])


def _spread(n: float, sums: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mean = sums / n
    return mean, products / n - np.outer(mean, mean)


def shrunk(covariance: np.ndarray, pooled: np.ndarray, n: float, towards_pooled: float) -> np.ndarray:
    """A class's covariance, mixed with that of both, then moved to a multiple of the identity by the oracle-approximating weight."""
    size = len(covariance)
    mixed = (1 - towards_pooled) * covariance + towards_pooled * pooled
    trace, squares = np.trace(mixed), (mixed * mixed).sum()
    away = (n + 1 - 2 / size) * (squares - trace * trace / size)
    weight = 1.0 if away <= 0 else min(1.0, ((1 - 2 / size) * squares + trace * trace) / away)
    # The floor keeps a statistic that never varies from deciding alone.
    weight = max(weight, 1e-3)
    return (1 - weight) * mixed + weight * (trace / size) * np.eye(size)


def _curve(difference: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> tuple[float, float]:
    """The logistic curve of label 1 over a difference, from counts of either label, by Newton steps with a slight pull to slope 0."""
    design = np.stack([difference, np.ones_like(difference)], axis=1)
    # Smoothed targets keep the curve finite where the classes do not meet.
    high, low = (ones.sum() + 1) / (ones.sum() + 2), 1 / (zeros.sum() + 2)
    weight, target = zeros + ones, ones * high + zeros * low
    at = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -500, 500)))
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(bend, design.T @ (target - weight * p) - 1e-6 * at)
        # Steps are held back where the curve is flat.
        at = at + step * min(1.0, 4 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def train(measured: DataFrame, labels: DataFrame, label_col: str = "quality", towards_pooled: float = 0.05) -> Model:
    """Learns from the rows of measure() that have a label, 0 or 1, in labels (doc_id, label_col); other labels are ignored.

    Every labelled row counts, repeated labels and repeated rows each time. Where a class has no rows, every score is the share of
    label 1, 0.5 without any rows. towards_pooled is the share of both classes' covariance in each.
    """
    label = labels.select("doc_id", F.col(label_col).cast("int").alias("label")).where("label IN (0, 1)")
    known = measured.join(label, "doc_id").select("label", "x")
    places = known.mapInArrow(_sums, "label int, place int, value double").groupBy("label", "place").agg(F.sum("value").alias("value"))
    held = np.zeros((2, 1 + _N + _N * _N))
    # One row for each class and place.
    for row in places.collect():
        held[row.label, row.place] = row.value
    rows, whole = held[:, 0], held.sum(axis=0)
    unit = np.ones(_N)
    if not rows.all():
        return Model(0 * unit, unit, None, 0.0, 0.0, float(rows[1] / rows.sum()) if rows.any() else 0.5)
    centre, spread = _spread(whole[0], whole[1 : 1 + _N], whole[1 + _N :].reshape(_N, _N))
    scale = np.sqrt(np.maximum(np.diag(spread), 1e-8))
    each = [_spread(h[0], h[1 : 1 + _N], h[1 + _N :].reshape(_N, _N)) for h in held]
    scaled = [((mean - centre) / scale, covariance / np.outer(scale, scale)) for mean, covariance in each]
    pooled = (rows[0] * scaled[0][1] + rows[1] * scaled[1][1]) / rows.sum()
    bad, good = (Class.of(mean, shrunk(covariance, pooled, n, towards_pooled)) for (mean, covariance), n in zip(scaled, rows, strict=True))
    uncurved = Model(centre, scale, (bad, good), 1.0, 0.0)

    def binned(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * _BINS)
        for batch in found:
            far = uncurved.difference(_matrix(batch.column(1)))
            at = np.clip((far + _REACH) / (2 * _REACH) * _BINS, 0, _BINS - 1).astype(np.int64)
            counts += np.bincount(np.asarray(batch.column(0)) * _BINS + at, minlength=2 * _BINS)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["place", "rows"])

    counts = np.zeros(2 * _BINS)
    # One row for each bin and class at most.
    for row in known.mapInArrow(binned, "place long, rows double").groupBy("place").agg(F.sum("rows").alias("rows")).collect():
        counts[row.place] = row.rows
    middles = (np.arange(_BINS) + 0.5) / _BINS * 2 * _REACH - _REACH
    slope, shift = _curve(middles, counts[:_BINS], counts[_BINS:])
    return Model(centre, scale, (bad, good), slope, shift)


def with_quality(measured: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of measure(): how likely label 1 is, from 0 to 1; empty texts too. No rows: no rows."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            scores = pa.array(model.score(_matrix(batch.column(1))))
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=["doc_id", "score"])

    kind = measured.schema["doc_id"].dataType.simpleString()
    return measured.select("doc_id", "x").mapInArrow(batches, f"doc_id {kind}, score double")
