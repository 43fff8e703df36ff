"""Language identification by interpolated Kneser-Ney character models.

One model for each language over the letters of words, each word between marks of its beginning and end. Each language holds the n-grams
it has seen as sorted arrays of 64-bit hashes, with a probability and a back-off weight beside them: a model grows with the
n-grams seen, not with languages times n-grams. A text's language is the one with the lowest cross-entropy per letter. A word's
costs do not depend on other words, so a task looks up each distinct word once for as long as it remembers it.

The classifier is fitted on a bounded sample of labelled texts: about `per_language` whole texts for each language, chosen by a
hash of their content, fewer where there are fewer. Everything else covers all rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from waferscope.llm.storage import stored

RUNS = re.compile(r"[^\W\d_]+")
# Costs of words that a task remembers, and characters of texts that it takes up at a time.
REMEMBERED = 1_600_000
CHARS_AT_ONCE = 1 << 20
_LONG = 64


def words_of(text: str) -> list[str]:
    """The text's words, in small letters. A run of signs such as a fraction or a circled number, without a letter, is none."""
    found = RUNS.findall(text.lower())
    return found if text.isascii() else [word for word in found if any(map(str.isalpha, word))]


def runs(rows: list, size: int, text_of: Callable[[object], str]) -> Iterator[list]:
    """Rows one after another in runs whose texts have about `size` characters."""
    run, held = [], 0
    for row in rows:
        run.append(row)
        held += len(text_of(row))
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


def _joined(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signs of many words one after another, the number of the word and the place in it for each sign."""
    lengths = np.array([len(w) + 2 for w in words])
    text = "".join(f"\x01{w}\x02" for w in words)
    signs = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    word = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(signs)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return signs, word, place


def _hashes(signs: np.ndarray, place: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Where n-grams of `order` signs within a word end, and their hashes."""
    ends = np.flatnonzero(place >= order - 1)
    keys = np.full(len(ends), order, np.uint64)
    for back in range(order - 1, -1, -1):
        keys = (keys ^ signs[ends - back]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(31)
    return ends, keys


@dataclass
class Table:
    """One language's n-grams of one order: sorted hashes, log probabilities, and log back-off weights as contexts."""

    keys: np.ndarray
    probabilities: np.ndarray
    weights: np.ndarray


@dataclass
class Model:
    """For each language its tables by order and the log probability of a sign it never saw."""

    languages: list[str]
    order: int
    tables: list[list[Table]]
    unseen: np.ndarray
    slope: float = 8.0
    base: float = 0.0
    # Bits per letter that the calibration texts of a language hardly ever exceed.
    highest: float = 99.0

    def costs(self, words: list[str]) -> np.ndarray:
        """Bits that each language needs for each word, as words x languages."""
        signs, word, place = _joined(words)
        grams = [_hashes(signs, place, n) for n in range(1, self.order + 1)]
        scored = place > 0
        costs = np.zeros((len(words), len(self.languages)))
        for j, by_order in enumerate(self.tables):
            found = np.full(len(signs), self.unseen[j])
            # The back-off weight of the n-gram that ends at a sign, as a context of the next.
            weight = np.zeros(len(signs))
            for (ends, keys), table in zip(grams, by_order, strict=True):
                at, known = _find(table.keys, keys)
                longer = place[ends] > 0
                back = np.where(longer, weight[np.maximum(ends - 1, 0)], 0.0)
                # An n-gram that was not seen costs its context's back-off on top of the shorter one.
                spare = found[ends] + back
                weight = np.zeros(len(signs))
                if len(table.keys):
                    found[ends] = np.where(known, table.probabilities[at], spare)
                    weight[ends] = np.where(known, table.weights[at], 0.0)
                else:
                    found[ends] = spare
            costs[:, j] = -np.bincount(word[scored], weights=found[scored], minlength=len(words))
        return costs


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


def fit(counts: dict[str, dict[str, int]], order: int = 5, discount: float = 0.75) -> Model:
    """A model from word counts by language."""
    languages = sorted(counts)
    tables: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []
    for language in languages:
        words = list(counts[language])
        signs, word, place = _joined(words)
        often = np.array([counts[language][w] for w in words], np.float64)[word]
        by_order = []
        for n in range(1, order + 1):
            ends, keys = _hashes(signs, place, n)
            # The context is the n-gram without its last sign, the rest is it without its first.
            context = rest = np.zeros(len(ends), np.uint64)
            if n > 1:
                shorter, short_keys = _hashes(signs, place, n - 1)
                of = np.empty(len(signs), np.uint64)
                of[shorter] = short_keys
                context, rest = of[ends - 1], of[ends]
            unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
            number = np.bincount(inverse, weights=often[ends], minlength=len(unique))
            if n == 1:
                # The beginning is given, never guessed.
                number[signs[ends[first]] == 1] = 0
            by_order.append([unique, number, context[first], rest[first]])
        # Below the highest order, an n-gram counts the different signs before it; words begin with the same one.
        for n in range(order - 1, 0, -1):
            unique, number, _, _ = by_order[n - 1]
            at, known = _find(unique, by_order[n][3])
            before = np.bincount(at[known], minlength=len(unique)).astype(float)
            by_order[n - 1][1] = np.where(before > 0, before, number)
        tables.append(by_order)
    signs_seen = max(2, len(np.unique(np.concatenate([t[0][0] for t in tables]))) if tables else 2)
    unseen = np.full(len(languages), -np.log2(signs_seen + 1000.0))
    made = []
    for j, by_order in enumerate(tables):
        own: list[Table] = []
        for n, (unique, number, context, rest) in enumerate(by_order):
            if n == 0:
                total, kinds = number.sum(), (number > 0).sum()
                share = discount * kinds / max(total, 1)
                p = np.maximum(number - discount, 0) / max(total, 1) + share * 2.0 ** unseen[j]
            else:
                groups, inverse = np.unique(context, return_inverse=True)
                total = np.bincount(inverse, weights=number)
                kinds = np.bincount(inverse)
                share = discount * kinds / total
                at, _ = _find(own[-1].keys, rest)
                p = np.maximum(number - discount, 0) / total[inverse] + share[inverse] * 2.0 ** own[-1].probabilities[at]
                where, _ = _find(own[-1].keys, groups)
                own[-1].weights[where] = np.log2(share)
            own.append(Table(unique, np.log2(p), np.zeros(len(unique))))
        made.append(own)
    return Model(languages, order, made, unseen)


class Scorer:
    """Cross-entropies of texts under a model, remembering words."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Bits per letter (ends of words counted as one) for each text and language; nan without letters."""
        counts = [Counter(words_of(text)) for text in texts]
        new = set().union(*counts).difference(self.known) if counts else set()
        # A word's costs are a number for each language.
        if (len(self.known) + len(new)) * len(self.model.languages) > REMEMBERED:
            self.known, new = {}, set().union(*counts)
        ordered = list(new)
        step = max(64, 100_000 // max(1, len(self.model.languages)))
        for at in range(0, len(ordered), step):
            some = ordered[at : at + step]
            self.known.update(zip(some, self.model.costs(some), strict=True))
        found = np.full((len(texts), len(self.model.languages)), np.nan)
        for i, words in enumerate(counts):
            if words:
                costs = np.array([self.known[w] for w in words])
                number = np.fromiter(words.values(), float, len(words))
                letters = np.fromiter(map(len, words), float, len(words)) + 1
                found[i] = number @ costs / (number @ letters)
        if any(len(w) > _LONG for w in new):
            self.known = {w: c for w, c in self.known.items() if len(w) <= _LONG}
        return found


def calibrated(model: Model, hit: np.ndarray, margin: np.ndarray, lowest: np.ndarray) -> Model:
    """model with its score fitted to how often the language with the least bits is right, by texts' margins and least bits."""
    if len(hit) < 20:
        return model
    slope, base = model.slope, model.base
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + base, -30, 30)))
        # A weak pull to the beginning, as texts may leave nothing wrong to learn from.
        d_slope = ((hit - p) * margin).mean() - 0.001 * (slope - 8.0)
        d_base = (hit - p).mean() - 0.001 * base
        slope, base = slope + 4.0 * d_slope, base + 4.0 * d_base
    model.slope, model.base = float(max(slope, 0.5)), float(base)
    model.highest = float(np.quantile(lowest, 0.999) * 1.25 + 0.5)
    return model


def _margin(entropies: np.ndarray) -> np.ndarray:
    if entropies.shape[1] < 2:
        return np.full(len(entropies), 1.0)
    two = np.partition(entropies, 1, axis=1)
    return two[:, 1] - two[:, 0]


def train(
    labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", per_language: int = 3_000, order: int = 5
) -> Model | None:
    """A model from about per_language whole texts of each language; None if no row has a language and letters.

    A quarter of a language's distinct texts is set apart for calibration, the rest gives the counts; where all of them would be
    set apart, all give counts. Texts without a letter count for nothing.
    """
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where(
        "lang is not null and text is not null"
    )
    share = rows.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(per_language)) / F.count(F.lit(1))).alias("share"))
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / (1 << 30)
    # One row for each language, less than the model that every task gets: texts are chosen where they are read, and only the
    # sample is stored.
    sample = rows.join(F.broadcast(share), "lang").where(draw < F.col("share"))
    sample = sample.withColumn("held", F.pmod(F.xxhash64("text", F.lit(1)), F.lit(4)) == 0)
    # Copies are drawn alike, so they count once: no text can outgrow the sample.
    sample = stored(sample.select("lang", "text", "held").dropDuplicates(["lang", "text"]))
    emptied = sample.groupBy("lang").agg(F.min("held").alias("all_held")).where("all_held").select("lang", "all_held")
    sample = sample.join(F.broadcast(emptied), "lang", "left").withColumn("held", F.col("held") & F.col("all_held").isNull())

    def counted(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in found:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.setdefault(lang, Counter()).update(words_of(text))
        rows = [(lang, word, n) for lang, words in counts.items() for word, n in words.items()]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)],
            names=["lang", "word", "n"],
        )

    words = sample.where("not held").select("lang", "text").mapInArrow(counted, "lang string, word string, n long")
    counts: dict[str, dict[str, int]] = {}
    for row in words.groupBy("lang", "word").agg(F.sum("n").alias("n")).toLocalIterator():
        counts.setdefault(row.lang, {})[row.word] = row.n
    if not counts:
        return None
    model = fit(counts, order)
    sent = labelled.sparkSession.sparkContext.broadcast(model)

    def scored(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        names = {name: j for j, name in enumerate(scorer.model.languages)}
        for batch in found:
            for some in runs(list(zip(*(c.to_pylist() for c in batch.columns), strict=True)), CHARS_AT_ONCE, lambda row: row[1]):
                entropies = scorer.entropies([text for _, text in some])
                truth = np.array([names.get(lang, -1) for lang, _ in some])
                usable = ~np.isnan(entropies[:, 0]) & (truth >= 0)
                entropies, truth = entropies[usable], truth[usable]
                columns = [(entropies.argmin(1) == truth).astype(float), _margin(entropies), entropies.min(1)] if len(truth) else [np.empty(0)] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["hit", "margin", "lowest"])

    # Three numbers for each text of the bounded sample that was set apart.
    held = sample.where("held").select("lang", "text").mapInArrow(scored, "hit double, margin double, lowest double").toArrow()
    if held.num_rows:
        return calibrated(model, *(held.column(name).to_numpy() for name in ("hit", "margin", "lowest")))
    return model


def with_language(docs: DataFrame, model: Model | None, text_col: str = "text", *keep: Column | str) -> DataFrame:
    """The kept columns of every row of docs with lang_pred, score and rejected.

    lang_pred is the language of the lowest cross-entropy per letter, ties going to the first by name; score is the
    calibrated chance that it is right, less the nearer the text comes to what no language explains; rejected says that
    score is below a half or the text costs more than any calibration text. Without a letter, or a null text, or a
    model of None: lang_pred is und, score 0, rejected. Repeated rows keep a row each. No rows: no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*keep)
    said = "_text"
    while said in {c.lower() for c in kept.columns}:
        said += "_"
    kept = docs.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(said))

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value) if sent.value else None
        for whole in found:
            at = 0
            for texts in runs(whole.column(said).to_pylist(), CHARS_AT_ONCE, str):
                batch = whole.slice(at, len(texts))
                at += len(texts)
                languages, scores, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                if scorer:
                    entropies = scorer.entropies(texts)
                    model = scorer.model
                    usable = np.flatnonzero(~np.isnan(entropies[:, 0]))
                    some = entropies[usable]
                    if len(usable):
                        chance = 1 / (1 + np.exp(-np.clip(model.slope * _margin(some) + model.base, -30, 30)))
                        over = some.min(1) - model.highest
                        chance *= 1 / (1 + np.exp(np.clip(4 * over, -30, 30)))
                        scores[usable] = chance
                        rejected[usable] = (chance < 0.5) | (over > 0)
                        for i, best in zip(usable.tolist(), some.argmin(1).tolist(), strict=True):
                            languages[i] = model.languages[best]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(languages), pa.array(scores), pa.array(rejected)],
                    names=[*batch.schema.names[:-1], "lang_pred", "score", "rejected"],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.drop(said).schema.fields)
    return kept.mapInArrow(batches, (fields + ", " if fields else "") + "lang_pred string, score double, rejected boolean")
