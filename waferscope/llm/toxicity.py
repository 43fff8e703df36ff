"""Toxicity: a learned lexicon found in spite of misspellings, weighed by its context.

The lexicon is stems (beginnings of words) that occur in toxic training texts far more often than in others, in many
different contexts. It is held as a trie and intersected with Levenshtein automata of its terms; the states of the
intersection are made as words need them, so that a word is read once, letter by letter, whatever the lexicon's size.
Any letter may be wrong, also the first, and a digit or sign within a word may stand for a letter ('m0ron', 'st*pid').
A misspelling counts by how seldom such a form occurs in texts that are not toxic. Each hit is weighed by the words and
signs around it: quoted or reported words count less, words said to somebody more. A logistic model turns the weighed
hits of a text into a score.

The lexicon and the model are fitted on a bounded sample of labelled texts, `most_labelled` rows at most in expectation,
half of them of each label where there are as many. Scoring covers every whole text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from waferscope.llm.storage import stored

WORD = re.compile(r"[^\W\d_]+")
RUN = re.compile(r"\S+")
# A letter or digit at the start of a run, or after a sign.
BEGINNING = re.compile(r"(?<![^\W_])[^\W_]")
TAIL = re.compile(r"[^\W_]*")
SHORTEST, LONGEST = 3, 12
REMEMBERED = 400_000
STATES = 50_000
# Contexts counted for a stem in one task: enough to tell words that are used from words that are copied.
CONTEXTS = 64
WINDOW = 6

# Signs and words around a term that say it is quoted, or said to somebody.
OPENING, CLOSING = "\"'“„«‘‹", "\"'”“»’›"
REPORTING = frozenset("said says wrote quote quoted called word words term insult slur dit mot sagte wort dijo palabra".split())
ADDRESSING = frozenset("you your youre u ya tu toi vous du dich dir ihr usted eres te".split())


def errors_allowed(stem: str) -> int:
    return 0 if len(stem) < 5 else 1 if len(stem) < 8 else 2


class Automaton:
    """Stems within their allowed edit distance of a beginning of a word; the first letter must be right unless any_first."""

    def __init__(self, stems: list[str], any_first: bool = False):
        self.any_first = any_first
        self.children: list[dict[str, int]] = [{}]
        self.term: list[int] = [-1]
        self.allowed: list[int] = [0]
        self.stems = stems
        for number, stem in enumerate(stems):
            node, allowed = 0, errors_allowed(stem)
            for letter in stem:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(-1)
                    self.allowed.append(0)
                node = self.children[node][letter]
                self.allowed[node] = max(self.allowed[node], allowed)
            self.term[node] = number
        if any_first:
            self.allowed[0] = max(map(errors_allowed, stems), default=0)
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.states: list[dict[int, int]] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[list[tuple[int, int]]] = []
        self.start = self._number(self._reached([(0, 0)]) if self.any_first else {0: 0})

    def _number(self, nodes: dict[int, int]) -> int:
        key = frozenset(nodes.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(nodes)
            self.moves.append({})
            here = [(self.term[n], e) for n, e in nodes.items() if self.term[n] >= 0]
            self.accepts.append([(t, e) for t, e in here if e <= errors_allowed(self.stems[t])])
        return self.numbers[key]

    def _reached(self, starts: list[tuple[int, int]]) -> dict[int, int]:
        """The nodes of (node, errors), and those below them by letters left out, with the fewest errors of each."""
        after: dict[int, int] = {}

        def reach(node: int, errors: int) -> None:
            if errors <= self.allowed[node] and errors < after.get(node, 99):
                after[node] = errors
                for child in self.children[node].values():
                    reach(child, errors + 1)

        for node, errors in starts:
            reach(node, errors)
        return after

    def _move(self, state: int, letter: str) -> int:
        starts = []
        for node, errors in self.states[state].items():
            if letter in self.children[node]:
                starts.append((self.children[node][letter], errors))
            if node or self.any_first:
                starts += [(child, errors + 1) for child in self.children[node].values()]
                starts.append((node, errors + 1))
        after = self._reached(starts)
        self.moves[state][letter] = found = self._number(after) if after else -1
        return found

    def find(self, word: str) -> tuple[int, int] | None:
        """The stem that a beginning of the word fits best: (its number, edit distance); the longer one of equals."""
        if len(self.states) > STATES:
            self._forget()
        state, best = self.start, None
        for letter in word:
            state = self.moves[state].get(letter, -2) if state >= 0 else -1
            if state == -2:
                state = self._move(self._last, letter)
            if state < 0:
                break
            self._last = state
            for term, errors in self.accepts[state]:
                if best is None or (errors, -len(self.stems[term])) < (best[1], -len(self.stems[best[0]])):
                    best = term, errors
        self._last = self.start
        return best

    _last = 0


@dataclass
class Model:
    stems: list[str]
    weights: np.ndarray
    # Of a misspelt form of each stem.
    fuzzy_weights: np.ndarray
    coefficients: np.ndarray | None = None
    means: np.ndarray | None = None
    scales: np.ndarray | None = None


@dataclass
class Hits:
    """The weighed hits of one text: how often each (stem, misspelt) occurs, by weight of its context."""

    words: int
    found: dict[tuple[int, bool], float] = field(default_factory=dict)


class Reader:
    """Finds the terms of a lexicon in texts."""

    def __init__(self, model: Model):
        self.model, self.automaton = model, Automaton(model.stems, any_first=True)
        self.known: dict[str, tuple[int, int] | None] = {}
        self.known_runs: dict[str, list[tuple[int, int, tuple[int, int]]]] = {}
        # No beginning of a word that is longer than this fits a stem.
        self.longest = max((len(s) + errors_allowed(s) for s in model.stems), default=0)

    def hits(self, text: str) -> Hits:
        low = text.lower()
        words = WORD.findall(low)
        different = set(words)
        new = different.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, different
        for word in new:
            self.known[word] = self.automaton.find(word)
        made = Hits(len(words))
        wanted = {w: hit for w in different if (hit := self.known[w]) and (not hit[1] or self.model.fuzzy_weights[hit[0]] > 0)}
        if any(len(w) > 64 for w in new):
            self.known = {w: h for w, h in self.known.items() if len(w) <= 64}
        disguised = self._disguised(low)
        if wanted or disguised:
            places = [m for m in WORD.finditer(low)]
            met = [(i, m.start(), m.end(), hit) for i, m in enumerate(places) if (hit := wanted.get(m.group()))]
            if disguised:
                begins = [m.start() for m in places]
                for run in RUN.finditer(low):
                    for start, end, hit in disguised.get(run.group(), ()):
                        met.append((bisect_left(begins, run.start() + start), run.start() + start, run.start() + end, hit))
            for i, start, end, hit in met:
                key = hit[0], hit[1] > 0
                made.found[key] = made.found.get(key, 0.0) + self._context(low, words, i, start, end)
        return made

    def _counts(self, hit: tuple[int, int] | None) -> bool:
        return hit is not None and (not hit[1] or self.model.fuzzy_weights[hit[0]] > 0)

    def _disguised(self, low: str) -> dict[str, list[tuple[int, int, tuple[int, int]]]]:
        """Runs without white space in which terms are spelled with digits or signs: where each begins and ends, and its hit."""
        runs = {run for run in low.split() if not run.isalpha()}
        new = runs.difference(self.known_runs)
        if len(self.known_runs) + len(new) > REMEMBERED:
            self.known_runs, new = {}, runs
        for run in new:
            self.known_runs[run] = self._spelled_with_signs(run)
        found = {run: hits for run in runs if (hits := self.known_runs[run])}
        if any(len(r) > 64 for r in new):
            self.known_runs = {r: h for r, h in self.known_runs.items() if len(r) <= 64}
        return found

    def _spelled_with_signs(self, run: str) -> list[tuple[int, int, tuple[int, int]]]:
        """Terms that begin after a sign, or at the run's start, with digits and signs read as letters; not where plain words hit."""
        found, done, plain = [], 0, None
        for place in BEGINNING.finditer(run):
            start = place.start()
            form = run[start : start + self.longest]
            if start < done or form.isalpha() or not self._counts(hit := self.automaton.find(form)):
                continue
            if plain is None:
                plain = [m.start() for m in WORD.finditer(run) if self._counts(self.automaton.find(m.group()))]
            end = min(len(run), start + len(self.model.stems[hit[0]]) + hit[1])
            if bisect_left(plain, start) == bisect_left(plain, end):
                # The word's end: not in its middle, nor behind a sign that follows it.
                while not run[end - 1].isalnum():
                    end -= 1
                end += len(TAIL.match(run, end).group())
                found.append((start, end, hit))
                done = end
        return found

    def _context(self, low: str, words: list[str], i: int, start: int, end: int) -> float:
        """How much a hit counts by the window around it: 0.25 for a quoted and reported term to 1.25 for an address."""
        before = words[max(0, i - WINDOW) : i]
        near = set(before) | set(words[i + 1 : i + 1 + WINDOW])
        direct = start > 0 and low[start - 1] in OPENING and end < len(low) and low[end] in CLOSING
        left, right = low[max(0, start - 8 * WINDOW) : start], low[end : end + 8 * WINDOW]
        passage = sum(left.count(c) for c in "\"“„«") % 2 == 1 and any(c in right for c in "\"”“»")
        quoted = 0.5 if direct else 0.25 if passage else 0.0
        if quoted or near & REPORTING:
            quoted += 0.25 if near & REPORTING else 0.0
            return 1.0 - quoted
        return 1.25 if near & ADDRESSING else 1.0


def features(hits: Hits, model: Model) -> list[float]:
    exact = sum(model.weights[t] * n for (t, wrong), n in hits.found.items() if not wrong)
    wrong = sum(model.fuzzy_weights[t] * n for (t, wrong), n in hits.found.items() if wrong)
    kinds = len({t for t, _ in hits.found})
    total = exact + wrong
    return [np.log1p(total), np.log1p(100 * total / (hits.words + 20)), float(min(kinds, 8))]


def _rising(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression in which no feature counts against toxicity: one that would is left out."""
    used = np.arange(x.shape[1])
    while True:
        fitted = _logistic(x[:, used], y, weight)
        if (fitted[:-1] >= 0).all():
            break
        used = np.delete(used, fitted[:-1].argmin())
    made = np.zeros(x.shape[1] + 1)
    made[used], made[-1] = fitted[:-1], fitted[-1]
    return made


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps; the last coefficient is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty * b
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        b = b - step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return b


def scores(x: np.ndarray, model: Model) -> np.ndarray:
    """Score of each row of features."""
    z = (x - model.means) / model.scales
    z = np.column_stack([z, np.ones(len(z))]) @ model.coefficients
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _stems_of(words: list[str]) -> dict[str, set[str]]:
    """Stems of a text with the words that come before them."""
    found: dict[str, set[str]] = {}
    for last, word in zip(["", *words], words, strict=False):
        for length in range(SHORTEST, min(len(word), LONGEST) + 1):
            found.setdefault(word[:length], set()).add(last)
    return found


def _candidates(toxic: DataFrame, least: int) -> dict[str, tuple[int, int]]:
    """Stems that at least `least` of the toxic texts have: how many texts, and in how many contexts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: Counter = Counter()
        # Most stems have one context, which needs no set of its own.
        contexts: dict[str, str | set[str]] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for stem, before in _stems_of(WORD.findall(text.lower())).items():
                    docs[stem] += 1
                    known = contexts.get(stem)
                    if known is None:
                        contexts[stem] = next(iter(before)) if len(before) == 1 else before
                    elif isinstance(known, str):
                        contexts[stem] = before | {known} if before != {known} else known
                    elif len(known) < CONTEXTS:
                        known |= before
        stems = list(docs)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(stems, pa.string()),
                pa.array([docs[s] for s in stems], pa.int64()),
                pa.array([[c] if isinstance(c := contexts[s], str) else sorted(c)[:CONTEXTS] for s in stems], pa.list_(pa.string())),
            ],
            names=["stem", "docs", "contexts"],
        )

    parts = toxic.select("text").mapInArrow(counted, "stem string, docs long, contexts array<string>")
    found = parts.groupBy("stem").agg(
        F.sum("docs").alias("docs"), F.size(F.array_distinct(F.flatten(F.collect_list("contexts")))).alias("contexts")
    )
    return {r.stem: (r.docs, r.contexts) for r in found.where(F.col("docs") >= least).collect()}


def _occurrences(clean: DataFrame, stems: set[str]) -> dict[str, int]:
    """In how many of the clean texts each of the stems occurs."""
    sent = clean.sparkSession.sparkContext.broadcast(stems)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = set(WORD.findall(text.lower()))
                docs.update({w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)} & sent.value)
        yield pa.RecordBatch.from_arrays([pa.array(list(docs), pa.string()), pa.array(list(docs.values()), pa.int64())], names=["stem", "docs"])

    parts = clean.select("text").mapInArrow(counted, "stem string, docs long")
    return {r.stem: r.docs for r in parts.groupBy("stem").agg(F.sum("docs").alias("docs")).collect()}


def lexicon(
    toxic: dict[str, tuple[int, int]], clean: dict[str, int], n_toxic: int, n_clean: int, most: int = 2_000, least_gain: float = 30.0
) -> dict[str, float]:
    """Stems with their weight in bits: at least four times likelier in toxic texts, beyond chance, and not by copies.

    Of stems that begin with one another only the most telling stays.
    """
    ranked = []
    for stem, (docs, contexts) in toxic.items():
        other = clean.get(stem, 0)
        weight = np.log2((docs + 0.5) / (n_toxic + 1) / ((other + 0.5) / (n_clean + 1)))
        expected = (docs + other) * n_toxic / (n_toxic + n_clean)
        spare = docs + other - expected
        gain = 2 * (docs * np.log(docs / expected) + (other * np.log(other / spare) if other else 0.0))
        if weight >= 2 and gain >= least_gain and contexts >= max(4, 0.3 * min(docs, CONTEXTS)):
            ranked.append((gain, len(stem), stem, weight))
    chosen: dict[str, float] = {}
    beginnings: set[str] = set()
    for _, _, stem, weight in sorted(ranked, reverse=True):
        if len(chosen) == most:
            break
        if stem not in beginnings and not any(stem[:n] in chosen for n in range(SHORTEST, len(stem))):
            chosen[stem] = float(weight)
            beginnings.update(stem[:n] for n in range(SHORTEST, len(stem) + 1))
    return chosen


def train(docs: DataFrame, labels: DataFrame, most_labelled: int = 16_000, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """A model from the labels (doc_id, toxic 0 or 1) of docs, or None if either label has no text.

    A label is one per id (toxic if any row says so); rows without an id, a label or a text teach nothing. Labels are sampled
    by a hash of the id before they meet the texts, so texts are not shuffled: the sample is small enough to broadcast.
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    count = known.groupBy("toxic").count().collect()
    if len(count) < 2:
        return None
    total = sum(r["count"] for r in count)
    # What one label leaves of its half the other may use.
    fewer = min(r["count"] for r in count)
    room = {r.toxic: max(most_labelled // 2, most_labelled - fewer) if r["count"] > fewer else most_labelled // 2 for r in count}
    share = {r.toxic: min(1.0, room[r.toxic] / r["count"]) for r in count}
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / (1 << 30)
    drawn = known.where(draw < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    sample = stored(texts.join(F.broadcast(drawn), "id").select("text", "toxic"))
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    weight = {t: next(r["count"] for r in count if r.toxic == t) / total / sizes[t] * sum(sizes.values()) for t in sizes}
    toxic, clean = sample.where("toxic = 1"), sample.where("toxic = 0")
    wanted = _candidates(toxic, least=max(4, sizes[1] // 400))
    terms = lexicon(wanted, _occurrences(clean, set(wanted)), sizes[1], sizes[0])
    model = Model(list(terms), np.array(list(terms.values())), np.ones(len(terms)))
    # Once with every misspelling counted, to see how many of them occur in clean texts.
    rows = _read(sample, model)
    wrong = np.zeros((2, len(terms)))
    for label, hits in rows:
        for term, is_wrong in hits.found:
            if is_wrong:
                wrong[label, term] += 1
    bits = np.log2((wrong[1] + 0.5) / (sizes[1] + 1) / ((wrong[0] + 0.5) / (sizes[0] + 1)))
    # Forms that never occurred are taken for misspellings, one in twenty of the term's own occurrences.
    prior = np.log2(0.05 * np.exp2(model.weights) / (1 + 40.0 * wrong[0]))
    model.fuzzy_weights = np.clip(np.where(wrong.sum(0) >= 10, bits, prior), 0, model.weights)
    model.fuzzy_weights[model.fuzzy_weights < 1] = 0
    x = np.array([features(hits, model) for _, hits in rows])
    y = np.array([label for label, _ in rows], float)
    model.means, model.scales = x.mean(0), np.maximum(x.std(0), 1e-6)
    model.coefficients = _rising((x - model.means) / model.scales, y, np.array([weight[int(v)] for v in y]))
    return model


def _read(sample: DataFrame, model: Model) -> list[tuple[int, Hits]]:
    sent = sample.sparkSession.sparkContext.broadcast(model)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(sent.value)
        for batch in found:
            hits = [reader.hits(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    pa.array([h.words for h in hits], pa.int64()),
                    pa.array([[t * 2 + w for t, w in h.found] for h in hits], pa.list_(pa.int64())),
                    pa.array([list(h.found.values()) for h in hits], pa.list_(pa.float64())),
                ],
                names=["toxic", "words", "terms", "counts"],
            )

    kind = sample.schema["toxic"].dataType.simpleString()
    rows = sample.select("text", "toxic").mapInArrow(batches, f"toxic {kind}, words long, terms array<long>, counts array<double>")
    return [
        (r.toxic, Hits(r.words, {(t // 2, bool(t % 2)): n for t, n in zip(r.terms, r.counts, strict=True)}))
        for r in rows.collect()  # bounded by the sample
    ]


def with_scores(docs: DataFrame, model: Model | None, text_col: str, *keep: Column | str) -> DataFrame:
    """The kept columns of every row of docs with toxicity (0 to 1), and hits, the number of weighed terms.

    Null and empty texts are scored as texts without terms. Without a model every score is 0. Repeated rows keep a row
    each. No rows: no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        reader = Reader(model) if model else None
        for whole in found:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                made, number = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
                if reader:
                    hits = [reader.hits(t or "") for t in batch.column("_text").to_pylist()]
                    made = scores(np.array([features(h, model) for h in hits]), model)
                    number = np.array([sum(h.found.values()) for h in hits], float)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(made), pa.array(number)],
                    names=[*batch.schema.names[:-1], "toxicity", "hits"],
                )

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.drop("_text").schema.fields)
    return kept.mapInArrow(batches, f"{fields}toxicity double, hits double")


def without_toxic(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of docs that score below the threshold, all columns kept, without a shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        reader = Reader(model) if model else None
        for whole in found:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                if reader:
                    hits = [reader.hits(t or "") for t in batch.column(text_col).to_pylist()]
                    batch = batch.filter(pa.array(scores(np.array([features(h, model) for h in hits]), model) < threshold))
                yield batch

    return docs.mapInArrow(batches, docs.schema)
