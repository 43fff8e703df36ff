"""Benchmark passages in documents, exact or edited: rare n-gram seeds, then Smith-Waterman alignment of words.

Two scans of the documents, both without a shuffle of texts. The first counts in how many documents each n-gram of the
benchmark occurs, over all documents. In the second, a rare n-gram is a seed by itself and a frequent one if another of the same
item is near it: a common phrase alone starts nothing, and a passage that a third of all documents hold, and whose n-grams are
thus frequent, still has its seeds. The item is then aligned with the words around its seeds.

The benchmark is taken in blocks of bounded size, so that what is sent to the tasks does not grow with it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WORD = re.compile(r"\w+")
# Bytes of items that are sent to the tasks at once.
BLOCK_BYTES = 16 << 20
_TEXT_AT_ONCE = 2_000_000


@dataclass(frozen=True)
class Rules:
    """What counts as a seed and as contamination; lengths are in words.

    An n-gram of seed_words is rare in at most rare_documents documents, or rare_share of them if that is more.

    An alignment scores 1 for a matching word and takes off half for a replaced, added or missing one. It counts from
    `share` of the item on, but from `least` words at least (a shorter item: all of it) and from `enough` words always.
    """

    seed_words: int = 4
    rare_documents: int = 10
    rare_share: float = 0.0001
    share: float = 0.5
    least: float = 8.0
    enough: float = 13.0

    def needed(self, length: int) -> float:
        return min(length, self.enough, max(self.least, self.share * length))


def lowered(text: str) -> str:
    """Lower case, sign for sign, so that places stay those of the text."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _grams(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of the n-grams without a 0."""
    if len(words) < n:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    known = words != 0
    whole = known[: len(words) - n + 1].copy()
    for i in range(1, n):
        whole &= known[i : len(words) - n + 1 + i]
    at = np.flatnonzero(whole)
    keys = np.zeros(len(at), np.uint64)
    for i in range(n):
        keys = (keys ^ words[at + i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return at, keys


@dataclass
class Items:
    """A block of benchmark items as word numbers, and the seeds that point into them."""

    ids: list
    words: list[np.ndarray]
    vocabulary: dict[str, int]
    rules: Rules
    grams: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    # For each n-gram of each item, sorted by key: the item, the place in it, and whether it is rare.
    seeds: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None = None

    @staticmethod
    def of(rows: list[tuple[object, str]], rules: Rules) -> Items:
        vocabulary: dict[str, int] = {}
        words = [
            np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in WORD.findall(lowered(text))], np.int64)
            for _, text in rows
        ]
        keys = [_grams(w, rules.seed_words)[1] for w in words]
        grams = np.unique(np.concatenate([*keys, np.empty(0, np.uint64)]))
        return Items([i for i, _ in rows], words, vocabulary, rules, grams)

    def mark_rare(self, documents: np.ndarray, total: int) -> None:
        """documents: in how many documents each of grams occurs, of a total."""
        found = [_grams(words, self.rules.seed_words) for words in self.words]
        if found:
            key = np.concatenate([keys for _, keys in found])
            place = np.concatenate([at for at, _ in found])
            item = np.repeat(np.arange(len(found)), [len(at) for at, _ in found])
            often = documents[np.searchsorted(self.grams, key)]
            rare = often <= max(self.rules.rare_documents, self.rules.rare_share * total)
            order = np.lexsort((place, item, key))
            self.seeds = key[order], item[order], place[order], rare[order]

    def numbered(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of texts, 0 for words no item has and after each text; and where each text begins."""
        found = [WORD.findall(lowered(text)) for text in texts]
        starts = np.cumsum([0, *[len(words) + 1 for words in found]])
        numbers = np.zeros(starts[-1], np.int64)
        get = self.vocabulary.get
        for start, words in zip(starts.tolist(), found, strict=False):
            numbers[start : start + len(words)] = np.fromiter(map(get, words, repeat(0)), np.int64, len(words))
        return numbers, starts

    def gram_documents(self, texts: list[str]) -> np.ndarray:
        """For each of grams, the number of the texts that have it."""
        numbers, starts = self.numbered(texts)
        at, keys = _grams(numbers, self.rules.seed_words)
        place = np.searchsorted(self.grams, keys)
        place[place == len(self.grams)] = 0
        hit = self.grams[place] == keys if len(self.grams) else np.zeros(len(keys), bool)
        text = np.searchsorted(starts, at[hit], "right") - 1
        pairs = np.unique(np.stack([text, place[hit]]), axis=1)
        return np.bincount(pairs[1], minlength=len(self.grams))

    def matches(self, texts: list[str]) -> list[tuple[int, object, float, float, list[tuple[int, int]]]]:
        """(text, item id, best score, its share of the item, character spans) for each item a text holds."""
        if self.seeds is None:
            return []
        numbers, starts = self.numbered(texts)
        at, keys = _grams(numbers, self.rules.seed_words)
        low, high = (np.searchsorted(self.seeds[0], keys, side) for side in ("left", "right"))
        hit = high > low
        at, low, high = at[hit], low[hit], high[hit]
        each = high - low
        at = np.repeat(at, each)
        seed = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(low, each)
        item, place, rare = (x[seed] for x in self.seeds[1:])
        text = np.searchsorted(starts, at, "right") - 1
        order = np.lexsort((at - place, item, text))
        found = []
        at, item, place, rare, text = (x[order] for x in (at, item, place, rare, text))
        cuts = np.flatnonzero((np.diff(text) != 0) | (np.diff(item) != 0)) + 1
        for some in np.split(np.arange(len(at)), cuts) if len(at) else []:
            t, i = int(text[some[0]]), int(item[some[0]])
            words = self.words[i]
            slack = max(8, len(words) // 2)
            best, spans = 0.0, []
            windows = _merged(at[some] - place[some] - slack, len(words) + 2 * slack, starts[t], starts[t + 1] - 1)
            for a, b, first, last in windows:
                near = some[first:last]
                if not rare[near].any() and len(np.unique(place[near])) < 2:
                    continue
                score, start, end = align(numbers[a:b], words)
                if score >= self.rules.needed(len(words)):
                    best = max(best, score)
                    spans.append((int(a - starts[t]) + start, int(a - starts[t]) + end))
            if spans:
                found.append((t, self.ids[i], best, best / len(words), _characters(texts[t], spans)))
        return found


def _merged(begins: np.ndarray, length: int, first: int, last: int) -> list[tuple[int, int, int, int]]:
    """Windows from sorted beginnings, clipped and joined where they overlap, with the beginnings that each holds."""
    windows: list[tuple[int, int, int, int]] = []
    for i, begin in enumerate(begins.tolist()):
        a, b = max(begin, int(first)), min(begin + length, int(last))
        if windows and a <= windows[-1][1]:
            windows[-1] = windows[-1][0], max(b, windows[-1][1]), windows[-1][2], i + 1
        else:
            windows.append((a, b, i, i + 1))
    return windows


def _characters(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    words = [m.span() for m in WORD.finditer(lowered(text))]
    return [(words[a][0], words[b - 1][1]) for a, b in spans]


def _best_end(text: np.ndarray, item: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment: its score, and the word of the text and of the item at which it ends."""
    fall = 0.5 * np.arange(len(text) + 1)
    above = np.zeros(len(text) + 1)
    best = (0.0, 0, 0)
    for i, word in enumerate(item.tolist()):
        row = np.zeros(len(text) + 1)
        row[1:] = above[:-1] + np.where(text == word, 1.0, -0.5)
        np.maximum(row, above - 0.5, out=row)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + fall) - fall
        end = int(np.argmax(row))
        if row[end] > best[0]:
            best = float(row[end]), end, i + 1
        above = row
    return best


def align(text: np.ndarray, item: np.ndarray) -> tuple[float, int, int]:
    """Smith-Waterman over words: the best local score, and the stretch of the text that has it."""
    score, end, item_end = _best_end(text, item)
    if not score:
        return 0.0, 0, 0
    _, length, _ = _best_end(text[:end][::-1], item[:item_end][::-1])
    return score, end - length, end


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[str]]]:
    """Runs of a batch's texts of bounded size, with the row each begins at; null is empty."""
    start, texts, size = 0, [], 0
    for i, value in enumerate(batch.column(column)):
        texts.append(value.as_py() or "")
        size += len(texts[-1])
        if size > _TEXT_AT_ONCE:
            yield start, texts
            start, texts, size = i + 1, [], 0
    if texts:
        yield start, texts


def blocks(benchmark: DataFrame, rules: Rules, id_col: str = "item_id", text_col: str = "text") -> Iterator[Items]:
    """The benchmark's items in blocks of about BLOCK_BYTES, dealt by a hash. Items without text are left out."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // BLOCK_BYTES)
    for block in range(count):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(count)) == block).collect()
        yield Items.of(sorted(((r.id, r.text) for r in rows), key=lambda r: (str(r[0]), r[1])), rules)


def _with_seeds(docs: DataFrame, text_col: str, items: Items) -> Items:
    """items, whose n-grams are marked rare or not by how many of all docs have them."""

    def counted(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros(len(items.grams), np.int64), 0
        for batch in found:
            rows += batch.num_rows
            for _, texts in _texts(batch, text_col):
                counts += items.gram_documents(texts)
        have = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(have, -1)), pa.array(np.append(counts[have], rows))], names=["gram", "docs"]
        )

    sums = docs.select(text_col).mapInArrow(counted, "gram long, docs long").groupBy("gram").agg(F.sum("docs").alias("docs"))
    documents, total = np.zeros(len(items.grams), np.int64), 0
    for row in sums.collect():  # one row for each n-gram of a block at most
        if row.gram < 0:
            total = row.docs
        else:
            documents[row.gram] = row.docs
    items.mark_rare(documents, total)
    return items


MATCH = "item_id long, score double, share double, spans array<struct<start:int,end:int>>"


def contamination(
    docs: DataFrame, benchmark: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, item_id, score, share, spans): one row for each row of docs and item of the benchmark found in it.

    spans are where, in code points. Words are compared in lower case. Null and empty texts hold nothing, an item with fewer
    words than a seed is not looked for. Repeated rows of docs are reported each; repeated items too. Rows without
    an id are reported with a null one. No documents or no items: no rows. Both ids must be whole numbers.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id long, {MATCH}"
    result = spark.createDataFrame([], schema)
    for block in blocks(benchmark, rules):
        items = _with_seeds(narrow, "text", block)
        sent = spark.sparkContext.broadcast(items)

        def batches(found: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in found:
                rows = []
                for start, texts in _texts(batch, "text"):
                    for t, item, score, share, spans in sent.value.matches(texts):
                        where = [{"start": a, "end": b} for a, b in spans]
                        rows.append((batch.column(0)[start + t].as_py(), item, score, share, where))
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                    names=["doc_id", "item_id", "score", "share", "spans"],
                )

        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
        result = result.unionByName(narrow.mapInArrow(batches, schema))
    return result


def decontaminated(docs: DataFrame, benchmark: DataFrame, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """The rows of docs that hold no item of the benchmark, all columns kept, without a shuffle."""
    for block in blocks(benchmark, rules):
        sent = docs.sparkSession.sparkContext.broadcast(_with_seeds(docs, text_col, block))

        def batches(found: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in found:
                clean = np.ones(batch.num_rows, bool)
                for start, texts in _texts(batch, text_col):
                    for t, *_ in sent.value.matches(texts):
                        clean[start + t] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(batches, docs.schema)
    return docs
