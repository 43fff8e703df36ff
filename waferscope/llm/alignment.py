"""Alignment of two tokenizers over a corpus, each distinct text once.

Documents are shuffled by their full text, so that equal texts become one row with their number. That row is tokenised by both
tokenizers and aligned: byte offsets where tokens of both end cut the text into groups, and every token of a group is linked with
every token of the other tokenizer in it. A pair of ids counts each text as often as documents hold it. The measures go back to
documents by the text's SHA-256 digest.

Texts are taken up in runs of about the same number of bytes and cut at spaces where both tokenizers start anew. The distinct pieces that
a task has not met are encoded and aligned at once, in flat arrays that it keeps, from which the runs' texts are put together.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from waferscope.llm.batches import slices
from waferscope.llm.skew import with_facts
from waferscope.llm.storage import stored

BYTES_AT_ONCE = 1 << 20
_ENCODED_AT_ONCE = 16_384
# Distinct pieces, and their signs, that a task remembers: a memory bound only, as forgotten pieces are aligned again.
REMEMBERED = 200_000
REMEMBERED_CHARS = 6_000_000
# Pairs that hold over one in FREQUENT of all pair counts: so many at most, sent to every task.
FREQUENT = 200_000
# Links of a group that are made one by one; of longer groups ids are counted first.
LONG_GROUP = 4_096
_SEPARATORS = ";,|"
# Runs in which an encoder by ranks takes time that grows with the square of the run.
LONG_RUN = 400
_LONG_RUN = re.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")
# Spaces that a tokenizer may join with white space around them.
_OTHER_SPACES = re.compile(r"^ | $| [\s\x85\x1c-\x1f]|\0")
_MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def _path(name: str) -> str:
    return name if "/" in name else public_tokenizers.path(name)


def _byte_alphabet() -> dict[str, int]:
    """The sign that byte-level BPE writes for each byte: printable bytes as they are, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(others)}


def byte_level_bytes(token: str, alphabet: dict[str, int]) -> bytes:
    return b"".join(bytes([alphabet[c]]) if c in alphabet else c.encode() for c in token)


def piece_bytes(piece: str) -> bytes:
    byte = re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()


def _ranked(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _among(ends: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of sorted numbers are among others, sorted too and with the same last one."""
    return others[np.searchsorted(others, ends)] == ends if len(ends) else np.zeros(0, bool)


def pieces(text: str) -> list[str]:
    """A text cut at spaces before which both tokenizers end a token and with which both begin one; whole if it has others."""
    return [text] if _OTHER_SPACES.search(text) else text.split(" ")


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of ranges, one range after another."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Growing:
    """A numpy array that rows are added to."""

    def __init__(self, kind: type, width: int | None = None):
        self.held, self.size = np.zeros((1_024,) if width is None else (1_024, width), kind), 0

    def add(self, rows: np.ndarray) -> None:
        while self.size + len(rows) > len(self.held):
            self.held = np.concatenate([self.held, np.zeros_like(self.held)])
        self.held[self.size : self.size + len(rows)] = rows
        self.size += len(rows)


class Spelled:
    """The bytes of numbered tokens, one after another."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array(list(map(len, tokens)), np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens with these numbers."""
        return self.bytes[_ranges(self.first[ids], self.size[ids])]


class Aligner:
    """Both tokenizers, and the alignments of the pieces of text that a task remembers."""

    def __init__(self, byte_level: str, piece_model: str, ranks: str | None = None):
        self.a = Tokenizer.from_file(_path(byte_level))
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.ranked = _ranked(_path(ranks)) if ranks else None
        self.b = SentencePieceProcessor(model_file=_path(piece_model))
        alphabet = _byte_alphabet()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = byte_level_bytes(token, alphabet)
        self.b_bytes = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.vocab_size())]
        self.spelled = [Spelled(side) for side in (self.a_bytes, self.b_bytes)]
        # A pair of ids is one number; with a text's number before it, it must stay below 2**63.
        self.base = len(self.b_bytes)
        self.span = len(self.a_bytes) * self.base
        if self.span >= 1 << 42:
            raise ValueError("the two vocabularies have 2**42 pairs of ids or more")
        # Every id as text after each of the separators.
        self.most = max(len(self.a_bytes), self.base)
        self.written = Spelled([f"{sign}{i}".encode() for sign in _SEPARATORS for i in range(self.most)])
        if any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(self.base)):
            raise ValueError("a piece of the second tokenizer goes on after a space")
        self._forget()

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of a space and each text; by the ranks of the same vocabulary, which is faster, where no run is long."""
        if not self.ranked:
            return [found.ids for found in self.a.encode_batch_fast([" " + text for text in texts], add_special_tokens=False)]
        made = [None if len(text) >= LONG_RUN and _LONG_RUN.search(text) else self.ranked.encode_ordinary(" " + text) for text in texts]
        others = [n for n, ids in enumerate(made) if ids is None]
        for n, found in zip(others, self.a.encode_batch_fast([" " + texts[n] for n in others], add_special_tokens=False), strict=True):
            made[n] = found.ids
        return made

    def _tokens(self, texts: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Ids of both tokenizers one text after another, and how many of each text; none where tokens' bytes are not a space and the text."""
        said = [b" " + text.encode() for text in texts]
        sizes = np.array(list(map(len, said)), np.int64)
        fits = np.ones(len(texts), bool)
        sides = []
        for by_text, spelled in zip((self.encode_a(texts), self.b.encode(texts, num_threads=1)), self.spelled, strict=True):
            number = np.array(list(map(len, by_text)), np.int64)
            ids = np.fromiter(chain.from_iterable(by_text), np.int64, int(number.sum()))
            ends = np.concatenate([[0], np.cumsum(spelled.size[ids])])[np.cumsum(number)]
            fits &= np.diff(ends, prepend=0) == sizes
            sides.append((ids, number, spelled))
        # Of texts with the right number of bytes, the bytes themselves.
        whole = np.frombuffer(b"".join([text for text, ok in zip(said, fits.tolist(), strict=True) if ok]), np.uint8)
        able, of = np.flatnonzero(fits), sizes[fits]
        for ids, number, spelled in sides:
            same = spelled.joined(ids[np.repeat(fits, number)]) == whole
            if len(able):
                fits[able] &= np.logical_and.reduceat(same, np.cumsum(of) - of)
        a, b = ((ids[np.repeat(fits, number)], np.where(fits, number, 0)) for ids, number, _ in sides)
        return a, b

    def _aligned(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """For each text whether its tokens fit, its measures, the size of its groups as text and the number of its distinct pairs; then the
        groups as bytes, each after a semicolon, the pairs' numbers and how often each is linked."""
        (a, n_a), (b, n_b) = self._tokens(texts)
        # Both cover the same bytes of each text, so their ends can be compared over all texts at once.
        a_ends, b_ends = np.cumsum(self.spelled[0].size[a]), np.cumsum(self.spelled[1].size[b])
        shared_a, shared_b = _among(a_ends, b_ends), _among(b_ends, a_ends)
        a_group, b_group = np.cumsum(shared_a) - shared_a, np.cumsum(shared_b) - shared_b
        groups = int(shared_a.sum())
        a_in, b_in = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        a_text = np.repeat(np.arange(len(texts)), n_a)
        group_text = a_text[shared_a]
        n_groups = np.bincount(group_text, minlength=len(texts))
        n_links = np.zeros(len(texts), np.int64)
        np.add.at(n_links, group_text, a_in * b_in)
        keys, times = self._pairs(a, b, a_group, b_in, np.cumsum(b_in) - b_in, a_in, a_text)
        written = self._written(a, b, a_group, b_group, a_in, b_in)
        ends = np.concatenate([[0], np.cumsum(self.written.size[written])])[np.cumsum(n_a + n_b)]
        pairs = np.bincount(keys // self.span, minlength=len(texts))
        measures = np.stack([n_a, n_b, n_groups, n_links], axis=1)
        return n_a > 0, measures, np.diff(ends, prepend=0), pairs, self.written.joined(written), keys % self.span, times

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.fits, self.measures = Growing(bool), Growing(np.int64, len(_MEASURES))
        # Where a piece's groups as text and its pairs begin, and how many they are.
        self.groups_at, self.pairs_at = Growing(np.int64, 2), Growing(np.int64, 2)
        self.groups, self.keys, self.times = Growing(np.uint8), Growing(np.int64), Growing(np.int64)

    def _learn(self, wanted: set[str]) -> None:
        """Remembers at least the wanted pieces until the next call."""
        new = [piece for piece in wanted if piece not in self.number]
        chars = sum(map(len, new))
        if len(self.number) + len(new) > REMEMBERED or self.chars + chars > REMEMBERED_CHARS:
            self._forget()
            new = list(wanted)
            chars = sum(map(len, new))
        self.chars += chars
        for at in range(0, len(new), _ENCODED_AT_ONCE):
            some = new[at : at + _ENCODED_AT_ONCE]
            fits, measures, written, pairs, groups, keys, times = self._aligned(some)
            self.number.update(zip(some, range(self.fits.size, self.fits.size + len(some)), strict=True))
            self.groups_at.add(np.stack([self.groups.size + np.cumsum(written) - written, written], axis=1))
            self.pairs_at.add(np.stack([self.keys.size + np.cumsum(pairs) - pairs, pairs], axis=1))
            for held, found in ((self.fits, fits), (self.measures, measures), (self.groups, groups), (self.keys, keys), (self.times, times)):
                held.add(found)

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], list[np.ndarray], list[np.ndarray]]:
        """For each text, none of them empty, its measures, the digest of its groups, the numbers of its distinct pairs and how often
        each is linked.

        A text whose tokens' bytes are not a space and the text has zeros, an empty digest and no pairs.
        """
        cut = list(map(pieces, texts))
        self._learn(set(chain.from_iterable(cut)))
        places = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64)
        sizes = np.array(list(map(len, cut)), np.int64)
        firsts = np.cumsum(sizes) - sizes
        fits = np.logical_and.reduceat(self.fits.held[places], firsts)
        measures = np.where(fits[:, None], np.add.reduceat(self.measures.held[places], firsts, axis=0), 0)
        places, sizes = places[np.repeat(fits, sizes)], np.where(fits, sizes, 0)
        text = np.repeat(np.arange(len(texts)), sizes)

        at, widths = self.groups_at.held[places].T
        groups = memoryview(self.groups.held[_ranges(at, widths)])
        ends = np.concatenate([[0], np.cumsum(widths)])[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        # Each group is written after a semicolon, which the first one of a text has none of.
        digests = [hashlib.sha256(groups[a + 1 : b]).hexdigest() if b > a else "" for a, b in zip(ends, ends[1:], strict=False)]

        at, widths = self.pairs_at.held[places].T
        found = _ranges(at, widths)
        joined, times = np.repeat(text, widths) * self.span + self.keys.held[found], self.times.held[found]
        if times.sum() <= 4 * len(times):
            joined, times = np.unique(np.repeat(joined, times), return_counts=True)
        else:
            joined, of = np.unique(joined, return_inverse=True)
            whole = np.zeros(len(joined), np.int64)
            np.add.at(whole, of, times)
            times = whole
        bounds = np.searchsorted(joined, np.arange(1, len(texts)) * self.span)
        return measures, digests, np.split(joined % self.span, bounds), np.split(times, bounds)

    def _pairs(
        self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_in: np.ndarray, b_first: np.ndarray, a_in: np.ndarray, a_text: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The distinct (text, pair) of all links, as one number each, and how often each is linked."""
        small = (a_in * b_in <= LONG_GROUP)[a_group]
        some, of = a[small], a_group[small]
        widths = b_in[of]
        right = np.repeat(b_first[of], widths) + np.arange(widths.sum()) - np.repeat(np.cumsum(widths) - widths, widths)
        keys, times = np.unique(np.repeat(a_text[small] * self.span + some * self.base, widths) + b[right], return_counts=True)
        if small.all():
            return keys, times
        # A long group holds few ids, many times: they are counted before they are paired.
        more_keys, more_times = [keys], [times]
        for group in np.flatnonzero(a_in * b_in > LONG_GROUP).tolist():
            first = int(np.searchsorted(a_group, group))
            left, n = np.unique(a[first : first + a_in[group]], return_counts=True)
            others, m = np.unique(b[b_first[group] : b_first[group] + b_in[group]], return_counts=True)
            more_keys.append((a_text[first] * self.span + left[:, None] * self.base + others[None, :]).ravel())
            more_times.append((n[:, None] * m[None, :]).ravel())
        keys, at = np.unique(np.concatenate(more_keys), return_inverse=True)
        whole = np.zeros(len(keys), np.int64)
        np.add.at(whole, at, np.concatenate(more_times))
        return keys, whole

    def _written(
        self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, a_in: np.ndarray, b_in: np.ndarray
    ) -> np.ndarray:
        """Every id of both sides with its separator, group by group, the first tokenizer's before the second's."""
        before = np.cumsum(a_in + b_in) - (a_in + b_in)
        a_first, b_first = np.cumsum(a_in) - a_in, np.cumsum(b_in) - b_in
        a_place, b_place = np.arange(len(a)) - a_first[a_group], np.arange(len(b)) - b_first[b_group]
        written = np.empty(len(a) + len(b), np.int64)
        written[before[a_group] + a_place] = a + self.most * np.where(a_place == 0, _SEPARATORS.index(";"), _SEPARATORS.index(","))
        written[before[b_group] + a_in[b_group] + b_place] = b + self.most * np.where(
            b_place == 0, _SEPARATORS.index("|"), _SEPARATORS.index(",")
        )
        return written


@lru_cache(maxsize=2)
def aligner(byte_level: str, piece_model: str, ranks: str | None) -> Aligner:
    """One for all tasks that a worker runs one after another."""
    return Aligner(byte_level, piece_model, ranks)


@dataclass(frozen=True)
class Aligned:
    """What a corpus's distinct texts gave; `total` documents hold a text that is not empty."""

    texts: DataFrame  # digest, copies, n_a, n_b, n_groups, n_links, groups_sha256, keys, times
    pairs: DataFrame  # key, a, b, documents, best
    base: int
    total: int


_TEXTS = (
    "digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys array<long>, times array<long>"
)


def align_texts(texts: DataFrame, byte_level: str, piece_model: str, ranks: str | None) -> DataFrame:
    """(text, copies) with distinct, not empty texts, aligned: the columns of Aligned.texts."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(byte_level, piece_model, ranks)
        for batch in found:
            for start, some in slices(batch.column(0), BYTES_AT_ONCE):
                measures, digests, keys, times = both.align(some)
                bounds = pa.array(np.cumsum([0, *map(len, keys)]), pa.int32())
                columns = [
                    pa.array([hashlib.sha256(text.encode()).digest() for text in some], pa.binary()),
                    batch.column(1).slice(start, len(some)),
                    *[pa.array(measures[:, n]) for n in range(len(_MEASURES))],
                    pa.array(digests, pa.string()),
                    pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(keys))),
                    pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(times))),
                ]
                names = ["digest", "copies", *_MEASURES, "groups_sha256", "keys", "times"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return texts.select("text", "copies").mapInArrow(batches, _TEXTS)


def align(
    docs: DataFrame,
    byte_level: str = "byte_bpe_50k.json",
    piece_model: str = "piece_bpe_32k.model",
    ranks: str | None = "byte_bpe_50k.tiktoken",
    text_col: str = "text",
) -> Aligned:
    """Aligns every distinct text of docs once and counts the documents that hold each pair of ids linked.

    The first tokenizer is byte-level BPE of the tokenizers library and gets a space and the text; the second is a sentencepiece
    model without normalisation that adds the space itself. Special tokens' strings in texts are plain text. ranks names the first
    tokenizer's vocabulary as ranks, which give the same ids faster; None does without.
    Null and empty texts take no part. Repeated rows, and ids whatever they are, count as a document each. No rows: no texts, no pairs.
    A text is one value: its pairs meet in one task, distinct ones only.
    """
    said = docs.select(F.col(text_col).cast("string").alias("text")).where("text <> ''")
    distinct = said.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    texts = stored(align_texts(distinct, byte_level, piece_model, ranks))
    base = SentencePieceProcessor(model_file=_path(piece_model)).vocab_size()
    counted = texts.select(F.explode("keys").alias("key"), "copies").groupBy("key").agg(F.sum("copies").alias("documents"))
    a = F.expr(f"key div {base}").cast("int").alias("a")
    named = counted.select("key", a, (F.col("key") % base).cast("int").alias("b"), "documents")
    # An id of the first tokenizer has at most as many rows as the second has ids.
    best = F.col("documents") == F.max("documents").over(Window.partitionBy("a"))
    pairs = stored(named.withColumn("best", best))
    total = texts.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    return Aligned(texts, pairs, base, total)


def rated(aligned: Aligned) -> DataFrame:
    """(digest, n_best, count_sum) of every text with links.

    Pairs that hold over one in FREQUENT of all counts are looked up in every task, the others, none of them frequent, by a shuffle.
    """
    whole = aligned.pairs.agg(F.coalesce(F.sum("documents"), F.lit(0))).first()[0]
    frequent = F.col("documents") * FREQUENT > F.lit(whole).cast("decimal(38,0)")
    facts = aligned.pairs.select("key", "documents", "best")
    linked = aligned.texts.select("digest", F.inline(F.arrays_zip("keys", "times"))).withColumnRenamed("keys", "key")
    often = F.broadcast(facts.where(frequent))
    by_task = linked.join(often, "key")
    rest = linked.join(F.broadcast(facts.where(frequent).select("key")), "key", "left_anti").join(facts.where(~frequent), "key")

    def summed(df: DataFrame) -> DataFrame:
        n_best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best")
        return df.groupBy("digest").agg(n_best, F.sum(F.col("times") * F.col("documents")).alias("count_sum"))

    both = summed(by_task).unionByName(summed(rest))
    return both.groupBy("digest").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def with_alignment(docs: DataFrame, aligned: Aligned, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of docs, whatever other columns it has.

    n_best counts links whose pair has the most documents among the pairs of its first id; count_sum adds up the pairs' documents
    over links. Null and empty texts, and texts whose tokens' bytes are not a space and the text, have zeros and an empty digest.
    Repeated rows and ids, and null ids, keep a row each. No rows: no rows.
    """
    digest = F.unhex(F.sha2(F.col(text_col).cast("string").cast("binary"), 256))
    rows = docs.select(F.col(id_col).alias("doc_id"), digest.alias("digest"))
    measures = aligned.texts.drop("keys", "times").join(rated(aligned), "digest", "left")
    found = with_facts(rows, measures, "digest", F.col("copies"), aligned.total)
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (*_MEASURES, "n_best", "count_sum")]
    return found.select("doc_id", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
