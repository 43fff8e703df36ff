"""Tokenizers run on pieces of text between which their result cannot change, each distinct piece once."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

# Distinct pieces, and their signs, that a task remembers: a memory bound only, as forgotten pieces are encoded again.
REMEMBERED = 600_000
REMEMBERED_CHARS = 16_000_000
_ENCODED_AT_ONCE = 4_096
# Plain pieces that are encoded as one text.
_TOGETHER = 256


@lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    """The tokenizer in a file: a path, or the name of a public tokenizer's file."""
    tokenizer = Tokenizer.from_file(path if os.path.sep in path else public_tokenizers.path(path))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def runs(texts: list[str], size: int) -> Iterator[list[str]]:
    """Texts one after another in runs of about `size` characters."""
    run, held = [], 0
    for text in texts:
        run.append(text)
        held += len(text)
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


class Forgetful(dict):
    """A dictionary by text that starts anew when it gets too large."""

    chars = 0

    def room_for(self, new: set[str]) -> set[str]:
        """Of the texts about to be added, those that are not there; all of them if the rest had to go."""
        missing = {text for text in new if text not in self}
        if missing:
            chars = sum(map(len, missing))
            if self and (len(self) + len(missing) > REMEMBERED or self.chars + chars > REMEMBERED_CHARS):
                self.clear()
                missing, self.chars = new, 0
                chars = sum(map(len, missing))
            self.chars += chars
        return missing


@dataclass(frozen=True)
class Kind:
    """How a tokenizer's texts may be cut.

    `parts` cuts a piece into words. Plain words, which `plain` fits whole, may be encoded together as one text with `between`
    between them: their tokens are told apart by `marks`, which says of a token whether it begins (or, with `ends`, ends) a word.
    """

    parts: Callable[[str], list[str]]
    plain: re.Pattern
    between: str
    marks: Callable[[str], bool]
    ends: bool


class Remembered:
    """What `value` makes of the token ids of pieces, for the distinct pieces of the texts so far."""

    def __init__(self, path: str, kind: Kind, value: Callable[[np.ndarray], object]):
        self.tokenizer, self.kind, self.value = load(path), kind, value
        self.known = Forgetful()
        vocabulary = self.tokenizer.get_vocab()
        self.marked = np.zeros(max(vocabulary.values()) + 1, bool)
        self.marked[[i for token, i in vocabulary.items() if kind.marks(token)]] = True

    def learn(self, pieces: set[str]) -> dict[str, object]:
        """A mapping that has every one of the pieces, until the next call."""
        known = self.known
        new = known.room_for(pieces)
        fits, parts = self.kind.plain.fullmatch, self.kind.parts
        plain, mixed = [], {}
        for piece in new:
            if fits(piece):
                plain.append(piece)
            else:
                mixed[piece] = parts(piece)
        others = {part for some in mixed.values() for part in some if part not in known}.difference(plain)
        also = [part for part in others if fits(part)]
        self._together([*plain, *also])
        self._singly(list(others.difference(also)))
        for piece, some in mixed.items():
            if piece not in known:
                value = known[some[0]] if some else self.value(np.empty(0, np.uint32))
                for part in some[1:]:
                    value = value + known[part]
                known[piece] = value
        return known

    def _encoded(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        for at in range(0, len(texts), _ENCODED_AT_ONCE):
            found = self.tokenizer.encode_batch_fast(texts[at : at + _ENCODED_AT_ONCE], add_special_tokens=False)
            for i, encoded in enumerate(found, at):
                yield i, np.array(encoded.ids, np.uint32)

    def _singly(self, pieces: list[str]) -> None:
        for i, ids in self._encoded(pieces):
            self.known[pieces[i]] = self.value(ids)

    def _together(self, pieces: list[str]) -> None:
        runs = [pieces[at : at + _TOGETHER] for at in range(0, len(pieces), _TOGETHER)]
        again: list[str] = []
        for i, ids in self._encoded([self.kind.between.join(run) for run in runs]):
            edges = np.flatnonzero(self.marked[ids])
            edges = np.concatenate([[0], edges + 1]) if self.kind.ends else np.append(edges, len(ids))
            run = runs[i]
            if len(edges) != len(run) + 1 or edges[0] != 0 or edges[-1] != len(ids):
                again += run
                continue
            cuts = edges.tolist()
            value = self.value
            self.known.update((piece, value(ids[a:b])) for piece, a, b in zip(run, cuts, cuts[1:], strict=False))
        self._singly(again)


@lru_cache(maxsize=2)
def remembered(path: str, kind: Kind, value: Callable[[np.ndarray], object]) -> Remembered:
    """One memory for all tasks that a worker runs one after another."""
    return Remembered(path, kind, value)


# Byte-level BPE with contractions, letters, digits and other signs as words that may begin with one space.
#
# A space that is followed by anything but white space always starts a word: a run of white space before it ends one
# sign early, and no other word holds a space. So texts may be cut before such spaces. Within a piece, a run of plain
# letters and the run of plain signs after it are two words.
_RUN = re.compile(r" [\s\x85\x1c-\x1f]")
_CUT = re.compile(r" (?=[^\s\x85\x1c-\x1f])")
_LETTERS_THEN_SIGNS = re.compile(r"( ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,!?;:*#$%&|]+)")


def spaced_pieces(text: str) -> list[str]:
    """The pieces of a text; all but the first begin with a space."""
    if "\0" in text or _RUN.search(text):
        first, *others = _CUT.split(text)
        return [first, *[" " + piece for piece in others]]
    return text.replace(" ", "\0 ").split("\0")


def spaced_parts(piece: str) -> list[str]:
    found = _LETTERS_THEN_SIGNS.fullmatch(piece)
    return list(found.groups()) if found else [piece]


SPACED = Kind(
    spaced_parts, re.compile(r" [A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+"), "", lambda token: token.startswith("\u0120"), ends=False
)


# Lower-casing word BPE, which drops white space: texts may be cut at every space and line end.
_WORD_PARTS = re.compile(r"([a-z\xdf-\xf6\xf8-\xff]+)([.,!?;:*#$%&|]+)")


def plain_pieces(text: str) -> list[str]:
    """Pieces without spaces and line ends, lower-cased where that is sure to be what the tokenizer does first."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        pass
    else:
        text = text.lower()
    return text.replace("\n", " ").split(" ")


def plain_parts(piece: str) -> list[str]:
    if not piece:
        return []
    found = _WORD_PARTS.fullmatch(piece)
    return list(found.groups()) if found else [piece]


PLAIN = Kind(plain_parts, re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+"), " ", lambda token: token.endswith("</w>"), ends=True)
