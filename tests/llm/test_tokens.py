"""Token counts and packing against the library run on whole texts."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from waferscope.llm import packing, token_counts, wordwise
from waferscope.llm.registry import op4_packing, op5_token_counts, table

ODD = [
    "", " ", "  a  b ", "a\n b", "a \nb", "a\n \nb", "x <|endoftext|> y", "a<|endoftext|>b  <|endoftext|>\n",
    "<|startoftext|>Hi", "don't WE'LL it's, 'tis '' ... !?", "1234 5,6.7", "tab\tb \t c", "\x1c a \x85 b\xa0c 　d", "é É ́x",
    "ΣΑΣ İi ẞ Å", "\U0001f600 \U0001f600a", "word*** WORD!! end.", "a|b |", " lead", "trail ", "\r\n\r\n x", "͸ \x00 z",
]
TEXTS = st.lists(
    st.one_of(st.sampled_from(ODD), st.text(st.sampled_from("ab AÉéß .,'!<|>*\n\t\r1Σ́\x1c\xa0"), max_size=25)), max_size=6
).map("".join)


def whole(name: str, text: str) -> list[int]:
    return wordwise.load(name).encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_pieces_count_as_the_whole_text(text):
    counter = token_counts.counter("byte_bpe_50k.json")
    assert token_counts.count_tokens([text], counter) == [len(whole("byte_bpe_50k.json", text))]


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_plain_pieces_give_the_ids_of_the_whole_text(text):
    remembered = wordwise.Remembered("word_bpe_49k.json", wordwise.PLAIN, np.ndarray.tolist)
    words = wordwise.plain_pieces(text)
    known = remembered.learn(set(words))
    assert [i for w in words for i in known[w]] == whole("word_bpe_49k.json", text)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(wordwise, "REMEMBERED", 5)
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["aa", "Bb.", "c" * 300, "dd,"]) + str(rng.randrange(9)) for _ in range(12)) for _ in range(20)]
    counter = token_counts.counter("byte_bpe_50k.json")
    for text in texts:
        assert token_counts.count_tokens([text], counter) == [len(whole("byte_bpe_50k.json", text))]


@pytest.mark.parametrize("length", [0, 1, 2, 3, 4095, 4096, 4097, 20_000])
def test_binary_pieces(length):
    made = packing.binary_pieces(length, 4096)
    assert sum(made) == length and all(p & (p - 1) == 0 and p <= 4096 for p in made)
    assert made == sorted(made, reverse=True) and len([p for p in made if p < 4096]) == bin(length % 4096).count("1")


def odd_docs(spark):
    rows = [(i, t, "k", 0) for i, t in enumerate(ODD)] + [(3, None, None, 1), (None, "no id", "x", 2), (3, ODD[3], "k", 0), (99, "long text. " * 40_000, "", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, length int")


def test_counts_of_odd_rows(spark):
    docs = odd_docs(spark)
    found = sorted((tuple(r) for r in token_counts.with_token_counts(docs).collect()), key=str)
    wanted = []
    for r in docs.collect():
        n = len(whole("byte_bpe_50k.json", r.text or ""))
        wanted.append((r.doc_id, len((r.text or "").encode()), n, n > 512))
    assert found == sorted(wanted, key=str)
    assert token_counts.with_token_counts(docs.limit(0)).count() == 0


def unpacked(rows) -> dict:
    of: dict = {}
    for r in sorted(rows, key=lambda r: (str(r.doc_id), r.doc_tokens, r.start)):
        assert r.length & (r.length - 1) == 0 and r.length <= 4096 and r.offset == 0
        of.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    assert len({r.sequence_id for r in rows}) == len(rows)
    return of


def test_packing_is_an_exact_round_trip(spark):
    docs = odd_docs(spark).where("doc_id is null or doc_id <> 3")
    of = unpacked(packing.pack(docs).collect())
    assert len(of) == docs.count()
    for r in docs.collect():
        ids = [*whole("word_bpe_49k.json", r.text or ""), 2]
        pieces = of[(r.doc_id, len(ids))]
        assert np.frombuffer(b"".join(bytes(p.ids) for p in pieces), "<u4").tolist() == ids
        assert [p.start for p in pieces] == np.cumsum([0, *[p.length for p in pieces[:-1]]]).tolist()
    copies = packing.pack(odd_docs(spark).where("doc_id = 3")).collect()
    assert sum(r.length for r in copies) == sum(len(whole("word_bpe_49k.json", t)) + 1 for t in (ODD[3], ODD[3], ""))
    assert packing.pack(docs.limit(0)).count() == 0


def test_the_queries_over_whole_tables(spark, star_folder):
    docs = {r.doc_id: r.text for r in table(spark, star_folder, "documents").collect()}
    counts = {r.doc_id: r.n_tokens for r in op5_token_counts(spark, star_folder).collect()}
    assert counts == {i: len(whole("byte_bpe_50k.json", t)) for i, t in docs.items()}
    of = unpacked(op4_packing(spark, star_folder).collect())
    assert len(of) == len(docs)
    for (doc_id, tokens), pieces in of.items():
        ids = np.array([*whole("word_bpe_49k.json", docs[doc_id]), 2], "<u4")
        assert tokens == len(ids) == sum(p.length for p in pieces)
        assert all(zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for p in pieces)
