"""Aligned tokenizers against whole texts encoded by the libraries and pairs counted one by one."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer
from waferscope.llm import alignment, skew
from waferscope.llm.registry import op11_alignment, table

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "  a b  ", "x\ty", "x\n y\r\n z\n", "\n", "tab\t \t x", "<|endoftext|> <s>b</s> <unk>", "a▁b c", "▁",
    "naïve ﬁ ①½ é́", "😀😀 👩‍👩‍👧 x😀y", "你好，世界 你好", "　x y z", "a\0b \0 c", "a\x85 b\x1c c  d", "0x1F <0x41> &amp;", "word " * 300, "a" * 5_000,
    " " * 2_000, "ßß" * 3_000, "don't we'll I'm", "ends in spaces   ", "﻿bom", "\U0010ffff x", "tail \n",
]


class Plain:
    """The contract, by whole texts and per-byte offsets."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        signs = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in signs]
        self.byte = {chr(b): b for b in signs} | {chr(256 + n): b for n, b in enumerate(rest)}

    def groups(self, text: str) -> list[tuple[list[int], list[int]]]:
        a = self.a.encode(" " + text, add_special_tokens=False)
        b = self.b.encode(text)
        said_a = [bytes(self.byte[c] for c in t) for t in a.tokens]
        said_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in map(self.b.id_to_piece, b)]
        if not text or not b"".join(said_a) == b"".join(said_b) == (" " + text).encode():
            return []
        found, at = [], {}
        for ids, said, side in ((a.ids, said_a, 0), (b, said_b, 1)):
            end = 0
            for i, token in zip(ids, said, strict=True):
                end += len(token)
                at.setdefault(end, [[], []])[side].append(i)
        held = ([], [])
        for end in sorted(at):
            held[0].extend(at[end][0])
            held[1].extend(at[end][1])
            if at[end][0] and at[end][1]:
                found.append(held)
                held = ([], [])
        return found


def brute(rows: list[tuple]) -> list[tuple]:
    plain = Plain()
    links, found = {}, {}
    for text in {t for _, t in rows}:
        found[text] = plain.groups(text or "")
        links[text] = Counter((x, y) for a, b in found[text] for x in a for y in b)
    documents = Counter(pair for _, text in rows for pair in links[text])
    best = defaultdict(int)
    for (x, _), n in documents.items():
        best[x] = max(best[x], n)
    made = []
    for doc, text in rows:
        groups, own = found[text], links[text]
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        made.append((
            doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(own.values()),
            sum(n for p, n in own.items() if documents[p] == best[p[0]]), sum(n * documents[p] for p, n in own.items()),
            hashlib.sha256(written.encode()).hexdigest() if groups else "",
        ))
    return made


def test_odd_texts_copies_and_null_rows(spark, monkeypatch):
    monkeypatch.setattr(alignment, "FREQUENT", 40)
    rng = random.Random(5)
    mixed = ["".join(rng.choice([" ", "  ", "a", "the", "ing", "\n", "é", "½", "9", ".", "!", "▁", "你", "\t", "<s>"]) for _ in range(rng.randrange(1, 60))) for _ in range(120)]
    texts = [None, *ODD, *mixed, *["a common text"] * 200]
    rows = [(n if n % 7 else None, text) for n, text in enumerate(texts)] + [(3, "twice"), (3, "twice")]
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], "doc_id long, text string, digest string, key string, copies int")
    found = alignment.with_alignment(df, alignment.align(df))
    assert found.columns == COLUMNS
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, brute(rows)))


def test_pairs_of_the_corpus(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "a c"), (4, None)], "doc_id long, text string")
    aligned = alignment.align(df)
    a, b = Plain().a.encode(" a").ids[0], Plain().b.encode("a")[0]
    pairs = {(r.a, r.b): (r.documents, r.best) for r in aligned.pairs.collect()}
    assert pairs[a, b] == (3, True) and sorted(n for n, _ in pairs.values()) == [1, 2, 3]
    assert aligned.total == 3 and aligned.texts.count() == 2


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.with_alignment(df, alignment.align(df)).collect() == []
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [tuple(r)[1:] for r in alignment.with_alignment(df, alignment.align(df)).collect()] == [(0,) * 6 + ("",)] * 2


def test_ranks_give_the_ids_of_the_tokenizer():
    aligner = alignment.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken")
    plain = alignment.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    rng = random.Random(9)
    signs = [*map(chr, range(0x250)), *" " * 60, *"\n" * 20, *"\u2009\u3000\u0600你😀\u0301½①Ⅷ٣'sdmtlrevl" * 3]
    texts = [*ODD[1:], *["".join(rng.choices(signs, k=rng.randrange(1, 60))) for _ in range(20_000)], "ab" * 100_000, " \n" * 100_000, "9" * 50_000]
    assert aligner.encode_a(texts) == plain.encode_a(texts)


def test_texts_do_not_depend_on_those_they_are_aligned_with(monkeypatch):
    aligner = alignment.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    texts = [*ODD[3:], "a▁b", "one two three", "é" * 300 + "😀" * 300]
    alone = [aligner.align([text]) for text in texts]
    for most in (4_096, 4, 0):
        monkeypatch.setattr(alignment, "LONG_GROUP", most)
        monkeypatch.setattr(alignment, "REMEMBERED", 10 + most)
        aligner._forget()
        aligner.align(["words that it forgets", *texts[:9]])
        measures, digests, keys, times = aligner.align(texts)
        for n, (own, digest, own_keys, own_times) in enumerate(alone):
            assert measures[n].tolist() == own[0].tolist() and digests[n] == digest[0]
            assert keys[n].tolist() == own_keys[0].tolist() and times[n].tolist() == own_times[0].tolist()


def test_the_query_against_whole_texts(spark, star_folder):
    rows = [(r.doc_id, r.text) for r in table(spark, star_folder, "documents").collect()]
    found = [tuple(r) for r in op11_alignment(spark, star_folder).select(*COLUMNS).collect()]
    assert sorted(found) == sorted(brute(rows))


@pytest.mark.parametrize("hot", [0, 3_000])
def test_facts_of_hot_keys(spark, hot):
    rows = [(n, "hot" if n < hot else f"k{n % 500}" if n % 9 else None) for n in range(6_000)]
    counts = Counter(k for _, k in rows if k and k != "k7")
    df = spark.createDataFrame(rows, "id long, key string")
    facts = spark.createDataFrame([(k, n, k.upper()) for k, n in counts.items()], "key string, n long, fact string")
    joined = skew.with_facts(df, facts, "key", F.col("n"), len(rows))
    assert sorted((r.id, r.key, r.fact) for r in joined.select("id", "key", "fact").collect() if r.key) == sorted(
        (i, k, k.upper() if k in counts else None) for i, k in rows if k
    )
    assert joined.count() == len(rows) and joined.where("key IS NULL AND fact IS NOT NULL").count() == 0
