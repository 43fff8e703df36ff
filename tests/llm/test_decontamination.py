"""Benchmark passages in documents: alignment against its definition, planted passages, clean documents."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from waferscope.llm import decontamination
from waferscope.llm.registry import op9_decontamination, table


def brute_score(text: list[int], item: list[int]) -> float:
    row, best = [0.0] * (len(text) + 1), 0.0
    for word in item:
        new = [0.0]
        for j, other in enumerate(text, 1):
            new.append(max(0.0, row[j - 1] + (1.0 if word == other else -0.5), row[j] - 0.5, new[-1] - 0.5))
        row, best = new, max(best, *new)
    return best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=25), st.lists(st.integers(1, 4), max_size=12))
def test_alignment_is_smith_waterman(text, item):
    score, start, end = decontamination.align(np.array(text, int), np.array(item, int))
    assert score == pytest.approx(brute_score(text, item))
    assert brute_score(text[start:end], item) == pytest.approx(score)


WORDS = [f"w{i}" for i in range(3_000)]


def planted(seed: int = 4):
    """Items; documents with exact, edited, doubled, partial and shared passages; clean ones."""
    rng = random.Random(seed)
    say = lambda n: rng.choices(WORDS, k=n)
    items = [say(rng.randint(15, 60)) for _ in range(20)]
    docs, wanted = [], set()
    for i in range(200):
        words = say(rng.randint(0, 300))
        if i < 60:
            item = i % 20 if i < 40 else 7
            passage = list(items[item])
            if 20 <= i < 40:
                for at in reversed(range(rng.randrange(5), len(passage), 6)):
                    passage[at : at + 1] = rng.choice([[rng.choice(WORDS)], [], [passage[at], "extra"]])
            at = rng.randint(0, len(words))
            words = words[:at] + passage * (2 if i == 3 else 1) + words[at:]
            wanted.add((i, item))
        elif i < 80:
            words += items[i % 20][:4]
        docs.append((i, " ".join(words).capitalize() + "."))
    return docs, [(i, ", ".join(item)) for i, item in enumerate(items)], wanted


@pytest.mark.parametrize("block", [16 << 20, 1_500])
def test_planted_passages_are_found_and_clean_documents_left(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    rows, item_rows, wanted = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(item_rows, "item_id long, text string")
    found = decontamination.contamination(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == wanted
    texts = dict(rows)
    for r in found:
        if r.share == 1:
            (start, end), *_ = r.spans
            assert dict(item_rows)[r.item_id].replace(",", "") in texts[r.doc_id][start:end].lower()
    kept = decontamination.decontaminated(docs, items)
    assert {r.doc_id for r in kept.collect()} == set(range(200)) - {i for i, _ in wanted}


def test_odd_rows_have_defined_results(spark):
    passage = " ".join(WORDS[:20])
    rows = [(1, None), (2, ""), (3, passage.upper()), (3, passage.upper()), (None, passage), (4, "İ " + passage + " İ"), (5, ("x " * 100_000) + passage)]
    docs = spark.createDataFrame([(i, t, 1.0, "x") for i, t in rows], "doc_id long, text string, score double, gram string")
    items = spark.createDataFrame([(7, passage, "x"), (8, None, "x"), (9, "", "x"), (10, "w1 w2", "x"), (7, passage, "x")], "item_id long, text string, id string")
    found = [(r.doc_id, r.item_id, r.share) for r in decontamination.contamination(docs, items).collect()]
    assert sorted(found, key=str) == sorted([(i, 7, 1.0) for i in (3, 3, None, 4, 5)] * 2, key=str)
    kept = decontamination.decontaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert decontamination.contamination(docs.limit(0), items).count() == 0
    assert decontamination.contamination(docs, items.limit(0)).count() == 0
    assert decontamination.decontaminated(docs, items.limit(0)).count() == 7


def test_the_query_finds_every_whole_passage(spark):
    folder = "/root/testdata/sf0.01"
    found = {(r.doc_id, r.item_id) for r in op9_decontamination(spark, folder).collect()}
    docs = table(spark, folder, "documents").select("doc_id", F.lower("text").alias("text"))
    for item in table(spark, folder, "benchmark").collect():
        holding = docs.where(F.contains("text", F.lit(item.text.lower()))).collect()
        assert {(r.doc_id, item.item_id) for r in holding} <= found
