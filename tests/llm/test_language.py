"""Language models against a plain implementation, and held-out accuracy."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from waferscope.llm import language
from waferscope.llm.registry import op7_language, table

COUNTS = {"aa": {"abba": 3, "ab": 1, "baab": 2, "c": 1}, "bb": {"xyx": 2, "aby": 1}}


def plain_bits(counts: dict[str, int], word: str, order: int, floor: float, discount: float = 0.75) -> float:
    """Interpolated Kneser-Ney, written from its definition."""
    grams: list[Counter] = [Counter() for _ in range(order + 1)]
    for w, n in counts.items():
        marked = f"\x01{w}\x02"
        for size in range(1, order + 1):
            for i in range(len(marked) - size + 1):
                grams[size][marked[i : i + size]] += n
    number = {order: grams[order]}
    for size in range(order - 1, 0, -1):
        before = Counter(g[1:] for g in grams[size + 1])
        number[size] = {g: before.get(g) or n for g, n in grams[size].items()}
    number[1] = {g: 0 if g == "\x01" else n for g, n in number[1].items()}

    def chance(context: str, sign: str) -> float:
        size = len(context) + 1
        if not context:
            total, kinds = sum(number[1].values()), sum(n > 0 for n in number[1].values())
            return max(number[1].get(sign, 0) - discount, 0) / total + discount * kinds / total * floor if sign in number[1] else floor
        same = {g: n for g, n in number[size].items() if g[:-1] == context}
        lower = chance(context[1:], sign)
        if not same:
            return lower
        total = sum(same.values())
        return max(same.get(context + sign, 0) - discount, 0) / total + discount * len(same) / total * lower

    marked = f"\x01{word}\x02"
    return -sum(math.log2(chance(marked[max(0, i - order + 1) : i], marked[i])) for i in range(1, len(marked)))


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_costs_are_those_of_the_definition(order):
    model = language.fit(COUNTS, order)
    words = ["abba", "ab", "baab", "xyx", "zzz", "abbab", "c", "cab", "é"]
    found = model.costs(words)
    for i, word in enumerate(words):
        for j, name in enumerate(model.languages):
            assert found[i, j] == pytest.approx(plain_bits(COUNTS[name], word, order, 2.0 ** model.unseen[j]), abs=1e-9)


def test_odd_rows_have_defined_results(spark):
    rows = [(1, None), (2, ""), (3, "12 ,."), (4, "the other thing"), (4, "der die das"), (None, "the other"), (5, "das " * 100_000), (6, "漢字")]
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t in rows], "doc_id long, text string, lang_pred string, score double")
    labelled = spark.createDataFrame([("en", "the other thing is here"), ("de", "der die das und so"), (None, "x"), ("en", None), ("fr", "...")] * 5, "lang string, text string")
    model = language.train(labelled, order=3)
    assert model.languages == ["de", "en"]
    found = [(r.doc_id, r.lang_pred, r.rejected) for r in language.with_language(docs, model, "text", "doc_id").collect()]
    assert found[:3] == [(1, "und", True), (2, "und", True), (3, "und", True)]
    assert [f[:2] for f in found[3:7]] == [(4, "en"), (4, "de"), (None, "en"), (5, "de")]
    assert found[7][1] in ("de", "en")
    assert language.with_language(docs.limit(0), model, "text", "doc_id").count() == 0
    assert language.train(labelled.limit(0)) is None
    assert {r.lang_pred for r in language.with_language(docs, None, "text", "doc_id").collect()} == {"und"}


def test_forgetting_words_changes_nothing(monkeypatch):
    model = language.fit(COUNTS, 3)
    texts = ["abba ab", "baab xyx xyx", "zzz", "", "ab " * 50 + "y" * 100]
    whole = language.Scorer(model).entropies(texts)
    monkeypatch.setattr(language, "REMEMBERED", 2)
    scorer = language.Scorer(model)
    assert np.allclose(np.concatenate([scorer.entropies([t]) for t in texts]), whole, equal_nan=True)


def test_held_out_accuracy_of_the_query(spark):
    folder = "/root/testdata/sf0.01"
    found = op7_language(spark, folder)
    docs = table(spark, folder, "documents")
    assert found.count() == docs.count()
    right = found.join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score"))
    accuracy, low, high = right.first()
    assert accuracy >= 0.98 and 0 <= low <= high <= 1


def test_signs_that_are_no_letters_have_no_language(spark):
    texts = ["½ ² ①", "Ⅷ ⅔", "12 ٣", "½ the", "①the other②", "_"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.withColumn("_text", F.lit("kept"))
    labelled = spark.createDataFrame([("en", "the other thing ½ is here"), ("de", "der die das und so ①②③")] * 5, "lang string, text string")
    model = language.train(labelled, order=3)
    found = {r.doc_id: (r.lang_pred, r.score, r.rejected, r._text) for r in language.with_language(docs, model, "text", "doc_id", "_text").collect()}
    none = ("und", 0.0, True, "kept")
    assert [found[i] for i in (0, 1, 2, 5)] == [none] * 4
    assert found[3][0] == found[4][0] == "en"


def test_a_language_of_copies_is_learned(spark):
    """Whether a language is learned depends on its texts, not on how many rows or copies it has."""
    rng = np.random.default_rng(1)
    texts = {f"l{n}": "".join(rng.choice(list("abcdefghij"), 40)) for n in range(12)}
    rows = [(lang, text) for lang, text in texts.items() for _ in range(50)]
    model = language.train(spark.createDataFrame(rows, "lang string, text string"), order=2)
    assert model.languages == sorted(texts)


def test_a_model_grows_with_the_ngrams_seen():
    words = lambda n: {"".join(chr(0x4E00 + 40 * n + i * k % 40) for i in range(1, 6)): 1 for k in (1, 3, 7)}
    sizes = []
    for count in (100, 1_200):
        model = language.fit({f"l{n:04}": words(n) for n in range(count)}, order=3)
        sizes.append(sum(t.keys.nbytes + t.probabilities.nbytes + t.weights.nbytes for by in model.tables for t in by))
        assert len(model.languages) == count
        costs = model.costs([next(iter(words(count - 1)))])
        assert costs.argmin() == count - 1
    assert sizes[1] < 12.5 * sizes[0]


def test_more_than_a_thousand_languages(spark):
    rows = [(f"l{n:04}", f"{chr(0x4E00 + n)}{chr(0x5E00 + n)}") for n in range(1_200)]
    df = spark.createDataFrame(rows, "lang string, text string")
    model = language.train(df, order=2)
    assert len(model.languages) == 1_200
    found = language.with_language(df, model, "text", "lang").collect()
    assert all(r.lang == r.lang_pred for r in found)
