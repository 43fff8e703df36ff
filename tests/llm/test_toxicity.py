"""Toxicity: the automaton against edit distances, and held-out accuracy."""

from __future__ import annotations

import random

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from waferscope.llm import toxicity
from waferscope.llm.registry import op3_toxicity, table


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def nearest(stems: list[str], word: str) -> tuple[int, int] | None:
    found = []
    for number, stem in enumerate(stems):
        for n in range(1, len(word) + 1):
            if word[0] == stem[0] and (d := distance(stem[1:], word[1:n])) <= toxicity.errors_allowed(stem):
                found.append((d, -len(stem), number))
    return (min(found)[2], min(found)[0]) if found else None


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=3, max_size=9), min_size=1, max_size=5, unique=True), st.lists(st.text("abcd", max_size=10), max_size=8))
def test_automaton_finds_what_edit_distance_finds(stems, words):
    automaton = toxicity.Automaton(stems)
    for word in words:
        found, wanted = automaton.find(word), nearest(stems, word)
        assert (found is None) == (wanted is None)
        if found:
            assert found[1] == wanted[1] and len(stems[found[0]]) == len(stems[wanted[0]])


def planted(count: int, seed: int):
    """Texts of common words; toxic ones hold two to four forms of bad words."""
    rng = random.Random(seed)
    bad = ["idiot", "scumbag", "worthless", "pathetic"]
    rows = []
    for i in range(count):
        words = [f"{rng.choice('bdfgklmnprst')}{rng.choice('aeiou')}{rng.choice('bdfgklmnprst')}o" for _ in range(60)]
        toxic = i % 5 == 0
        for _ in range(rng.randint(2, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", "s", "ly"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_planted_words_are_learned_misspelt_and_quoted(spark):
    rows = planted(400, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:250]] + [(None, 1), (3, None), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert {s[:4] for s in model.stems} == {"idio", "scum", "wort", "path"}
    found = {r.doc_id: r.toxicity for r in toxicity.with_scores(docs, model, "text", "doc_id").collect()}
    assert all((found[i] >= 0.5) == bool(toxic) for i, _, toxic in rows)
    plain = "bado keno tiro muno " * 10
    cases = {
        "bad": plain + "you idiot and worthless scumbag", "misspelt": plain + "worthles and pathetik and scumbagg too", "clean": plain,
        "quoted": plain + 'he said the word "idiot"', "empty": "", "null": None, "long": plain * 3_000,
    }
    made = spark.createDataFrame([(k, v, 1.0, "x") for k, v in cases.items()] * 2, "doc_id string, text string, toxicity double, hits string")
    scored = toxicity.with_scores(made, model, "text", "doc_id").collect()
    score = {r.doc_id: r.toxicity for r in scored}
    assert len(scored) == 14 and all(0 <= s <= 1 for s in score.values())
    assert score["bad"] > 0.5 and score["misspelt"] > 0.5
    assert max(score["clean"], score["empty"], score["null"], score["long"]) < 0.5
    assert score["quoted"] < score["bad"]
    kept = toxicity.without_toxic(made, model)
    assert kept.columns == made.columns and {r.doc_id for r in kept.collect()} == {k for k in cases if score[k] < 0.5}
    assert toxicity.with_scores(made.limit(0), model, "text", "doc_id").count() == 0


def test_without_labels_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "idiot")], "doc_id long, text string")
    for labels in ([], [(1, 1)], [(7, 0), (8, 1)]):
        model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert model is None
        assert toxicity.with_scores(docs, model, "text").first().toxicity == 0


def test_held_out_accuracy_of_the_query(spark):
    folder = "/root/testdata/sf0.01"
    found = op3_toxicity(spark, folder)
    assert found.count() == table(spark, folder, "documents").count()
    right = found.join(table(spark, folder, "labels"), "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")))
    assert right.first()[0] >= 0.9


def in_ball(stems: list[str], word: str) -> int | None:
    found = [d for s in stems for n in range(1, len(word) + 1) if (d := distance(s, word[:n])) <= toxicity.errors_allowed(s)]
    return min(found) if found else None


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=3, max_size=9), min_size=1, max_size=5, unique=True), st.lists(st.text("abc*1", max_size=10), max_size=8))
def test_reading_allows_errors_at_every_letter(stems, words):
    automaton = toxicity.Automaton(stems, any_first=True)
    for word in words:
        found = automaton.find(word)
        assert (found and found[1]) == in_ball(stems, word)


def test_disguised_terms_are_hits_of_their_term():
    stems = ["stupid", "idiot", "moron", "worthless"]
    reader = toxicity.Reader(toxicity.Model(stems, np.ones(4), np.ones(4)))
    forms = {
        "ztupid": 0, "tupid": 0, "$tupid!": 0, "st*pid": 0, "well,st*pid.": 0, "stup1dly": 0, "1diot": 1, "i*diot": 1, "i-diot": 1, "(1di0t": None,
        "m0ron": 2, "keno/m0ron,": 2, "w0rth1ess": 3, "*orth1ess": 3, "10.5": None, "well-known": None, "2024-12-04": None, "s*t*u*p*i*d": None,
    }
    for form, stem in forms.items():
        found = reader.hits(f"bado keno {form} tiro").found
        assert found == ({} if stem is None else {(stem, True): 1.0}), form
    assert reader.hits("bado idiot-like, moron! stupid").found == {(0, False): 1.0, (1, False): 1.0, (2, False): 1.0}
    assert reader.hits('he said "m0ron" tiro').found == {(2, True): 0.25}


def test_texts_with_only_disguised_terms_go(spark):
    rows = planted(400, 2)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    plain = "bado keno tiro muno " * 10
    made = spark.createDataFrame([(1, plain + "1diot and w*rthless, zcumbag p4thetic"), (2, plain)], "doc_id long, text string")
    assert [r.doc_id for r in toxicity.without_toxic(made, model).collect()] == [2]
