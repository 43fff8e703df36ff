"""SimHash near-duplicates against every pair compared."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from waferscope.llm import simhash
from waferscope.llm.graph import components
from waferscope.llm.registry import op1_simhash, table

SCHEMA = "doc_id long, text string, fp string, component_id string, a string, key string"


def brute_print(text: str | None, words_each: int = 4) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + words_each]) for i in range(max(1, len(words) - words_each + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(ids: list, prints: list[int], distance: int) -> list:
    values = np.array(sorted(set(prints)), np.uint64)
    group = list(range(len(values)))
    for i, value in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ value) <= distance):
            old, new = group[j], group[i]
            if old != new:
                group = [new if g == old else g for g in group]
    of = dict(zip(values.tolist(), group, strict=True))
    least: dict = {}
    for i, p in zip(ids, prints, strict=True):
        if i is not None:
            least[of[p]] = min(i, least.get(of[p], i))
    return [least.get(of[p]) for p in prints]


def near_texts(count: int, seed: int) -> list[str]:
    """Texts of which many differ from another by a word or two."""
    rng = random.Random(seed)
    texts: list[str] = []
    for _ in range(count):
        if texts and rng.random() < 0.6:
            words = rng.choice(texts).split()
            words[rng.randrange(len(words))] = f"w{rng.randrange(9)}"
        else:
            words = [f"w{rng.randrange(200)}" for _ in range(rng.choice([5, 60, 200]))]
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("distance", [3, 4])
def test_components_are_those_of_all_pairs(spark, distance):
    texts = near_texts(300, distance)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs, distance=distance).collect()}
    prints = [brute_print(t) for t in texts]
    assert [found[i][0] for i in range(300)] == prints
    assert [found[i][1] for i in range(300)] == brute_components(list(range(300)), prints, distance)


def test_odd_rows_have_defined_results(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One word"), (4, "one WORD"), (4, "one WORD"), (5, "é É x"),
        (None, "only here and nowhere else at all"), (None, None), (6, "a " * 300_000), (7, "a " * 300_001),
    ]
    docs = spark.createDataFrame([(*r, "x", "y", "z", "q") for r in rows], SCHEMA)
    found = [(r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    prints = [brute_print(t) for _, t in rows]
    wanted = [(i, p, c) for (i, _), p, c in zip(rows, prints, brute_components([i for i, _ in rows], prints, 4), strict=True)]
    assert sorted(found, key=str) == sorted(wanted, key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "5", "6", "None", "None"]


def test_a_crowd_of_near_prints_keeps_every_link(spark, monkeypatch):
    """One dense ball of fingerprints, cut into many slices of variants."""
    monkeypatch.setattr(simhash, "VARIANTS_AT_ONCE", 50_000)
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    values = {centre}
    while len(values) < 400:
        values.add(rng.choice(sorted(values)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    values |= {rng.getrandbits(64) for _ in range(200)}
    signed = [v - 2**64 if v >= 2**63 else v for v in sorted(values)]
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    group = {r.node: r.component for r in components(simhash.links(prints, 4)).collect()}
    ids = sorted(range(len(signed)), key=lambda i: signed[i])
    wanted = brute_components(ids, [signed[i] % 2**64 for i in ids], 4)
    of = {signed[i]: w for i, w in zip(ids, wanted, strict=True)}
    pairs = {(group.get(v, v), of[v]) for v in signed}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_components_of_chains_rings_and_nothing(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, 203), (203, 201), (201, 200), (7, 7), (None, 3), (5, None)]
    of = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert of == {**{i: 0 for i in range(101)}, 200: 200, 201: 200, 203: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_the_query_over_the_whole_table(spark, star_folder):
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in op1_simhash(spark, star_folder).collect()}
    docs = table(spark, star_folder, "documents").collect()
    prints = [brute_print(r.text) for r in docs]
    wanted = brute_components([r.doc_id for r in docs], prints, 4)
    assert found == {r.doc_id: (f"{p:016x}", c) for r, p, c in zip(docs, prints, wanted, strict=True)}
