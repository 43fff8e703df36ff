"""The corpus pipeline, each stage held against its operator and against the documents it was given."""

from __future__ import annotations

import re
import zlib

import corpus_pipeline
import pytest
from waferscope.llm import pii, simhash, wordwise
from waferscope.llm.registry import table
from waferscope.llm.storage import stored

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = table(spark, FOLDER, "documents")
    made = [docs]
    for _, stage in corpus_pipeline.STAGES:
        made.append(stored(stage(spark, made[-1], FOLDER)))
    return made


def test_each_stage_keeps_columns_and_takes_effect(spark, steps):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash near-dedup", "benchmark decontamination", "pii", "packing"]
    docs, mild, single, clean, safe, packed = ([r.asDict() for r in df.collect()] for df in steps)
    assert all(df.columns == steps[0].columns for df in steps[1:-1])
    toxic = {r.doc_id: r.toxic for r in table(spark, FOLDER, "labels").collect()}
    kept = {d["doc_id"] for d in mild}
    right = [(i in kept) != bool(t) for i, t in toxic.items()]
    assert sum(right) / len(right) >= 0.95
    prints = {d["doc_id"]: simhash.fingerprint(d["text"]) for d in mild}
    parent = {i: i for i in prints}
    ids = sorted(prints)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                old, new = max(parent[i], parent[j]), min(parent[i], parent[j])
                parent = {k: new if v == old else v for k, v in parent.items()}
    assert {d["doc_id"] for d in single} == set(parent.values())
    items = [r.text.lower() for r in table(spark, FOLDER, "benchmark").collect()]
    held = {d["doc_id"] for d in single if any(item in d["text"].lower() for item in items)}
    assert held and held & {d["doc_id"] for d in clean} == set()
    assert len(single) - len(clean) <= 2 * len(held)
    before = {d["doc_id"]: d["text"] for d in clean}
    assert {d["doc_id"] for d in safe} == set(before)
    for d in safe:
        assert not any(s.base for s in pii.candidates(d["text"]) if pii.KINDS[s.kind] == "email")
        assert d["n_chars"] == len(d["text"])
        if not re.search(r"[0-9@]", before[d["doc_id"]]):
            assert d["text"] == before[d["doc_id"]]
    pieces: dict = {}
    for p in packed:
        assert zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"]
        pieces.setdefault(p["doc_id"], []).append(p)
    assert set(pieces) == set(before)
    tokenizer = wordwise.load("word_bpe_49k.json")
    for d in safe:
        ids = [*tokenizer.encode(d["text"], add_special_tokens=False).ids, 2]
        own = b"".join(bytes(p["ids"]) for p in sorted(pieces[d["doc_id"]], key=lambda p: p["start"]))
        assert own == b"".join(i.to_bytes(4, "little") for i in ids)


def test_run_gives_the_last_stage(spark, steps):
    columns = [c for c in steps[-1].columns if c != "sequence_id"]
    found = corpus_pipeline.run(spark, FOLDER).select(columns).collect()
    assert sorted(map(str, found)) == sorted(map(str, steps[-1].select(columns).collect()))


def test_stages_take_empty_tables(spark):
    docs = table(spark, FOLDER, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, FOLDER))
        assert docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == 0
