"""Personal data: base spans against the plain patterns, and what the labelers add."""

from __future__ import annotations

import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st
from waferscope.llm import pii
from waferscope.llm.registry import op10_pii, table

PIECES = ["a.b+c@x-y.com", "@", "x@y", "a@b.c@d.e", "1.2.3.4", "256.1.1.1", "01.002.3.0004", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112",
          "378282246310005", "+1 (974) 555-3436", "+49.30-1234567", "+1", "++1 2345678", " ", "-", ".", "7", "é", "\n", "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"",
          "(974) 555-3436", "joe (at) site (dot) com", "4111111111111111"]


def brute(text: str) -> list[tuple]:
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


def base(text: str) -> list[tuple]:
    return [(pii.KINDS[s.kind], s.start, s.end) for s in pii.candidates(text) if s.base]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text("ab@.+-1 0(9)", max_size=8)), max_size=8).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    assert base(text) == brute(text)
    spans = sorted((s.start, s.end) for s in pii.candidates(text) if not s.base)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_long_runs_take_linear_time():
    for run in ("a" * 200_000 + "@", "1" * 200_000 + ".1", "1 " * 100_000, "+1" + "(" * 200_000, "a@" * 100_000, "1.2." * 50_000):
        assert base(run) == [] or len(base(run)) > 10


def test_reliabilities_are_recovered_from_votes():
    rng = random.Random(2)
    chances = [(0.9, 0.1), (0.8, 0.2), (0.95, 0.3), (0.6, 0.4), (0.7, 0.1)]
    patterns: dict = {}
    for _ in range(4_000):
        real = rng.random() < 0.3
        cast = tuple(1 if rng.random() < (right if real else wrong) else -1 for right, wrong in chances)
        patterns[(2, cast)] = patterns.get((2, cast), 0) + 1
    priors, reliabilities, chance = pii.estimate(patterns)
    assert abs(priors[2] - 0.3) < 0.06
    for j, (right, wrong) in enumerate(chances):
        assert abs(reliabilities[2, j, 1, 2] - right) < 0.08 and abs(reliabilities[2, j, 0, 2] - wrong) < 0.08
    assert chance[(2, (1, 1, 1, 1, 1))] > 0.9 > 0.1 > chance[(2, (-1, -1, -1, -1, -1))]
    assert np.isfinite(pii.estimate({})[0]).all()


def test_odd_rows_and_redaction(spark):
    text = 'Mail a@b.com, ip 10.0.0.1, card 4111 1111 1111 1111, call +1 (974) 555-3436 now; token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" x'
    rows = [(1, None), (2, ""), (3, text), (3, text), (None, "é é a@b.com"), (4, "nothing here"), (5, "x " * 200_000 + "a@b.com")]
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, n_chars int, spans string")
    found = sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in r.spans if s.base]) for r in pii.find(docs).collect()), key=str)
    assert found == sorted(((i, brute(t or "")) for i, t in rows), key=str)
    model = pii.train(docs)
    clean = sorted(((r.doc_id, r.text, r.n_chars) for r in pii.redacted(docs, model).collect()), key=str)
    hidden = "Mail <email>, ip <ip>, card <card>, call <phone> now; token = \"<secret>\" x"
    wanted = [(1, None, 7), (2, "", 0), (3, hidden, len(hidden)), (3, hidden, len(hidden)), (None, "é é <email>", 11), (4, "nothing here", 12), (5, "x " * 200_000 + "<email>", 400_007)]
    assert clean == sorted(wanted, key=str)
    assert pii.redacted(docs, model).columns == docs.columns
    assert pii.find(docs.limit(0)).count() == 0 and pii.redacted(docs.limit(0), model).count() == 0


def test_the_query_over_the_whole_table(spark, star_folder):
    docs = {r.doc_id: r.text or "" for r in table(spark, star_folder, "documents").collect()}
    found = op10_pii(spark, star_folder).collect()
    assert {r.doc_id for r in found} == set(docs) and len(found) == len(docs)
    for r in found:
        spans = brute(docs[r.doc_id])
        assert r.base_sha256 == pii.digest(spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in pii.BASE_KINDS)
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(r.spans.split(","))


def test_long_secrets_are_spans_to_their_end():
    rng = random.Random(5)
    named = "".join(rng.choices("ghijklmnopqrstuvwxyzGHIJKLMNOP_/+=-", k=450))
    digits = "".join(rng.choice("abcdef") + rng.choice("0123456789") for _ in range(64))
    for text, secret in ((f"api_key: {named} x", named), (f"seen {digits} x", digits), (f"seen {digits * 4} x", digits * 4)):
        start = text.index(secret)
        assert pii.candidates(text) == [pii.Span(4, start, start + len(secret), False)]
    # A card's number inside is part of the secret.
    whole = f"{named}-4111111111111111-{named}"
    card, secret = pii.candidates(f"password={whole}")
    assert (card.kind, card.base) == (2, True) and (secret.start, secret.end, secret.base) == (9, 9 + len(whole), False)
    for run in ("a" * 400_000, "token=" * 70_000, "a" * 31 + "g" + "a" * 400_000 + "g"):
        assert len(pii.candidates(run)) <= 1


def test_long_secrets_are_replaced_whole(spark):
    rng = random.Random(6)
    rows, secrets = [], []
    for i in range(60):
        secret = "".join(rng.choices("0123456789abcdef", k=rng.choice([32, 40, 64])))
        rows.append((i, f"word {i} and token = {secret} or {secret} here"))
    for n in (300, 450):
        secrets.append("".join(rng.choices("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOP", k=n)))
        rows.append((n, f"my password: {secrets[-1]} here"))
    secrets.append("".join(rng.choices("0123456789abcdef", k=128)))
    rows.append((128, f"the value {secrets[-1]} here"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.redacted(docs, pii.train(docs)).collect()}
    assert clean[300] == clean[450] == "my password: <secret> here" and clean[128] == "the value <secret> here"


SPOKEN = ["jane", " at ", "(at)", "[at]", " (at) ", " dot ", "(dot)", "[dot]", " (dot) ", " [dot] ", "example", "org", " ", ".", "deadbeef" * 4, "api-key: abcdefghijklm"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(SPOKEN), max_size=8).map("".join))
def test_every_pattern_is_looked_for_in_every_text(text):
    found = [(s.start, s.end) for s in pii.candidates(text)]
    for span in pii._others(text):
        assert any(a < span.end and span.start < b for a, b in found)


def test_spoken_addresses_without_digits():
    for text in ("jane at example (dot) org", "jane at example[dot]com", "jane (at) example [dot] com", "jane at example dot org"):
        assert [(s.kind, s.start, s.end) for s in pii.candidates(text)] == [(0, 0, len(text))]
