"""Personal data: base spans against plain regular expressions, the model on planted spans."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from demandloom.llm import pii
from demandloom.llm.common import prepare
from demandloom.llm.queries import QUERIES


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.findall("[0-9]", m[0])) <= 15]
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.-+ 0129(){}é%", max_size=60))
def test_base_spans_on_random_text(text):
    assert pii.base_spans(text) == brute(text)


def test_base_spans_on_long_runs():
    for text in ("1" * 60000, "1." * 50000, "a" * 60000 + "@b", "a@" * 30000, "+1" + "-" * 60000, "1 " * 60000):
        assert isinstance(pii.base_spans(text), list)
    assert pii.base_spans("x 4111 1111 1111 1111 y") == [("card", 2, 21)]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def check(rows, texts):
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        base = brute(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        for kind in pii.BASE:
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in base)
        assert {joined([s]) for s in base} <= set(r.spans.split(","))


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smallest sample holds no secrets
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op10_weak_supervision_pii"](spark, sf_dir).collect()
    check(rows, texts)
    secrets = {d: [(m.start(1), m.end(1)) for m in re.finditer(r'token = "([0-9a-f]{40})"', t)] for d, t in texts.items()}
    assert any(secrets.values())
    for r in rows:
        got = [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("secret")]
        assert got == secrets[r.doc_id]
        assert all(s.split(":")[0] in (*pii.BASE, "secret") for s in r.spans.split(",") if s)


def planted():
    rng, texts, truth = random.Random(1), {}, {}
    shapes = {
        "ssn": lambda: ("her ssn is ", f"{rng.randint(100, 600)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"),
        "name": lambda: ("please contact Mr ", rng.choice(["John", "Klaus", "Ana"]) + " " + rng.choice(["Smith", "Weber", "Ruiz"])),
        "phone": lambda: ("call me at ", f"({rng.randint(200, 900)}) {rng.randint(200, 900)}-{rng.randint(1000, 9999)}"),
        "iban": lambda: ("pay to iban ", "DE89 3704 0044 0532 0130 00"),
        "secret": lambda: ("password: ", "".join(rng.choice("abcdef0123456789") for _ in range(32))),
    }
    for d in range(300):
        kind = rng.choice([*shapes, None, None])
        if kind:
            head, value = shapes[kind]()
            texts[d] = f"some words before, {head}{value} and after"
            truth[d] = (kind, 19 + len(head), 19 + len(head) + len(value))
        else:
            texts[d] = rng.choice(["version: 1.2.3 of page 12", "order no 123-45-67 came", "checksum: 0000000000000000000000",
                                   "The Old House was sold", "in 1999 - 2001", "ratio=aaaaaaaaaaaaaaaaaaaaaaaa"])
    return texts, truth


def test_added_spans_on_planted_cases(spark):
    prepare(spark)
    texts, truth = planted()
    df = spark.createDataFrame([(d, t) for d, t in texts.items()], "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in pii.detect(df).collect()}
    right = sum(rows[d] == joined([truth[d]] if d in truth else []) for d in texts)
    assert right >= 0.95 * len(texts)


def test_reliabilities_follow_the_votes():
    rng = random.Random(2)
    counts = {}
    for _ in range(5000):
        y = rng.random() < 0.5
        vote = [(1 if (rng.random() < p) == y else -1) for p in (0.95, 0.9, 0.85, 0.6, 0.9)]
        one = ("name", *vote, 1)
        counts[one] = counts.get(one, 0) + 1
    reliability, _ = pii.expectation_maximisation(counts)
    assert reliability["name"] == pytest.approx((0.95, 0.9, 0.85, 0.6, 0.9), abs=0.03)


def test_odd_rows_and_masks(spark):
    prepare(spark)
    rows = [(1, None, None), (2, "", 0), (3, "mail a@b.co or +1 (743) 555-3824, 4111111111111111!", 5), (4, "x " * 50000, 1),
            (5, "same 10.0.0.1", 1), (6, "same 10.0.0.1", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").selectExpr("*", "1 AS spans", "map(1, 2) AS n_email")
    check(pii.detect(df).collect(), {r[0]: r[1] for r in rows})
    done = {r.doc_id: r for r in pii.mask(df).collect()}
    assert done[3].text == "mail [EMAIL] or [PHONE], [CARD]!" and done[3].n_chars == len(done[3].text)
    assert done[1].text is None and done[5].text == "same [IP]" and done[4].n_chars == 100000
    assert pii.mask(df).columns == df.columns
    nulls = df.where("doc_id = 2").selectExpr("CAST(NULL AS bigint) AS doc_id", "text")
    assert [tuple(r)[:2] for r in pii.detect(nulls).collect()] == [(None, 0)]
    assert pii.detect(df.limit(0)).count() == 0 and pii.mask(df.limit(0)).count() == 0


@pytest.mark.parametrize("text, name", [
    ("he came (John Smith) late", "John Smith"), ('he said "John Smith" there', "John Smith"), ("text by:John Smith here", "John Smith"),
    ("ask Ms Xenia Qvist now", "Xenia Qvist"), ("ask Prof Xenia Qvist now", "Xenia Qvist"), ("con la Señora Xenia Qvist hoy", "Xenia Qvist"),
    ("signed Xenia Qvist", "Xenia Qvist"), ("written by Xenia Qvist in it", "Xenia Qvist"),
])
def test_names_are_candidates_whatever_stands_elsewhere(text, name):
    assert ("name", text.index(name), text.index(name) + len(name)) in pii.candidates(text)[1]
    assert pii.candidates("The Old House. " + "x " * 20 + text)[1] == [("name", 55 + text.index(name), 55 + text.index(name) + len(name))]


def test_names_without_a_listed_token_are_masked(spark):
    prepare(spark)
    rng = random.Random(3)
    heads = ["please contact Mr John ", "the note (Klaus ", "text by:Maria ", "signed Ana "]
    tails = ["Smith", "Weber", "Ruiz"]
    docs = {d: rng.choice(heads) + rng.choice(tails) + ") said so" if d % 2 else "The Old House was sold in Green Valley"
            for d in range(200)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    done = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert all("[NAME]" in done[d] if d % 2 else done[d] == docs[d] for d in docs)
