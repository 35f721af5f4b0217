"""Packing and token ids: exact round trips and brute force."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from demandloom.llm import packing
from demandloom.llm.common import prepare
from demandloom.llm.queries import QUERIES
from demandloom.llm.tokens import END_ID, WordIds, default_path

DOCS = "doc_id long, text string"
ODD = [None, "", " \n\t", "a|b || <|endoftext|> it's", "İstanbul ΣΑΣ  nbsp\x1cfs é ﬁ", "word " * 9000, "x", "x", "ç § § Ç\r\nç"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [END_ID]


@pytest.mark.parametrize("words", [8, 1000])
def test_word_cache_gives_the_tokenizers_ids(spark, sf_dir, tokenizer, words):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()][:80] + [t for t in ODD if t]
    encoder = WordIds(default_path(), words)
    for text in texts:
        assert encoder.encode(text).tolist() == ids_of(tokenizer, text)[:-1]


def check_pieces(rows, docs, ids_of_text, capacity=packing.CAPACITY):
    """Every id in exactly one piece, sequences gapless and within the capacity. docs: doc_id -> list of texts."""
    whole = {d: [ids_of_text(t) for t in texts] for d, texts in docs.items()}
    by, fill = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        fill[r.sequence_id].append((r.offset, r.length))
    assert set(by) == set(whole)
    for d, own in by.items():
        if len(whole[d]) == 1:
            ids, at = whole[d][0], 0
            for r in sorted(own, key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids)
                assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
                at += r.length
            assert at == len(ids)
        else:
            assert sum(r.length for r in own) == sum(map(len, whole[d]))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return [sum(n for _, n in p) for p in fill.values()]


def test_balanced_query(spark, sf_dir, tokenizer):
    prepare(spark)
    docs = {r.doc_id: [r.text] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    full = check_pieces(QUERIES["op5_cost_balanced_packing"](spark, sf_dir).collect(), docs, lambda t: ids_of(tokenizer, t))
    assert sum(packing.CAPACITY - n for n in full) < packing.CAPACITY


def test_packing_odd_rows(spark, tokenizer):
    prepare(spark)
    rows = [*enumerate(ODD), (None, "n"), (50, "same"), (50, "same")]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS start", "2 AS sequence_id").repartition(3)
    docs = defaultdict(list)
    for d, t in rows:
        docs[d].append(t)
    for tokens in (packing.BLOCK_TOKENS, 40):
        check_pieces(packing.pack_balanced(df, block_tokens=tokens).collect(), docs, lambda t: ids_of(tokenizer, t))
        check_matrices(packing.pack_matrices(df, block_tokens=tokens).collect(), docs, lambda t: ids_of(tokenizer, t))
    assert packing.pack_balanced(df.limit(0)).count() == 0 and packing.pack_matrices(df.limit(0)).count() == 0


def check_matrices(rows, docs, ids_of_text):
    parts = defaultdict(list)
    for r in rows:
        ids, positions = (np.frombuffer(x, "<u2") for x in (r.input_ids, r.position_ids))
        assert len(ids) == len(positions) == packing.CAPACITY and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert not ids[r.n_tokens:].any()
        for a, b, d, s in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.doc_starts):
            assert positions[a:b].tolist() == list(range(b - a))
            parts[d].append((s, ids[a:b].tolist()))
    assert set(parts) == set(docs)
    for d, texts in docs.items():
        if len(texts) == 1:
            assert sum((i for _, i in sorted(parts[d])), []) == ids_of_text(texts[0])
        else:
            assert sorted(sum((i for _, i in parts[d]), [])) == sorted(sum(map(ids_of_text, texts), []))


def test_matrix_query(spark, sf_dir, tokenizer):
    prepare(spark)
    docs = {r.doc_id: [r.text] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op4_best_fit_matrices"](spark, sf_dir).collect()
    check_matrices(rows, docs, lambda t: ids_of(tokenizer, t))
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert sum(r.n_tokens for r in rows) / (len(rows) * packing.CAPACITY) > 0.97


def brute_best_fit(lengths, capacity):
    pieces = sorted(((min(capacity, n - s), d, s) for d, n in enumerate(lengths) for s in range(0, n, capacity)),
                    key=lambda p: (-p[0], p[1], p[2]))
    rooms = []
    for n, _, _ in pieces:
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def test_best_fit_against_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        capacity = rng.choice([1, 2, 7, 64, 100])
        lengths = [rng.randint(1, 3 * capacity) for _ in range(rng.randint(1, 80))]
        pieces = packing.best_fit(lengths, capacity)
        used = defaultdict(int)
        for p in pieces:
            used[p.sequence] += p.length
        assert sorted(capacity - n for n in used.values()) == brute_best_fit(lengths, capacity)


def test_balance_spreads_the_cost():
    rng = random.Random(5)
    lengths = [rng.randint(1, 400) for _ in range(3000)]
    pieces = packing.balance(lengths)
    spent, filled = defaultdict(float), defaultdict(int)
    for p in pieces:
        spent[p.sequence] += packing.cost(p.length)
        filled[p.sequence] += p.length
    assert len(filled) == -(-sum(lengths) // packing.CAPACITY)
    full = [spent[s] for s, n in filled.items() if n > 0.9 * packing.CAPACITY]
    assert max(full) / min(full) < 1.2
