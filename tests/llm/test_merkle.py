"""The Merkle manifest against a plain recomputation of every tree and proof."""

from __future__ import annotations

from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import pytest

from demandloom.llm import merkle
from demandloom.llm.common import prepare
from demandloom.llm.queries import QUERIES


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(levels, at):
    """(left, right) of the path, from the leaf up."""
    for level in levels[:-1]:
        run = at // 3 * 3
        yield "".join(level[run:at]), "".join(level[at + 1:run + 3])
        at //= 3


def brute(rows):
    trees = defaultdict(list)
    for row in rows:
        trees[row["source"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row, row["text"]), row))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for source in order:
        trees[source].sort(key=lambda x: x[:3])
        built[source] = levels_of([x[2] for x in trees[source]])
    upper = levels_of([built[s][-1][0] for s in order])
    root, out = upper[-1][0], Counter()
    for place, source in enumerate(order):
        for at, (_, _, own, row) in enumerate(trees[source]):
            path = [*siblings(built[source], at), *siblings(upper, place)]
            text, doc_id = row["text"], row["doc_id"]
            if doc_id is not None and text is not None and crc32(str(doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf(row, text)
            for left, right in path:
                folded = h(left, folded, right)
            out[(doc_id, own, built[source][-1][0], root, h(*[s for p in path for s in p]), folded, folded == root, at)] += 1
    return out


def check(df, depth=merkle.LEVELS):
    got = merkle.manifest(df, depth)
    assert Counter(map(tuple, got.collect())) == brute([r.asDict() for r in df.collect()])
    return got


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_query(spark, sf_dir):
    rows = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op13_merkle_manifest"](spark, sf_dir).collect()
    assert Counter(map(tuple, got)) == brute(rows)
    assert {r.verified for r in got} == {True, False}


@pytest.mark.parametrize("depth", [1, 5])
def test_deep_and_hot_sources(spark, depth):
    """Segments of few levels make several rounds; one source holds most rows, others one row each."""
    prepare(spark)
    docs = [(k, f"a {k}\nb", "en", "hot", k) for k in range(100)]
    docs += [(1000 + k, f"c\n{k}", None, f"s{k:02}", None) for k in range(12)]
    check(spark.createDataFrame(docs, SCHEMA).repartition(7), depth)


def test_odd_rows(spark):
    """Nulls in every column, empty text, repeated rows and ids, several scripts, clashing extra columns."""
    prepare(spark)
    docs = [(None, None, None, None, None), (None, "a\nb", "en", None, 3), (2, "", "en", "", 0), (2, "", "en", "", 0), (2, "x\n", "en", "", 0),
            (-5, "ä\n€\n", "de", "ß", 4), (7, None, "en", "Z", 1), (8, "\n" * 1000, "en", "a", 1000), (8, "\n" * 1000, "en", "a", 1000)]
    extra = ", ".join(f"'x' AS {c}" for c in ("digest", "tree", "rank", "uid", "at", "load", "tampered", "part"))
    check(spark.createDataFrame(docs, SCHEMA).selectExpr("*", extra.split(", ")[0], *extra.split(", ")[1:]))


def test_single_and_no_row(spark):
    prepare(spark)
    one = spark.createDataFrame([(1, "a", "en", "s", 1)], SCHEMA)
    row = check(one).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified and row.proof_sha256 == h()
    none = merkle.manifest(one.limit(0))
    assert none.count() == 0 and none.columns == merkle.manifest(one).columns
