"""Sharding, HTML extraction, line frequency and chat formatting against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from demandloom.llm import chat, html, quality, sharding
from demandloom.llm.common import prepare
from demandloom.llm.queries import PROBE, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)


ODD = [(1, None, "a"), (2, "", "a"), (None, "x y z", None), (3, " \n\t ", "b"), (3, "x y z", "b"), (3, "x y z", "b"),
       (4, "é " * 30000, "a"), (5, "Ünï 💡\ncode", None)]


# --- sharding ------------------------------------------------------------------------


def check_shards(rows, docs):
    assert len(rows) == len(docs)
    expected = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    slots, places = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        places[r.doc_id].add((r.shard, r.grown_shard))
        assert r.law == "key" and r.grown_shard in (r.shard, sharding.SHARDS)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(p) == 1 for p in places.values())


def test_sharding_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check_shards(QUERIES["op2_rendezvous_sharding"](spark, sf_dir).collect(), docs)


def test_sharding_odd_rows(spark):
    docs = docs_of(spark, ODD)
    docs = docs.selectExpr("*", "1 AS shard", "2 AS slot", "'x' AS part")
    check_shards(sharding.assign(docs.repartition(5)).collect(), [(i, t) for i, t, _ in ODD])
    assert sharding.assign(docs.limit(0)).count() == 0


def test_sharding_weights(spark):
    from pyspark.sql import functions as F
    ids = spark.range(40000)
    got = Counter(r[0] for r in ids.select(sharding.rendezvous(F.col("id"), [1.0, 3.0, 4.0])).collect())
    assert abs(got[0] / 40000 - 1 / 8) < 0.01 and abs(got[2] / 40000 - 1 / 2) < 0.01
    moved = ids.where(sharding.rendezvous(F.col("id"), [1.0] * 9) != sharding.rendezvous(F.col("id"), [1.0] * 10))
    assert abs(moved.count() / 40000 - 1 / 10) < 0.01


# --- HTML ----------------------------------------------------------------------------


def plain(fragment):
    fragment = re.sub(r"</?b>", "", fragment)
    from html import unescape
    return " ".join(unescape(re.sub(r"<[^>]+>", " ", fragment)).split())


def test_html_query(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op3_html_main_text"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == plain(re.search(r"(?s)<article>(.*)</article>", pages[r.page_id])[1])
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("no tags at all here, just one plain sentence that goes on for quite a number of words", None),
    ("<article><p>a&amp;b &eacute;<b>x</b>y<!-- no --><p>Two</article>", "a&b éxy Two"),
    ("<nav>Menu</nav><article>One<script>var t='</p>';</script> two<form>Mail</form><footer>f</footer></article>", "One two"),
    ("<article><h1>T</h1><p>Hi</p><div class='comments'><p>Great post, I liked it very much indeed, thanks a lot for it all</p>"
     "</div></article><aside>side</aside>", "T Hi"),
    ("<div class='ad-banner'>" + html._LONG + "</div><article><p>Only this<br>line</p></article>", "Only this line"),
    ("<article><p>open <b>bold<p>next", "open bold next"),
])
def test_html_cases(page, text):
    got = html.main_text(page or "")
    assert got == (page if text is None else text)


@pytest.mark.parametrize("head, tail", [
    ("<head><title>x</title><body>", ""), ("<head><meta charset=u><title>x</title><style>p{}</style>", ""),
    ("<head><title>x</title></head><body>", ""), ("<svg width='1'/>", ""), ("<math/>", ""), ("<iframe src='u' />", ""), ("<canvas/>", ""),
    ("<svg><title>t</title><path d='M0'/></svg>", ""), ("<video src=v>", ""), ("<select><option>", ""), ("<object>", ""),
    ("<script>if (a</b) '<svg>'</script>", "<style>p {}"), ("<noscript>Turn it on</noscript>", "<script>rest"), ("<iframe src='u'>x</iframe>", "<!-- rest"),
])
def test_html_hidden_elements_hide_only_themselves(head, tail):
    assert html.main_text(f"{head}<article><h1>T</h1><p>Hi there</p></article>{tail}") == "T Hi there"


def test_html_many_open_elements():
    assert html.main_text("<svg><select>" * 100000 + "<article><p>Hi</p></article>") == "Hi"


def test_html_odd_rows(spark):
    df = spark.createDataFrame([(1, "u", None), (None, None, "<article>x</article>"), (1, "u", None)],
                               "page_id long, url string, html string").selectExpr("*", "'a' AS text", "1 AS n_chars")
    got = Counter(tuple(r) for r in html.extract(df).collect())
    assert got == Counter([(1, "u", "", 0), (1, "u", "", 0), (None, None, "x", 1)])
    assert html.extract(df.limit(0)).count() == 0
    deep = "<div>" * 3000 + "<article>" + "<p>word " * 20000 + "</article>"
    assert html.main_text(deep) == " ".join(["word"] * 20000)


# --- line frequency ------------------------------------------------------------------


def brute_lines(docs, rules):
    def norm(line):
        return re.sub(r"[1-9]", "0", " ".join(re.findall(r"[^\x20\x09-\x0D]+", line)).lower())

    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", t)

    seen, hosts = defaultdict(set), defaultdict(set)
    for _, t, s in docs:
        hosts[s or ""].add(t)
        for line in (t or "").split("\n"):
            if words(line):
                seen[s or "", norm(line)].add(t)
    common = {k for k, v in seen.items() if len(v) > rules.least and len(v) > rules.share * len(hosts[k[0]])}
    out = []
    for d, t, s in docs:
        w = words(t or "")
        grams = Counter(zip(w, w[1:], w[2:]))
        hit = set()
        for i, g in enumerate(zip(w, w[1:], w[2:])):
            if grams[g] > 1:
                hit |= {i, i + 1, i + 2}
        lines = [x for x in (t or "").split("\n") if words(x)]
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        left = sum(len(words(x)) for x in lines if (s or "", norm(x)) not in common)
        out.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)),
                    len(hit), failed, left, not failed and left >= rules.remaining * len(w)))
    return Counter(out), common


@pytest.mark.parametrize("rules", [quality.RULES, quality.LineRules(least=1, share=0.01, broadcast_rows=0)])
def test_line_frequency(spark, sf_dir, rules):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = [(r.doc_id, r.text, r.source) for r in df.collect()]
    expected, common = brute_lines(docs, rules)
    assert Counter(tuple(r) for r in quality.verdicts(df, rules).collect()) == expected
    kept = Counter(r[0] for r in expected.elements() if r[-1])
    cleaned = quality.clean(df, rules)
    assert cleaned.dtypes == df.dtypes
    rows = cleaned.collect()
    assert Counter(r.doc_id for r in rows) == kept and all(r.n_chars == len(r.text) for r in rows)


def test_line_frequency_odd_rows(spark):
    text = "\n".join(f"line {k} of " + " ".join(f"w{k}x{j}" for j in range(20)) for k in range(9))
    rows = [*ODD, *[(100 + i, f"{text}\nown {'abcdefgh'[i]}", "h") for i in range(8)], (9, "a b c " * 40, "h"), (10, "a a a a " * 30, None)]
    rules = quality.LineRules(least=3)
    df = docs_of(spark, rows).selectExpr("*", "1 AS kept", "array(1) AS n_words", "'q' AS _uid", "map(1, 2) AS _rest_")
    expected, common = brute_lines(rows, rules)
    assert common and Counter(tuple(r) for r in quality.verdicts(df, rules).collect()) == expected
    assert quality.clean(df, rules).columns == df.columns
    assert quality.verdicts(df.limit(0)).count() == 0 and quality.clean(df.limit(0)).count() == 0


def test_clean_removes_lines_in_place(spark):
    rows = [(i, "\n".join(["All rights reserved 2024", *[f"doc {'abcdefghij'[i]} " + " ".join(f"w{'abcdefghij'[i]}{k}{j}z" for j in range(9)) for k in range(8)], ""]), "h") for i in range(10)]
    got = {r.doc_id: r.text for r in quality.clean(docs_of(spark, rows), quality.LineRules(least=5)).collect()}
    assert got == {i: t.split("\n", 1)[1] for i, t, _ in rows}


# --- chat ----------------------------------------------------------------------------


def brute_chat(rows):
    out = {}
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        state, fault = "start", None
        for k, (_, r, _) in enumerate(turns):
            after = chat.TEMPLATE.moves.get(state, {}).get(r)
            if after is None and fault is None:
                fault = k
            state = after or state
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(),
                     len(loss), hashlib.sha256(loss.encode()).hexdigest(),
                     fault is None and state in chat.TEMPLATE.final, fault)
    return out


def digest(rows):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.valid, r.first_fault) for r in rows}


def test_chat_query(spark, sf_dir):
    turns = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    turns += [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)]
    assert digest(QUERIES["op7_chat_format"](spark, sf_dir).collect()) == brute_chat(turns)


def test_chat_odd_rows(spark):
    nasty = ["\\", "### ", "####  </turn></turn>\n", "\\### \\\\ </turn>", "a: b:: c: \\: d", "", None, "💡" * 9, "x\ny " * 20000, " ", "<\\/turn>"]
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(nasty)]
    rows += [(2, 0, "assistant", "no user"), (2, 1, None, "?"), (None, None, "user", None), (None, None, "tool: ### x", "y"),
             (3, 1, "user", "twice"), (3, 1, "user", "twice")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS segments", "2 AS valid")
    assert digest(chat.summaries(df).collect()) == brute_chat(rows)
    assert chat.summaries(df.limit(0)).count() == 0


def test_chat_segments_join_to_the_turn(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "a ### b")], "conv_id long, turn long, role string, text string")
    parts = chat.segments(df).head().segments
    assert [p.loss for p in parts] == [False, False, False, True, False]
    assert chat.read_turn("".join(p.text for p in parts)) == ("assistant", "a ### b")
