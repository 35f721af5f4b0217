"""The operators as queries over whole tables. Each takes (session, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import chat, decontamination, html, lexical, lm, merkle, packing, pii, quality, sharding, simhash, toxicity
from demandloom.llm.common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Words are runs of anything but space and the characters 9 to 13; DuckDB's re2 counts code points as Spark does.
_OP6 = r"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id, coalesce(source, '') AS host, text AS raw, coalesce(text, '') AS text
  FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM d
), grams AS (
  SELECT uid, i, words[i:i+2] AS gram FROM (SELECT uid, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), again AS (
  SELECT uid, count(DISTINCT p) AS n FROM (
    SELECT uid, unnest([i, i + 1, i + 2]) AS p FROM grams
    QUALIFY count(*) OVER (PARTITION BY uid, gram) > 1) GROUP BY uid
), line AS (
  SELECT uid, host, raw, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
    translate(lower(array_to_string(regexp_extract_all(l, '[^\x20\x09-\x0D]+'), ' ')), '123456789', '000000000') AS norm
  FROM (SELECT uid, host, raw, unnest(lines) AS l FROM w)
), common AS (
  SELECT host, norm FROM (SELECT host, norm, count(DISTINCT raw) AS k FROM line GROUP BY host, norm)
  JOIN (SELECT host, count(DISTINCT raw) AS docs FROM d GROUP BY host) USING (host)
  WHERE k > 20 AND k > 0.05 * docs
), kept AS (
  SELECT uid, sum(CASE WHEN c.host IS NULL THEN n ELSE 0 END) AS n
  FROM line l LEFT JOIN common c ON c.host = l.host AND c.norm = l.norm GROUP BY uid
), counts AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(a.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(k.n, 0) AS BIGINT) AS n_words_left
  FROM w LEFT JOIN again a USING (uid) LEFT JOIN kept k USING (uid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_words_left,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words_left >= 0.5 * n_words AS kept
FROM counts
"""

_OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), docs AS (SELECT uid, doc_id, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM docs),
posting AS (SELECT uid, term, count(*) AS tf FROM (SELECT uid, unnest(terms) AS term FROM d) GROUP BY uid, term),
weight AS (SELECT term, CAST(floor(1000 * ln((2.0 * t.docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM posting CROSS JOIN total t GROUP BY term, t.docs),
item AS (
  SELECT DISTINCT number, item_id, term FROM (SELECT number, item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS number, item_id, text FROM benchmark))
), scored AS (
  SELECT i.number, i.item_id, p.uid, x.doc_id,
    CAST(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (50 + (50 * x.n * t.docs) // t.terms)))) AS BIGINT) AS score
  FROM item i JOIN posting p ON i.term = p.term JOIN weight w ON w.term = p.term JOIN docs x ON x.uid = p.uid CROSS JOIN total t
  GROUP BY i.number, i.item_id, p.uid, x.doc_id
), placed AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY number ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM placed WHERE rank <= 50
"""

def _part(value: str) -> str:
    return f"coalesce(CAST(strlen({value}) AS VARCHAR) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return f"sha256({' || '.join(map(_part, values))})"


def _nodes(name: str, leaves: str) -> str:
    """All nodes of the trees, with the siblings left and right of each."""
    return f"""{name}_nodes AS (
  SELECT tree, CAST(0 AS BIGINT) AS level, r AS idx, digest, n FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3
  FROM {name}_nodes WHERE n > 1 GROUP BY tree, level, idx // 3, n
), {name}_paths AS (
  SELECT *, coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS left_,
    coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS right_
  FROM {name}_nodes WINDOW run AS (PARTITION BY tree, level, idx // 3 ORDER BY idx)
)"""


def _walk(name: str, begin: str) -> str:
    return f"""{name}_walk AS (
  SELECT uid, tree, CAST(0 AS BIGINT) AS level, idx, folded, proof FROM {begin}
  UNION ALL
  SELECT w.uid, w.tree, w.level + 1, w.idx // 3, sha256(p.left_ || w.folded || p.right_), w.proof || p.left_ || p.right_
  FROM {name}_walk w JOIN {name}_paths p ON p.tree = w.tree AND p.level = w.level AND p.idx = w.idx WHERE p.n > 1
), {name}_end AS (SELECT uid, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof FROM {name}_walk GROUP BY uid)"""


# CRC32 byte by byte, with the reflected polynomial 0xEDB88320.
_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
  string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), CAST(range(8) AS BIGINT[])),
    lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS BIGINT)) ELSE x // 2 END)))"""
_OP13 = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS uid, doc_id, source, {_leaf('text')} AS digest,
    CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS tampered
  FROM documents
), ranked AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS r FROM leaves
), {_nodes('lower_', 'ranked')},
tops AS (SELECT 0 AS tree, tree AS r, digest, count(*) OVER () AS n FROM lower__nodes WHERE n = 1),
{_nodes('upper_', 'tops')},
begin_ AS (SELECT uid, tree, r AS idx, coalesce(tampered, digest) AS folded, '' AS proof FROM ranked),
{_walk('lower_', 'begin_')},
middle AS (SELECT e.uid, 0 AS tree, r.tree AS idx, e.folded, e.proof FROM lower__end e JOIN ranked r USING (uid)),
{_walk('upper_', 'middle')}
SELECT r.doc_id, r.digest AS leaf, t.digest AS subroot, top.digest AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root,
  e.folded = top.digest AS verified, r.r AS rank
FROM ranked r JOIN upper__end e USING (uid) JOIN tops t ON t.r = r.tree CROSS JOIN (SELECT digest FROM upper__nodes WHERE n = 1) top
"""
ORACLE_SQL: dict[str, str] = {"op6_line_frequency": _OP6, "op11_geometric_blocking": _OP11, "op13_merkle_manifest": _OP13}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


@query
def op1_latent_decontamination(spark, sf_dir):
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_rendezvous_sharding(spark, sf_dir):
    return sharding.assign(table(spark, sf_dir, "documents"))


@query
def op3_html_main_text(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


@query
def op4_best_fit_matrices(spark, sf_dir):
    return packing.pack_matrices(table(spark, sf_dir, "documents"))


@query
def op5_cost_balanced_packing(spark, sf_dir):
    return packing.pack_balanced(table(spark, sf_dir, "documents"))


@query
def op6_line_frequency(spark, sf_dir):
    return quality.verdicts(table(spark, sf_dir, "documents"))


#: The conversation that tries the template's own marks.
PROBE = "\\### Assistant: </turn> ok"


@query
def op7_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    return chat.summaries(turns.unionByName(probe))


@query
def op9_simhash_components(spark, sf_dir):
    return simhash.components(table(spark, sf_dir, "documents"))


@query
def op10_weak_supervision_pii(spark, sf_dir):
    return pii.detect(table(spark, sf_dir, "documents"))


@query
def op8_attention_scores(spark, sf_dir):
    return lm.scores(table(spark, sf_dir, "documents"))


@query
def op13_merkle_manifest(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))


@query
def op11_geometric_blocking(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_subword_toxicity(spark, sf_dir):
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
