"""Quality rules on line frequency across documents, in DataFrame functions only.

Lines are normalised and hashed, and counted once per host and different
document text. A line that occurs in too large a share of a host's documents
is boilerplate: it is removed, and a document of which too little is left is
rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import SPACES, WORD_SPLIT, free_name, has_word, stage


@dataclass(frozen=True)
class LineRules:
    """A line is boilerplate if more than ``least`` documents of its host have it and more than ``share`` of them."""

    least: int = 20
    share: float = 0.05
    #: Share of its words that a document must keep.
    remaining: float = 0.5
    #: Largest table of boilerplate lines (some 30 bytes each) that is sent to every executor.
    broadcast_rows: int = 200_000


RULES = LineRules()


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_SPLIT))


def _n_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, WORD_SPLIT)))


def _line_hash(line: Column) -> Column:
    """Hash of the line in lower case, with single spaces and every digit as 0."""
    plain = F.translate(F.lower(F.btrim(line, F.lit(SPACES))), "123456789", "000000000")
    return F.xxhash64(F.regexp_replace(plain, WORD_SPLIT, " "))


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """The frame with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed appended.

    n_repeat_words counts the words inside three-word windows found twice or
    more. Equal windows become neighbours by sorting (hash, position), so the
    cost is n log n for any text; texts without a repeated window skip the sort.
    Every array that a lambda looks into is a column of the step before, so
    that no lambda evaluates a split or a sort again for each element.
    """
    words, hashes, windows, pairs, again = (free_name(docs, n) for n in ("_words", "_hashes", "_windows", "_pairs", "_again"))
    keep = [F.col(f"`{c}`") for c in docs.columns]
    raw = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    with_lines = F.filter(F.split(raw, "\n"), has_word)
    df = docs.select(*keep, _words(raw).alias(words), with_lines.alias(again))
    df = df.select(
        *keep,
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.translate(raw, SPACES, "")).cast("long").alias("word_chars"),
        (F.char_length(raw) - F.char_length(F.translate(raw, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size(again) - F.size(F.array_distinct(again))).cast("long").alias("n_dup_lines"),
        F.transform(words, lambda w: F.xxhash64(w)).alias(hashes))
    df = df.select(*keep, *counts, F.when(F.size(hashes) < 3, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.slice(hashes, 1, F.size(hashes) - 2),
        lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)))).alias(windows))
    df = df.select(*keep, *counts, F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias(pairs))
    df = df.select(*keep, *counts, F.filter(F.transform(pairs, lambda p, k: F.when(
        (F.get(pairs, k + 1)["h"] == p["h"]) | ((k > 0) & (F.get(pairs, k - 1)["h"] == p["h"])), p["i"])),
        lambda i: i.isNotNull()).alias(again))
    covered = F.array_union(F.array_union(F.col(again), F.transform(again, lambda i: i + 1)),
                            F.transform(again, lambda i: i + 2))
    repeated = F.when(F.col(again).isNull(), F.lit(0)).otherwise(F.size(covered)).cast("long")
    df = df.select(*keep, *counts, repeated.alias("n_repeat_words"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return df.select("*", failed.alias("base_failed"))


def boilerplate(docs: DataFrame, rules: LineRules = RULES) -> DataFrame:
    """The (host, line) pairs above the limits; host is the source, null a host like any other.

    Documents of a host with the same text are one document, so copies of a
    clean text do not make its lines boilerplate. All counts are combined
    before they are shuffled, so a line or host that holds a third of the rows
    reaches a task as one row per other task.
    """
    rows = docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
                       F.xxhash64("text").alias("content"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    lines = rows.select("host", "content", F.explode(F.split("text", "\n")).alias("line")).where(has_word(F.col("line")))
    once = lines.select("host", "content", _line_hash(F.col("line")).alias("line")).distinct()
    found = once.groupBy("host", "line").agg(F.count("*").alias("documents"))
    hosts = rows.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("all"))
    frequent = found.where(F.col("documents") > rules.least)
    # At most (lines of the host / least) rows a host are left here.
    return frequent.join(hosts, "host").where(F.col("documents") > rules.share * F.col("all")).select("host", "line")


def _judged_lines(docs: DataFrame, rules: LineRules, kept: list[Column]) -> DataFrame:
    """One row per line with its document's uid, the given columns, and ``common``: is it boilerplate.

    The uid is made and used for grouping in one job, within the task that read the row.
    """
    common = stage(boilerplate(docs, rules), "lines")
    few = common.count() <= rules.broadcast_rows
    common = common.select(F.col("host").alias("_host"), F.col("line").alias("_hash"), F.lit(True).alias("_common"))
    # Two steps: numbered in the same select as the explosion, every line would get a number of its own.
    numbered = docs.withColumn("_uid", F.monotonically_increasing_id())
    lines = numbered.select(
        "_uid", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_host"), *kept,
        F.posexplode(F.split(F.coalesce(F.col("text"), F.lit("")), "\n")).alias("_pos", "_line"))
    lines = lines.withColumn("_hash", _line_hash(F.col("_line")))
    return lines.join(F.broadcast(common) if few else common, ["_host", "_hash"], "left")


def verdicts(docs: DataFrame, rules: LineRules = RULES) -> DataFrame:
    """doc_id, the text's counts, base_failed, n_words_left after line removal, and kept.

    A document is kept if it has not failed the base rules and keeps at least
    ``remaining`` of its words. Null text is empty and fails. Null sources are
    one host. Repeated rows are judged each. An empty table gives no rows.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    counted = text_counts(docs.select("doc_id", "source", "text"))
    lines = _judged_lines(counted, rules, [F.col("doc_id"), *[F.col(n) for n in names]])
    left = F.sum(F.when(F.col("_common").isNull(), _n_words(F.col("_line"))).otherwise(0))
    return (
        lines.groupBy("_uid", "doc_id", *names).agg(left.cast("long").alias("n_words_left"))
        .select("doc_id", *names, "n_words_left",
                (~F.col("base_failed") & (F.col("n_words_left") >= rules.remaining * F.col("n_words"))).alias("kept"))
    )


def clean(docs: DataFrame, rules: LineRules = RULES) -> DataFrame:
    """The kept documents without their boilerplate lines, in the columns of the table.

    n_chars, where it is a column, becomes the length of the new text. Lines
    come together again by the uid of their row, never by doc_id, so repeated
    ids stay separate rows.
    """
    names = ["n_words", "base_failed"]
    rest = [c for c in docs.columns if c != "text"]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_rest"), "source", "text")
    counted = text_counts(packed)
    lines = _judged_lines(counted, rules, [F.col("_rest"), *[F.col(n) for n in names]])
    plain = F.col("_common").isNull()
    whole = (
        lines.groupBy("_uid").agg(
            F.first("_rest").alias("_rest"), F.first("n_words").alias("n_words"), F.first("base_failed").alias("failed"),
            F.sum(F.when(plain, _n_words(F.col("_line"))).otherwise(0)).alias("left"),
            F.sort_array(F.collect_list(F.when(plain, F.struct("_pos", "_line")))).alias("lines"))
        .where(~F.col("failed") & (F.col("left") >= rules.remaining * F.col("n_words")))
        .select("_rest", F.array_join(F.col("lines._line"), "\n").alias("text"))
    )
    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            return F.char_length("text").cast(docs.schema[name].dataType).alias(name)
        return F.col("_rest").getField(name).alias(name)

    return whole.select(*[column(c) for c in docs.columns])
