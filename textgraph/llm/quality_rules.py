"""Quality rules with cross-document line frequency (operator 6); DataFrame functions only.

A first pass over the texts hashes each document's normalised lines.  A line counts once per document and host.  It is
boilerplate where it stands in more than ``min_docs`` documents of a host and in more than ``max_share`` of them, or, where
``max_docs`` is given, in more than that many documents of a host of any size, so that what is boilerplate doesn't fade as a host
grows.  A second pass takes the boilerplate lines out of the texts, by their places, and measures the documents; a document that
keeps less than ``min_left`` of its characters is depleted and rejected.

Counts are pre-aggregated before they are shuffled, the limit by number is applied before the host's size is joined,
and a hot line meets the short list of boilerplate in a join that adaptive execution can broadcast or split.  Only ids and
places of lines that go meet the texts, broadcast while they are few.

Defined cases: a null or empty text has no words and no lines and fails the base rules, and stays as it is; a null host is the
host ''; equal and null ids stay separate rows; lines without a word are never counted or removed; extra columns are ignored;
no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.functions.text import let
from textgraph.llm.common import keyed, small, stored, without

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5


def _repeated_words(hashes: Column) -> Column:
    """Words under windows that occur twice or more: the hashes are sorted and compared with their neighbours."""
    return F.aggregate(F.zip_with(hashes, F.slice(hashes, 2, F.greatest(F.size(hashes), F.lit(1))), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda n, x: n + x)


def _lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _name(line: Column) -> Column:
    """The hash of a normalised line."""
    return F.xxhash64(F.trim(F.regexp_replace(F.lower(line), SPACE, " ")))


def _chars(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0).cast("long"), lambda n, x: n + F.length(x))


def measured(texts: DataFrame, *carried: str) -> DataFrame:
    """One row per text (column text, no nulls): the carried columns and the base measures."""
    df = texts.select(
        *carried,
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        _lines(F.col("text")).alias("lines"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    starts = F.sequence(F.lit(0), F.size("words") - WINDOW)
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]))
    df = df.select(
        *carried,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")).alias("windows"),
        _chars(F.col("lines")).alias("line_chars"),
    )
    # only documents in which a window recurs are sorted
    found = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("windows", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), found).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    same = lambda x, k: F.coalesce(F.get("windows", k)["h"] == x["h"], F.lit(False))
    marked = F.transform("windows", lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))
    df = df.withColumn("windows", F.sort_array(F.filter(marked, lambda i: i.isNotNull())))
    return df.withColumn("n_repeat_words", _repeated_words(F.col("windows"))).drop("windows")


def boilerplate(rows: DataFrame, min_docs: int, max_share: float, max_docs: int | None = None) -> DataFrame:
    """(host, h): the lines that stand in too many of a host's documents."""
    once = rows.select("host", F.explode(F.array_distinct("lines")).alias("h"))
    least = min_docs if max_docs is None else min(min_docs, max_docs)
    often = once.groupBy("host", "h").agg(F.count("*").alias("n")).where(F.col("n") > least)
    hosts = rows.groupBy("host").agg(F.count("*").alias("docs"))
    many = (F.col("n") > min_docs) & (F.col("n") > max_share * F.col("docs"))
    if max_docs is not None:
        many |= F.col("n") > max_docs
    return often.join(hosts, "host").where(many).select("host", "h")


def _staying(lines: Column, gone: Column) -> Column:
    """A text's lines without those at some places, counted over the lines that hold a word."""
    real = F.filter(F.transform(lines, lambda x, k: F.when(x.rlike(r"[^\x20\x09-\x0D]"), k)), lambda k: k.isNotNull())
    return let(real, lambda own: without(lines, F.transform(gone, lambda k: F.get(own, k))))


def apply_rules(docs: DataFrame, min_docs: int = 20, max_share: float = 0.05, min_left: float = 0.5, id_col: str = "doc_id",
                text_col: str = "text", host_col: str = "source", max_docs: int | None = None) -> DataFrame:
    """Per document the base measures, text (without boilerplate lines), removed_chars, line_chars, base_failed and kept."""
    own = keyed(docs, id_col, text_col)
    host = F.coalesce(F.col("row")[host_col].cast("string"), F.lit("")).alias("host")
    rows = stored(own.select("id", host, F.transform(_lines(F.col("text")), _name).alias("lines")), "lines")
    frequent = boilerplate(rows, min_docs, max_share, max_docs)
    each = rows.select("id", "host", F.posexplode("lines").alias("k", "h"))
    gone = stored(each.join(frequent, ["host", "h"], "left_semi").groupBy("id").agg(F.collect_list("k").alias("gone")), "gone")
    # the lines of texts that lose none are not hashed again
    left = F.when(F.col("gone").isNotNull(), let(F.split("text", "\n"), lambda own: F.array_join(_staying(own, F.col("gone")), "\n")))
    original = F.col("row")[text_col]
    texts = own.join(small(gone), "id", "left").select(F.col("row")[id_col].alias("doc_id"), original.alias("original"), "text", left.alias("left"))
    out = measured(texts, "doc_id", "original", "left")
    removed = F.when(F.col("left").isNotNull(), F.col("line_chars") - _chars(_lines(F.col("left")))).otherwise(0).cast("long")
    out = out.withColumn("removed_chars", removed)
    out = out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    rest = F.col("line_chars") - F.col("removed_chars")
    out = out.withColumn("kept", ~F.col("base_failed") & (rest >= min_left * F.col("line_chars")))
    return out.withColumn("text", F.coalesce("left", "original")).drop("original", "left")
