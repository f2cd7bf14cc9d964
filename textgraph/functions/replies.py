"""Parsing of model replies into columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textgraph.functions.text import WS, strip

TRIPLES = "array<struct<subject:string,predicate:string,object:string>>"


def block(text: Column, name: str) -> Column:
    """The first [NAME]...[/NAME] block, trimmed; null where there is none."""
    pattern = rf"(?is)\[{name}\](.*?)\[/{name}\]"
    return F.when(text.rlike(pattern), strip(F.regexp_extract(text, pattern, 1)))


def _triples(lines: Column, keep_empty: bool) -> Column:
    parts = F.transform(lines, lambda x: F.filter(F.transform(F.split(x, r"\|\|"), strip), lambda p: F.lit(keep_empty) | (F.length(p) > 0)))
    full = F.filter(parts, lambda p: F.size(p) >= 3)
    return F.transform(full, lambda p: F.struct(p[0].alias("subject"), p[1].alias("predicate"), p[2].alias("object")))


def triples_of_block(reply: Column) -> Column:
    """subject||predicate||object lines of the first block; bullets and empty parts are dropped."""
    lines = F.transform(F.split(F.coalesce(block(reply, "TRIPLES"), F.lit("")), "\n"), lambda x: strip(F.regexp_replace(strip(x), "^[- ]+", "")))
    return _triples(F.filter(lines, lambda x: F.length(x) > 0), keep_empty=False)


def triples_of_lines(reply: Column) -> Column:
    """subject||predicate||object lines anywhere; empty parts stay."""
    lines = F.transform(F.split(reply, "\n"), strip)
    return _triples(F.filter(lines, lambda x: F.contains(x, F.lit("||"))), keep_empty=True)


def format_triples(triples: Column) -> Column:
    return F.array_join(F.transform(triples, lambda t: F.concat_ws("||", t["subject"], t["predicate"], t["object"])), "\n")


def verdict(reply: Column) -> Column:
    """(passed, feedback): passed if the verdict block says PASS and not FAIL."""
    said = F.upper(F.coalesce(block(reply, "VERDICT"), F.lit("")))
    passed = F.contains(said, F.lit("PASS")) & ~F.contains(said, F.lit("FAIL"))
    return F.struct(passed.alias("passed"), F.coalesce(block(reply, "FEEDBACK"), F.lit("")).alias("feedback"))


def groups(reply: Column) -> Column:
    """Each [GROUP] block's lines, trimmed, without empty ones."""
    blocks = F.regexp_extract_all(reply, F.lit(r"(?is)\[GROUP\](.*?)\[/GROUP\]"), F.lit(1))
    return F.transform(blocks, lambda b: F.filter(F.transform(F.split(b, "\n"), strip), lambda x: F.length(x) > 0))


def index_range(choice: Column, n: Column) -> Column:
    """Sorted distinct indices of a choice such as 0,2-4: numbers and inclusive ranges below n; all means every one."""
    each = F.transform(F.split(choice, "[,，]"), strip)

    def numbers(x: Column) -> Column:
        low, high = (F.regexp_extract(x, rf"^(\d+){WS}*-{WS}*(\d+)", k).try_cast("int") for k in (1, 2))
        one = F.when(x.rlike(r"^\d+$"), x.try_cast("int"))
        return F.when(low.isNotNull(), F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))).when(one.isNotNull(), F.array(one)).otherwise(F.array().cast("array<int>"))

    picked = F.filter(F.flatten(F.transform(each, numbers)), lambda i: i < n)
    everything = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.when(F.lower(choice) == "all", everything).otherwise(F.array_sort(F.array_distinct(picked)))
