"""Sentence splitting and greedy grouping as array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textgraph.functions.text import WS, let, strip
from textgraph.functions.vocabulary import ABBREVIATIONS

CHUNK = 800


def sentence_parts(text: Column) -> Column:
    """A text cut behind its sentences; white space between two belongs to the second.  A sentence ends at . ! or ? if nothing but
    space follows, or if a capital follows next to a blank.  An abbreviation only holds a sentence together before two full stops."""
    guards = "".join(rf"(?<!\b{a}\.\.)" for a in ABBREVIATIONS)
    ahead = rf"(?={WS}*\z| {WS}*\p{{Lu}}|{WS} {WS}*\p{{Lu}}|\p{{Lu}} )"
    return F.split(text, rf"(?<=[.!?]){guards}{ahead}")


def paragraphs(sentence: Column, chunk: int = CHUNK) -> Column:
    """A stripped sentence, or its paragraphs where it is over two chunks long."""
    parts = F.filter(F.transform(F.split(sentence, "\n\n"), strip), lambda p: F.length(p) > 0)
    return F.when((F.length(sentence) > 2 * chunk) & F.contains(sentence, F.lit("\n\n")), parts).otherwise(F.array(sentence))


def split_sentences(text: Column, chunk: int = CHUNK) -> Column:
    """The sentences of a text, stripped, without empty ones; long ones are split at empty lines."""
    parts = F.filter(F.transform(sentence_parts(text), strip), lambda s: F.length(s) > 0)
    return F.flatten(F.transform(parts, lambda s: paragraphs(s, chunk)))


#: Sentences that the inner fold of group_sentences takes.
BLOCK = 256


def group_sentences(sentences: Column, chunk: int = CHUNK) -> Column:
    """Sentences joined by blanks while their lengths, blanks between not counted at the seam, stay within chunk.

    Sentences are evaluated once and read by their numbers.  The fold gathers the numbers of those that begin a group, block by
    block, since an array that grows by one is copied; then each group's texts are joined, so the time is linear."""
    return let(sentences, lambda s: F.when(F.size(s) == 0, F.array().cast("array<string>")).otherwise(let(_firsts(s, chunk), lambda f: _joined(s, f))))


def _firsts(sentences: Column, chunk: int) -> Column:
    """The numbers of the sentences that begin a group."""
    nothing = "cast(array() as array<int>)"

    def step(a: Column, k: Column) -> Column:
        def added(n: Column) -> Column:
            opens = (a["size"] == 0) | (a["size"] + n > chunk)
            return F.struct(
                F.when(opens, n).otherwise(a["size"] + 1 + n).alias("size"),
                F.when(opens, F.concat(a["firsts"], F.array(k))).otherwise(a["firsts"]).alias("firsts"),
            )

        return let(F.length(F.get(sentences, k)), added)

    def block(a: Column, b: Column) -> Column:
        numbers = F.sequence(b * BLOCK, F.least(F.size(sentences), (b + 1) * BLOCK) - 1)
        start = F.struct(a["size"].alias("size"), F.expr(nothing).alias("firsts"))
        return let(F.aggregate(numbers, start, step), lambda x: F.struct(x["size"].alias("size"), F.concat(a["parts"], F.array(x["firsts"])).alias("parts")))

    blocks = F.sequence(F.lit(0), F.floor((F.size(sentences) - 1) / BLOCK).cast("int"))
    return F.aggregate(blocks, F.expr("named_struct('size', 0, 'parts', cast(array() as array<array<int>>))"), block, lambda a: F.flatten(a["parts"]))


def _joined(sentences: Column, firsts: Column) -> Column:
    """The texts of groups that begin at these sentences, without empty ones."""
    last = lambda i: F.coalesce(F.get(firsts, i + 1), F.size(sentences)) - 1
    texts = F.transform(firsts, lambda a, i: strip(F.array_join(F.transform(F.sequence(a, last(i)), lambda k: F.get(sentences, k)), " ")))
    return F.filter(texts, lambda x: F.length(x) > 0)
