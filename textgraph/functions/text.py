"""Column functions on single texts; all but two are built-in expressions."""

from __future__ import annotations

import bisect
import unicodedata
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.functions.vocabulary import SUFFIXES, TITLES

#: White space as Unicode text processing has it, for places where an engine's own \s is ASCII.
WS = "[\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def each(df: DataFrame, values: Column, *keep: str, place: str = "k", value: str = "c") -> DataFrame:
    """One row for each element.  Spark infers a filter size(values) > 0 for a plain explode and would compute costly
    values twice; the outer form has no such filter."""
    return df.select(*keep, F.posexplode_outer(values).alias(place, value)).where(F.col(place).isNotNull())


#: The characters of WS.
SPACES = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(text: Column) -> Column:
    """Without white space at both ends; a trim looks at the ends alone, where a pattern would be tried at every character."""
    return F.btrim(text, F.lit(SPACES))


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{WS}+"), "")


def whole_word(text: Column, words: tuple[str, ...]) -> Column:
    return text.rlike(rf"(?<![\p{{L}}\p{{N}}_])(?:{'|'.join(words)})(?![\p{{L}}\p{{N}}_])")


def _nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def nfkc(text: Column) -> Column:
    """ASCII and the letters of Latin-1 are their own NFKC form, so only other texts go to Python; there is no built-in."""
    plain = ~text.rlike(r"[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]")
    return F.when(plain, text).otherwise(F.pandas_udf(_nfkc, "string")(F.when(~plain, text)))


def normalize_text(text: Column) -> Column:
    """Quotes and line feeds unescaped, NFKC, dashes, single spaces, trimmed, lower case."""
    t = F.replace(F.replace(text, F.lit('\\"'), F.lit('"')), F.lit("\\'"), F.lit("'"))
    t = F.replace(t, F.lit("\\n"), F.lit("\n"))
    t = nfkc(t)
    t = F.replace(F.replace(F.replace(t, F.lit("—"), F.lit("--")), F.lit("–"), F.lit("-")), F.lit("…"), F.lit("..."))
    return F.lower(strip(F.regexp_replace(t, f"{WS}+", " ")))


class Suffixes:
    """The sorted suffixes of a text, by doubling ranks; built once, it serves any number of searches."""

    def __init__(self, text: str):
        self.text, n = text, len(text)
        rank = np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True)[1].astype(np.int64)
        width = 1
        while True:
            key = rank * (n + 1)
            key[: max(0, n - width)] += rank[width:] + 1
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])]) if n else key
            rank = np.empty(n, np.int64)
            rank[order] = new
            width *= 2
            if not n or new[-1] == n - 1 or width >= n:
                break
        self.order = order.tolist()

    def __contains__(self, part: str) -> bool:
        size = len(part)
        at = bisect.bisect_left(self.order, part, key=lambda p: self.text[p : p + size])
        return at < len(self.order) and self.text.startswith(part, self.order[at])


def longest_common(a: str, b: str, least: int) -> int:
    """Length of the longest common substring if it has that many characters, else 0."""
    return longest_part(a, Suffixes(b), least)


#: Plain searches of a source that cost about as much as its index.
SEARCHES = 2000


class Searched:
    """A text that is searched plainly until an index would have cost no more; then it gets one."""

    def __init__(self, text: str):
        self.text, self.index, self.left = text, None, SEARCHES

    def __contains__(self, part: str) -> bool:
        if self.index is None:
            self.left -= 1
            if self.left >= 0:
                return part in self.text
            self.index = Suffixes(self.text)
        return part in self.index


def longest_part(a: str, b: str | Suffixes | Searched, least: int) -> int:
    """The same with b at hand: only parts longer than the best one so far are sought.  A part that is found grows by doubled
    steps; where one is missing and its second half is too, no part with that half is sought, so texts that have little in common
    take about 4 * len(a) / best searches, and any others about 2 * len(a)."""
    best, start = least - 1, 0
    while start + best < len(a):
        if a[start : start + best + 1] in b:
            best, step = best + 1, 1
            while step:  # up by doubled steps, then down again
                if start + best + step <= len(a) and a[start : start + best + step] in b:
                    best, step = best + step, 2 * step
                else:
                    step //= 2
            start += 1
        else:
            half = (best + 1) // 2
            end = start + best + 1
            start = end - half + 1 if half and a[end - half : end] not in b else start + 1
    return best if best >= least else 0


def _partial_confidences(lines: pd.Series, source: pd.Series) -> pd.Series:
    out = []
    for own, text in zip(lines, source):
        own = [] if own is None else list(own)
        index = None if text is None else Searched(text)
        out.append([longest_part(e, index, 20) / len(e) if e and index is not None else 0.0 for e in own])
    return pd.Series(out)


def in_part(line: Column, source: Column) -> Column:
    """A line that its source may hold in part: it isn't contained, and has 20 characters."""
    return F.when(~F.contains(source, line) & (F.length(line) >= 20), line)


def partial_confidences(lines: Column, source: Column) -> Column:
    """For each of an array of lines in_part() the share that its longest common substring with the source makes, if that has 20
    characters.  A source goes to Python once for all of its lines, and not at all where there are none."""
    some = F.exists(lines, lambda e: e.isNotNull())
    return F.pandas_udf(_partial_confidences, "array<double>")(F.when(some, lines), F.when(some, source))


def confidence(evidence: Column, source: Column) -> Column:
    """Of normalised texts: 1 if contained, else the share of evidence that its longest common substring with the source makes."""
    rest = F.get(partial_confidences(F.array(in_part(evidence, source)), source), F.lit(0))
    return F.when(F.contains(source, evidence), 1.0).otherwise(F.coalesce(rest, F.lit(0.0)))


def strip_code_fence(text: Column) -> Column:
    s = F.regexp_replace(strip(text), rf"(?i)^```(?:json)?{WS}*\n?", "")
    return strip(F.regexp_replace(s, rf"\n?```{WS}*$", ""))


def is_list(text: Column) -> Column:
    """Whether a text is JSON and a list."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("ARRAY"), F.lit(False))


def is_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def repair_json(text: Column) -> Column:
    """The text if it parses, else its outermost array if that does, else that with missing and spare commas mended."""
    t = strip(text)
    array = F.regexp_extract(t, r"(?s)\[.*\]", 0)
    chosen = F.when(array != "", array).otherwise(t)
    mended = F.regexp_replace(F.regexp_replace(F.regexp_replace(chosen, rf"\}}{WS}*\{{", "},{"), rf",{WS}*\]", "]"), rf",{WS}*\}}", "}")
    return F.when(is_json(t), t).when((array != "") & is_json(array), array).otherwise(mended)


def normalize_citations(text: Column) -> Column:
    """[46, 47] becomes [46][47]."""
    groups = F.array_distinct(F.regexp_extract_all(text, F.lit(rf"\[\d+(?:{WS}*,{WS}*\d+)+\]"), F.lit(0)))
    return F.aggregate(groups, text, lambda t, g: F.replace(t, g, F.regexp_replace(g, rf"{WS}*,{WS}*", "][")))


def strip_citations(text: Column) -> Column:
    return strip(F.regexp_replace(text, rf"{WS}*\[\d+\]", ""))


def citations(text: Column) -> Column:
    """Sorted distinct section numbers of a normalised answer."""
    found = F.regexp_extract_all(text, F.lit(r"\[(\d+)\]"), F.lit(1))
    return F.array_sort(F.array_distinct(F.filter(F.transform(found, lambda x: x.try_cast("int")), lambda n: n.isNotNull())))


def answer_of(answer: Column, response: Column) -> Column:
    return F.coalesce(F.nullif(answer, F.lit("")), F.nullif(response, F.lit("")), F.lit(""))


def with_number(prompt: Column, number: Column) -> Column:
    """The first 3-5 of a prompt replaced by a type's number of questions."""
    at = F.instr(prompt, "3-5")
    return F.when(at > 0, F.concat(F.substring(prompt, F.lit(1), at - 1), number, F.substring(prompt, at + 3, F.length(prompt)))).otherwise(prompt)


def snippet(text: Column) -> Column:
    return F.replace(F.left(text, F.lit(80)), F.lit("\n"), F.lit(" "))


def strip_titles(name: Column) -> Column:
    """Leading titles and trailing suffixes off, one of each a round, until nothing changes; a round changes at least a word."""
    title, suffix = rf"(?i)^(?:{TITLES})(?:{WS}+|$)", rf"(?i)(?:{WS}*,{WS}*)?{WS}+(?:{SUFFIXES.replace(chr(92) + 's', WS)})$"
    once = lambda s: F.regexp_replace(F.regexp_replace(s, title, ""), suffix, "")
    step = lambda s, _: let(once(s), lambda x: F.when(strip(x) == strip(s), s).otherwise(strip(x)))
    return strip(F.aggregate(F.sequence(F.lit(0), F.size(tokens(name))), name, step))


def low_value_alias(subject: Column, object_: Column) -> Column:
    """The object is the subject without title, or its first or last words, or a title alone."""

    def compared(s: Column, o: Column) -> Column:
        joined, part = F.lower(F.array_join(tokens(s), " ")), F.lower(o)
        return (
            F.when(F.size(tokens(o)) == 0, True)
            .when(F.size(tokens(s)) == 0, False)
            .when(F.lower(s) == part, True)
            .otherwise(F.endswith(joined, F.concat(F.lit(" "), part)) | F.startswith(joined, F.concat(part, F.lit(" "))))
        )

    return let(strip_titles(subject), lambda s: let(strip_titles(object_), lambda o: compared(s, o)))
