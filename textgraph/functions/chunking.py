"""Overlapping windows of a text as array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textgraph.functions.text import WS, let, strip

WINDOW, STRIDE, LOOK = 4000, 3000, 200
_END = "[.!?。！？…][\"'」』]?"


SPAN = "array<struct<start:int,end:int>>"


def _cut(text: Column, size: Column, start: Column, window: int, pattern: str) -> Column:
    """The window's end: behind the last sentence end of its last LOOK characters, unless it ends the text."""

    def sought(end: Column) -> Column:
        low = F.greatest(start, end - LOOK)
        behind = F.length(F.regexp_extract(F.substring(text, low + 1, end - low), f"(?s)^.*{pattern}", 0))
        return F.when(end < size, let(behind, lambda n: F.when((n > 0) & (low + n > start), low + n).otherwise(end))).otherwise(end)

    return let(F.least(start + window, size), sought)


def _spans(text: Column, size: Column, starts: Column, window: int, pattern: str) -> Column:
    """Windows that hold more than white space, by their limits."""
    spans = F.transform(starts, lambda k: F.struct(k.alias("start"), _cut(text, size, k, window, pattern).alias("end")))
    return F.filter(spans, lambda s: F.rlike(F.substring(text, s["start"] + 1, s["end"] - s["start"]), F.lit(f"[^{WS[1:]}")))


def window_texts(text: Column, spans: Column) -> Column:
    """(start, end, text) of windows, texts without white space at their ends."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), strip(F.substring(text, s["start"] + 1, s["end"] - s["start"])).alias("text")))


def fixed_spans(text: Column, window: int = WINDOW, stride: int = STRIDE) -> Column:
    """Windows that start at multiples of the stride and end behind a sentence end where there is one."""
    found = let(F.length(text), lambda n: _spans(text, n, F.sequence(F.lit(0), n - 1, F.lit(stride)), window, "[.!?]"))
    return F.when(text != "", found).otherwise(F.array().cast(SPAN))


def aligned_spans(text: Column, window: int = WINDOW, stride: int = STRIDE) -> Column:
    """Windows that start behind a sentence end, or a space, within LOOK characters.  The stride counts from the moved
    start, so each start depends on the one before: a fold over the text, which gathers starts alone.  The first window
    that holds text is not moved."""

    def step(size: Column):
        def next_start(s: Column, _: Column) -> Column:
            look = F.substring(text, s["at"] + 1, F.lit(LOOK))

            def moved(look: Column) -> Column:
                sentence = F.length(F.regexp_extract(look, f"(?s)^.*?{_END}{WS}+", 0))
                return let(sentence, lambda n: F.when(n > 0, n).otherwise(F.length(F.regexp_extract(look, f"(?s)^.*?{WS}", 0))))

            by = F.when(s["emitted"], let(look, moved)).otherwise(0)
            grown = let(
                s["at"] + by,
                lambda at: F.struct(
                    (at + stride).alias("at"),
                    (s["emitted"] | F.rlike(F.substring(text, at + 1, F.lit(window)), F.lit(f"[^{WS[1:]}"))).alias("emitted"),
                    F.concat(s["starts"], F.array(at)).alias("starts"),
                ),
            )
            return F.when(s["at"] < size, grown).otherwise(s)

        return next_start

    first = F.expr("named_struct('at', 0, 'emitted', false, 'starts', cast(array() as array<int>))")
    starts = lambda n: F.aggregate(F.sequence(F.lit(0), F.floor(n / stride).cast("int")), first, step(n), lambda s: s["starts"])
    found = let(F.length(text), lambda n: _spans(text, n, starts(n), window, _END))
    return F.when(text != "", found).otherwise(F.array().cast(SPAN))


def aligned_span_of(text: Column, size: Column, starts: Column, window: int = WINDOW) -> Column:
    """The windows of known starts; size is that of the whole text, of which at least a window behind each start is given."""
    return _spans(text, size, starts, window, _END)


def fixed_windows(text: Column, window: int = WINDOW, stride: int = STRIDE) -> Column:
    return window_texts(text, fixed_spans(text, window, stride))


def aligned_windows(text: Column, window: int = WINDOW, stride: int = STRIDE) -> Column:
    return window_texts(text, aligned_spans(text, window, stride))
