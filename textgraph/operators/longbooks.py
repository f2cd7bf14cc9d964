"""Sentence-aligned windows of books too long for a task.

A book is rows (book, k, text), k from 0 without gaps, which joined are the book.  A window's start depends on the one before, so the first
start in a piece depends on the last one before it, but only by its offset, which is below stride + look.  Each piece gives the
offset in the next one as a table over all offsets in itself; tables of neighbouring pieces are composed, twice as many each
round, and then every piece finds its own windows.  A piece sees only as much of the following text as a window may reach.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgraph.functions.chunking import LOOK, STRIDE, WINDOW, aligned_span_of, window_texts
from textgraph.functions.text import SPACES
from textgraph.operators.models import bounded_batches
from textgraph.operators import sections as S

#: Characters of a piece that is read from a file; lines are not cut.
PIECE = 1 << 16
#: Pieces of a block of running sums.
BLOCK = 4096
Keep = Callable[[DataFrame, str], DataFrame]
_ENDS, _QUOTES = ".!?。！？…", "\"'」』"


def read_pieces(spark: SparkSession, folder: str, suffix: str, keep: Keep, size: int | None = None) -> DataFrame:
    """(book, k, text) of a folder's files, each read by ranges: Spark splits them at line feeds, wherever their bytes lie, and a
    task joins the lines of its range to pieces.  Line feeds at the end of a file are not kept."""
    from textgraph.sources.books import file_name

    size = size or PIECE
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", f"*{suffix}").text(folder)
    lines = lines.select(file_name().alias("book"), F.col("_metadata.file_block_start").alias("at"), F.col("value").alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, own, number, n = ["book", "at", "j", "text"], [], None, 0, 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([own[0]]), pa.array([own[1]]), pa.array([number]), pa.array(["\n".join([*held, ""])])], names)

        for batch in batches:
            for book, at, line in zip(*(c.to_pylist() for c in batch.columns)):
                if held and ((book, at) != own or n >= size):
                    yield piece()
                    number, held, n = number + 1 if (book, at) == own else 0, [], 0
                own = book, at
                held.append(line)
                n += len(line) + 1
        if held:
            yield piece()

    found = keep(lines.mapInArrow(run, "book string, at long, j long, text string"), "ranges")
    ranges = found.groupBy("book", "at").agg(F.count("*").alias("n"))  # a row for each range of a file
    before = F.coalesce(F.sum("n").over(Window.partitionBy("book").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return found.join(ranges.select("book", "at", before.alias("before")), ["book", "at"]).select("book", (F.col("before") + F.col("j")).alias("k"), "text")


def _placed(pieces: DataFrame) -> DataFrame:
    """(book, k, begins, size): where each piece begins, and the book's length, white space at its ends apart."""
    space = F.lit(SPACES)
    rows = pieces.select("book", "k", F.floor(F.col("k") / BLOCK).alias("part"), F.length("text").alias("n"), F.length(F.ltrim("text", space)).alias("l"), F.length(F.rtrim("text", space)).alias("r"))
    totals = rows.groupBy("book", "part").agg(F.sum("n").alias("total"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("book", "part", F.coalesce(F.sum("total").over(earlier(Window.partitionBy("book").orderBy("part"))), F.lit(0)).alias("ahead"))
    inside = F.coalesce(F.sum("n").over(earlier(Window.partitionBy("book", "part").orderBy("k"))), F.lit(0))
    rows = rows.withColumn("inside", inside).join(totals, ["book", "part"]).withColumn("begins", F.col("ahead") + F.col("inside"))
    real = F.col("l") > 0
    ends = rows.groupBy("book").agg(F.min(F.when(real, F.col("begins") + F.col("n") - F.col("l"))).alias("lead"), F.max(F.when(real, F.col("begins") + F.col("r"))).alias("until"))
    ends = ends.where("lead is not null")
    return rows.join(ends, "book").select("book", "k", (F.col("begins") - F.col("lead")).alias("begins"), (F.col("until") - F.col("lead")).alias("size"))


def moves(text: str, look: int = LOOK) -> np.ndarray:
    """How far a start at each place of a text is moved: behind the first sentence end and the white space after it, both
    within ``look`` characters, or else behind the first white space, or not at all."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes)
    is_in = lambda chars: np.isin(codes, np.frombuffer(chars.encode("utf-32-le"), np.uint32))
    space, quote, end = np.append(is_in(SPACES), False), np.append(is_in(_QUOTES), False), is_in(_ENDS)
    at = np.flatnonzero(end)
    behind = np.where(quote[at + 1], at + 2, at + 1)
    keep = space[np.minimum(behind, n)]
    at, behind = at[keep], behind[keep]
    other = np.append(np.flatnonzero(~space[:n]), n)
    run = other[np.searchsorted(other, behind)]  # where the white space ends
    far = n + 2 * look
    place = np.arange(n)
    k = np.searchsorted(at, place)
    at, behind, run = (np.append(x, far) for x in (at, behind, run))
    sentence = np.where(behind[k] < place + look, np.minimum(run[k], place + look) - place, 0)
    spaces = np.append(np.flatnonzero(space[:n]), far)
    first = spaces[np.searchsorted(spaces, place)]
    return np.where(sentence > 0, sentence, np.where(first < place + look, first + 1 - place, 0))


def _chain(text: str, own: int, stride: int) -> np.ndarray:
    """For each start in a piece of so many characters, the next one; text goes on behind the piece.  Starts behind the book's
    end don't matter."""
    moved = np.append(moves(text), 0)
    after = np.minimum(np.arange(own) + stride, len(text))
    return np.arange(own) + stride + moved[after]


def aligned(pieces: DataFrame, keep: Keep, window: int = WINDOW, stride: int = STRIDE, texts: bool = True) -> DataFrame:
    """(book, start, end, text): the windows of aligned_windows over the whole, stripped books."""
    states, reach = stride + LOOK, max(window, stride + LOOK) + LOOK
    placed = keep(_placed(pieces), "placed")
    met = pieces.join(placed, ["book", "k"])
    # what follows a piece: one head nearly always, since only a range's last piece may be shorter
    # a book's first piece follows none
    heads = keep(met.select("book", "k", F.when(F.col("k") > 0, F.left("text", F.lit(reach))).otherwise(F.lit("")).alias("head")), "heads")
    last = heads.groupBy("book").agg(F.max("k").alias("last"))
    ahead, step, open_ = heads.join(last, "book").select("book", "k", "last", F.lit("").alias("more")), 1, True
    while open_:
        following = heads.select("book", (F.col("k") - step).alias("k"), F.col("head").alias("next"))
        grown = F.when(F.length("more") < reach, F.concat("more", F.coalesce("next", F.lit("")))).otherwise(F.col("more"))
        ahead = keep(ahead.join(following, ["book", "k"], "left").select("book", "k", "last", grown.alias("more")), f"ahead{step}")
        open_ = ahead.where((F.length("more") < reach) & (F.col("k") + step < F.col("last"))).limit(1).count()
        step += 1
    # positions are counted from the start of the stripped book; a first piece begins before it by its leading white space
    met = keep(met.join(ahead, ["book", "k"]).select("book", "k", "begins", "size", "text", F.left("more", F.lit(reach)).alias("more"), "last"), "met")
    bounded_batches(met.sparkSession)

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            after = []
            for text, more in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                own = len(text)
                chain = _chain(text + more, own, stride)
                at = np.arange(states)
                while (inside := at < own).any():
                    at[inside] = chain[at[inside]]
                after.append((at - own).astype(np.int32))
            ends = pa.array(np.arange(len(after) + 1, dtype=np.int32) * states)
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int32), *after])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["book", "k", "after"])

    # nothing enters behind a book's last piece, so a table is made for the others alone
    found = keep(met.where("k < last").select("book", "k", "text", "more").mapInArrow(tables, "book string, k long, after array<int>"), "tables0")
    most, step, number = placed.agg(F.max("k")).first()[0] or 0, 1, 0
    while step <= most:
        before = found.select("book", (F.col("k") + step).alias("k"), F.col("after").alias("before"))
        composed = F.when(F.col("before").isNull(), F.col("after")).otherwise(F.transform("before", lambda x: F.get(F.col("after"), x)))
        found = keep(found.join(before, ["book", "k"], "left").select("book", "k", composed.alias("after")), f"tables{number + 1}")
        step, number = 2 * step, number + 1
    lead = placed.where("k = 0").select("book", (-F.col("begins")).cast("int").alias("lead"))
    entered = found.join(lead, "book").select("book", (F.col("k") + 1).alias("k"), F.get("after", F.col("lead")).alias("entry"))
    met = met.join(entered, ["book", "k"], "left").withColumn("entry", F.coalesce("entry", (-F.col("begins")).cast("int")))

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {n: k for k, n in enumerate(["book", "k", "begins", "size", "text", "more", "entry"])}
        for batch in batches:
            out = []
            for begins, size, text, more, entry in zip(*(batch.column(place[n]).to_pylist() for n in ("begins", "size", "text", "more", "entry"))):
                chain, at, own = _chain(text + more, len(text), stride), entry, []
                while at < len(text) and begins + at < size:
                    own.append(at)
                    at = int(chain[at])
                out.append(own)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], [*batch.schema.names, "starts"])

    met = met.select("book", "k", "begins", "size", "text", "more", "entry")
    met = met.mapInArrow(starts, T.StructType([*met.schema, T.StructField("starts", T.ArrayType(T.IntegerType()))]))
    whole, left = F.concat("text", "more"), F.least(F.col("size") - F.col("begins"), F.lit((1 << 31) - 1)).cast("int")
    cut = met.where(F.size("starts") > 0).select("book", "begins", whole.alias("whole"), aligned_span_of(whole, left, F.col("starts"), window).alias("spans"))
    each = cut.select("book", "begins", F.explode(window_texts(F.col("whole"), F.col("spans"))).alias("w"))
    rows = each.select("book", (F.col("begins") + F.col("w.start")).alias("start"), (F.col("begins") + F.col("w.end")).alias("end"), F.col("w.text").alias("text"))
    return rows if texts else rows.drop("text")


def tasks(pieces: DataFrame, keep: Keep) -> DataFrame:
    """All windows with their numbers, as sections.tasks has them, of books that lie in pieces."""
    found = keep(aligned(pieces, keep), "windows")
    short = found.select("book", "start")
    order = Window.partitionBy("book").orderBy("start")  # two numbers a window
    numbers = short.select("book", "start", F.row_number().over(order).alias("section_idx"))
    totals = keep(short.groupBy("book").agg(F.count("*").alias("n")), "totals")
    rows = found.join(numbers, ["book", "start"]).join(totals, "book").withColumn("section_total", F.col("n").cast("int")).drop("n")
    return S.numbered(rows.select("book", "section_total", "section_idx", "start", "end", "text"), totals)
