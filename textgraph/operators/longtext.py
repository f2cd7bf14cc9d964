"""Texts too long for a row: sentences and their groups over a text that lies in pieces.

A text is rows (text_id, k, text), k from 0 without gaps; joined by a separator of white space, they are the text.  Each piece
but the first begins with something else than white space.  All work is dealt by pieces and by blocks of sentences; no task ever
holds a text.  Greedy grouping is a fold, so the size of the open group at the end of a block depends on that at its beginning:
each block gives this dependence as a table over all sizes, tables of neighbouring blocks are composed, twice as many each
round, and so every block learns where its groups begin.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textgraph.functions.sentences import CHUNK, paragraphs, sentence_parts
from textgraph.functions.text import SPACES, strip

#: Pieces, and sentences, of a block.
BLOCK = 4096
#: Characters up to which a sentence that lies in several pieces is put together; a longer one stays in them.
LONG = 4 << 20
Keep = Callable[[DataFrame, str], DataFrame]


def offsets(df: DataFrame, order: list[str], block: str, **sums: str) -> DataFrame:
    """Running sums of columns before each row of a text, in two levels: within blocks, and over the sums of blocks."""
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sum_of = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    totals = df.groupBy("text_id", block).agg(*[F.sum(v).alias(f"_{v}") for v in sums.values()])
    over = earlier(Window.partitionBy("text_id").orderBy(block))  # a row for each BLOCK rows
    totals = totals.select("text_id", block, *[sum_of(f"_{v}", over).alias(f"_{name}") for name, v in sums.items()])
    inside = earlier(Window.partitionBy("text_id", block).orderBy(*order))
    own = df.withColumns({name: sum_of(v, inside) for name, v in sums.items()}).join(totals, ["text_id", block])
    return own.withColumns({name: F.col(name) + F.col(f"_{name}") for name in sums}).drop(*[f"_{name}" for name in sums])


def sentences(pieces: DataFrame, separator: str, keep: Keep, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame | None]:
    """(text_id, block, place, sentence, n): the sentences that the whole text would be split into, n their length.  One of more
    than LONG characters is null there; (text_id, s, p, k, last, text) are its pieces, None where no sentence is so long."""
    # what a sentence end needs to know of the next piece: its first two characters, without ends of their own
    ahead = pieces.select("text_id", (F.col("k") - 1).alias("k"), F.translate(F.substring("text", 1, 2), ".!?", "xxx").alias("ahead"))
    met = pieces.join(ahead, ["text_id", "k"], "left")
    whole = F.when(F.col("ahead").isNull(), F.col("text")).otherwise(F.concat("text", F.lit(separator), "ahead"))
    cut = met.select("text_id", "k", F.coalesce(F.length("ahead"), F.lit(0)).alias("extra"), sentence_parts(whole).alias("parts"))
    cut = keep(cut.withColumns({"ends": F.size("parts") - 1, "part": F.floor(F.col("k") / BLOCK)}), "parts")
    numbered = offsets(cut.select("text_id", "k", "ends", "part"), ["k"], "part", first="ends").select("text_id", "k", "first")
    each = cut.join(numbered, ["text_id", "k"]).select("text_id", "k", "first", "ends", "extra", F.posexplode("parts").alias("j", "part"))
    part = F.when(F.col("j") == F.col("ends"), F.expr("left(part, length(part) - extra)")).otherwise(F.col("part"))
    each = each.select("text_id", (F.col("first") + F.col("j")).alias("s"), "k", part.alias("part"), ((F.col("j") > 0) & (F.col("j") < F.col("ends"))).alias("inner"))
    # only a piece's first and last part can belong to a sentence that others have parts of
    seams, most = each.where("not inner").drop("inner"), max(LONG, 2 * chunk)
    long = keep(_longer(seams, ["text_id", "s"], most), "long_seams")
    some = long.limit(1).count()
    short = _put_together(seams.join(F.broadcast(long), ["text_id", "s"], "left_anti") if some else seams, ["text_id", "s"])
    found = each.where("inner").select("text_id", "s", "part").unionByName(short).withColumn("part", strip(F.col("part"))).where(F.length("part") > 0)
    found = found.select("text_id", "s", F.posexplode(paragraphs(F.col("part"), chunk)).alias("p", "sentence"))
    apart = None
    if some:
        own = keep(_of_paragraphs(keep(seams.join(F.broadcast(long), ["text_id", "s"], "left_semi"), "long_parts")), "long_paragraphs")
        over = keep(_longer(own, ["text_id", "s", "p"], most), "over")
        short = _put_together(own.join(F.broadcast(over), ["text_id", "s", "p"], "left_anti"), ["text_id", "s", "p"])
        found = found.unionByName(short.select("text_id", "s", "p", strip(F.col("part")).alias("sentence")).where(F.length("sentence") > 0))
        found = found.unionByName(over.withColumn("sentence", F.lit(None).cast("string")))
        apart = _trimmed(own.join(F.broadcast(over), ["text_id", "s", "p"], "left_semi"), separator)
    return found.select("text_id", F.floor(F.col("s") / BLOCK).alias("block"), F.struct("s", "p").alias("place"), "sentence", F.coalesce(F.length("sentence"), F.lit(most + 1)).alias("n")), apart


def _longer(parts: DataFrame, by: list[str], most: int) -> DataFrame:
    """What has more characters than these, without white space at the ends of its parts: few rows, since each is long."""
    return parts.groupBy(*by).agg(F.sum(F.length(strip(F.col("part"))).cast("long")).alias("size")).where(F.col("size") > most).select(*by)


def _of_paragraphs(parts: DataFrame) -> DataFrame:
    """(text_id, s, p, k, part): parts (text_id, s, k, part) of long sentences, cut at empty lines; p rises with the paragraphs of a text.
    A run of line feeds lies in one part, as the next begins with something else."""
    cut = parts.select("text_id", "s", "k", F.split("part", "\n\n").alias("own")).withColumns({"cuts": F.size("own") - 1, "part": F.floor(F.col("k") / BLOCK)})
    before = offsets(cut.drop("own"), ["k", "s"], "part", before="cuts").select("text_id", "s", "k", "before")
    each = cut.join(before, ["text_id", "s", "k"]).select("text_id", "s", "k", "before", F.posexplode("own").alias("i", "part"))
    return each.select("text_id", "s", (F.col("before") + F.col("i")).cast("int").alias("p"), "k", "part")


def _trimmed(parts: DataFrame, separator: str) -> DataFrame:
    """(text_id, s, p, k, last, text): parts of sentences without the white space around a sentence, and without the separator that
    ends all but the last."""
    by = ["text_id", "s", "p"]
    ends = parts.where(F.length(strip(F.col("part"))) > 0).groupBy(*by).agg(F.min("k").alias("first"), F.max("k").alias("last"))
    inside = parts.join(F.broadcast(ends), by).where("k between first and last")
    text = F.when(F.col("k") == F.col("first"), F.ltrim("part", F.lit(SPACES))).otherwise(F.col("part"))
    text = F.when(F.col("k") == F.col("last"), F.rtrim(text, F.lit(SPACES))).otherwise(F.left(text, F.length(text) - len(separator)))
    return inside.select(*by, "k", "last", text.alias("text"))


def _put_together(parts: DataFrame, by: list[str]) -> DataFrame:
    """Parts (k, part) joined in order."""
    found = parts.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("k", "part"))).alias("parts"))
    return found.select(*by, F.array_join(F.transform("parts", lambda x: x["part"]), "").alias("part"))


class Block:
    """The greedy rule on one block's lengths.  The state is the size of the open group, 0 where there is none yet; sizes from
    chunk on are the same, since any sentence then begins a group."""

    def __init__(self, lengths: np.ndarray, chunk: int):
        self.chunk, self.size = chunk, len(lengths)
        self.sums = np.concatenate([[0], np.cumsum(lengths + 1)])
        behind = np.searchsorted(self.sums, self.sums[:-1] + chunk + 2, "right") - 1
        self.next = np.maximum(behind, np.arange(self.size) + 1)  # where the group after the one that begins here begins

    def first(self, state: np.ndarray) -> np.ndarray:
        """Where the first group begins, from each state; the block's size if none does."""
        at = np.minimum(np.searchsorted(self.sums, self.chunk + 1 - state, "right") - 1, self.size)
        return np.where(state == 0, 0, at)

    def after(self) -> np.ndarray:
        """The state at the block's end, for each state at its beginning."""
        state = np.arange(self.chunk + 1)
        last = np.arange(self.size + 1)  # the last group that begins, of those from one that begins here
        for k in range(self.size - 1, -1, -1):
            if self.next[k] < self.size:
                last[k] = last[self.next[k]]
        at = self.first(state)
        open_ = np.where(at < self.size, self.sums[-1] - self.sums[last[at]] - 1, state + self.sums[-1])
        return np.minimum(open_, self.chunk)

    def begins(self, state: int) -> np.ndarray:
        """Whether a group begins at each sentence."""
        out, k = np.zeros(self.size, bool), int(self.first(np.array([state]))[0])
        while k < self.size:
            out[k], k = True, int(self.next[k])
        return out


def _entered(found: DataFrame, keep: Keep, chunk: int) -> DataFrame:
    """(text_id, block, state) at the beginning of each block."""

    def tabled(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("s", "ascending"), ("p", "ascending")])
        after = Block(table.column("n").to_numpy(), chunk).after()
        return pa.table({"text_id": [key[0].as_py()], "block": [key[1].as_py()], "after": pa.array([after.tolist()], pa.list_(pa.int32()))}, schema)

    schema = pa.schema([("text_id", pa.string()), ("block", pa.int64()), ("after", pa.list_(pa.int32()))])
    blocks = found.select("text_id", "block", "place.s", "place.p", "n").groupBy("text_id", "block").applyInArrow(tabled, "text_id string, block long, after array<int>")
    # blocks are numbered anew: a sentence that others swallowed may leave a block empty
    blocks = keep(blocks.withColumn("b", F.row_number().over(Window.partitionBy("text_id").orderBy("block")) - 1), "tables0")
    most, step, k = blocks.agg(F.max("b")).first()[0] or 0, 1, 0
    while step <= most:
        before = blocks.select("text_id", (F.col("b") + step).alias("b"), F.col("after").alias("before"))
        met = blocks.join(before, ["text_id", "b"], "left")
        composed = F.when(F.col("before").isNull(), F.col("after")).otherwise(F.transform("before", lambda x: F.get(F.col("after"), x)))
        blocks, step, k = keep(met.select("text_id", "block", "b", composed.alias("after")), f"tables{k + 1}"), 2 * step, k + 1
    ends = blocks.select("text_id", (F.col("b") + 1).alias("b"), F.get("after", F.lit(0)).alias("state"))
    return blocks.select("text_id", "block", "b").join(ends, ["text_id", "b"], "left").select("text_id", "block", F.coalesce("state", F.lit(0)).alias("state"))


def groups(pieces: DataFrame, separator: str, keep: Keep, chunk: int = CHUNK) -> DataFrame:
    """(text_id, pos, text): the groups of the whole text's sentences, from 0."""
    found, apart = groups_apart(pieces, separator, keep, chunk)
    if apart is None:
        return found
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), separator)
    return found.where("text is not null").unionByName(apart.groupBy("text_id", "pos").agg(whole.alias("text")))


def groups_apart(pieces: DataFrame, separator: str, keep: Keep, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame | None]:
    """groups(), where the text of a group of more than LONG characters is null, and (text_id, pos, k, last, text), the pieces of
    such groups, joined by the separator; None where there are none.  Such a group is one sentence."""
    found, apart = sentences(pieces, separator, keep, chunk)
    found = keep(found, "sentences")
    rows = found.join(_entered(found, keep, chunk), ["text_id", "block"]).select("text_id", "block", "place.s", "place.p", "sentence", "n", "state")

    def begun(table: pa.Table) -> pa.Table:
        table = table.sort_by([("s", "ascending"), ("p", "ascending")])
        begins = Block(table.column("n").to_numpy(), chunk).begins(table.column("state")[0].as_py())
        return table.drop_columns(["n", "state"]).append_column("begins", pa.array(begins.astype(np.int64)))

    marked = rows.groupBy("text_id", "block").applyInArrow(begun, "text_id string, block long, s long, p int, sentence string, begins long")
    marked = offsets(keep(marked, "begins"), ["s", "p"], "block", earlier="begins")
    marked = marked.withColumn("pos", F.col("earlier") + F.col("begins") - 1)
    texts = marked.groupBy("text_id", "pos").agg(F.array_sort(F.collect_list(F.struct("s", "p", "sentence"))).alias("g"))
    text = strip(F.array_join(F.transform("g", lambda x: x["sentence"]), " "))
    if apart is None:
        return texts.select("text_id", "pos", text.alias("text")), None
    over = marked.where("sentence is null").select("text_id", "s", "p", "pos")
    apart = keep(apart.join(F.broadcast(over), ["text_id", "s", "p"]).select("text_id", "pos", "k", "last", "text"), "apart")
    return texts.select("text_id", "pos", F.when(F.get("g", F.lit(0))["sentence"].isNotNull(), text).alias("text")), apart


def leading(apart: DataFrame, separator: str, keep: Keep, most: Callable[[int], int]) -> DataFrame:
    """(text_id, pos, i, text): of texts in pieces (text_id, pos, k, text) the first most(size) characters, without white space at the
    end, in pieces from 0."""
    length = F.length("text").cast("long") + len(separator)
    rows = apart.select("text_id", "pos", "k", "text", length.alias("n"), F.floor(F.col("k") / BLOCK).alias("block"))
    at = keep(offsets(rows.select("text_id", "pos", "k", "n", "block"), ["k", "pos"], "block", at="n").drop("block"), "apart_at")
    own = at.groupBy("text_id", "pos").agg(F.min("at").alias("base"), F.min("k").alias("first"), F.max(F.col("at") + F.col("n")).alias("end"))
    limits = [(r.text_id, r.pos, r.base, r.first, most(r.end - r.base - len(separator))) for r in own.collect()]  # a row for each LONG characters at most
    limits = apart.sparkSession.createDataFrame(limits, "text_id string, pos long, base long, first long, most long")
    left = F.col("most") - (F.col("at") - F.col("base"))
    kept_ = apart.join(at, ["text_id", "pos", "k"]).join(F.broadcast(limits), ["text_id", "pos"]).withColumn("left", left).where("left > 0")
    text = F.when(F.col("n") >= F.col("left"), F.rtrim(F.left("text", F.col("left").cast("int")), F.lit(SPACES))).otherwise(F.col("text"))
    return kept_.select("text_id", "pos", (F.col("k") - F.col("first")).alias("i"), text.alias("text"))


def in_order(found: DataFrame, apart: DataFrame) -> DataFrame:
    """(text_id, k, text): texts (text_id, pos, text) and such in pieces (text_id, pos, i, text) as the pieces of one text, numbered anew."""
    counts = found.select("text_id", "pos", F.lit(1).cast("long").alias("n")).union(apart.groupBy("text_id", "pos").agg(F.count("*").alias("n")))
    before = offsets(counts.withColumn("block", F.floor(F.col("pos") / BLOCK)), ["pos"], "block", before="n").select("text_id", "pos", "before")
    few = F.broadcast(before.join(F.broadcast(apart.select("text_id", "pos").distinct()), ["text_id", "pos"], "left_semi"))
    short = found.join(before, ["text_id", "pos"]).select("text_id", F.col("before").alias("k"), "text")
    return short.union(apart.join(few, ["text_id", "pos"]).select("text_id", (F.col("before") + F.col("i")).alias("k"), "text"))


def sizes(pieces: DataFrame, separator: str) -> DataFrame:
    """(text_id, size): the lengths of whole texts."""
    return pieces.groupBy("text_id").agg((F.sum(F.length("text")) + (F.count("*") - 1) * len(separator)).alias("size"))


def joined(pieces: DataFrame, separator: str) -> DataFrame:
    """(text_id, text) of texts that are short by now."""
    parts = F.array_sort(F.collect_list(F.struct("k", "text")))
    return pieces.groupBy("text_id").agg(F.array_join(F.transform(parts, lambda x: x["text"]), separator).alias("text"))
