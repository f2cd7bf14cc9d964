"""Hard-negative mining by distributed radix selection (operator 12).

Scores are integer inner products; higher ones come first, ties go by id.  A window is a range of scores of one anchor, over the
rows of its own label (for its positives) or of other labels (for the negatives of one positive), and what is wanted are its
first k rows.  No scores are stored or sorted.  Each round counts the open windows' rows in 2 ** BITS buckets of equal width,
adds up the counts, finds the bucket that holds the kth row and goes on inside it, digit by digit: first of the scores, then,
among rows of one score, of the ids, so equal vectors in any number end in k rows.  A window is closed once no more than
``GATHERED`` rows are before or in its bucket; at the end only these rows are gathered and ranked.

Rows lie in binary blocks in the shared folder, anchors in blocks of about ANCHORS with their windows; a round multiplies each pair
of blocks, in tiles.  Anchor blocks of a checked size are broadcast; beyond, both sides are dealt over a grid of pairs.  No
row depends on its label's or its vector's frequency for the task it goes to.

Defined cases: rows without id, label or vector, or with a component that is null or not finite, take no part; of rows with
equal ids the one with the smallest label, then vector, does; shorter vectors end in zeros; an anchor without rows in its
window gives no rows; extra columns are ignored; an empty table gives an empty one; scores that may exceed 62 bits are refused.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textgraph.llm.common import dropped, is_small, map_arrow, stored

#: Bits of a digit; rows up to which a window is gathered without another round; anchors of a block; scores of a tile.
BITS, GATHERED, ANCHORS, TILE = 8, 32, 512, 1 << 21
#: Blocks of rows of a group, where pairs of blocks are dealt over a grid.
GROUP = 16
_ROWS = "n int, dim int, peak long, norm double, ids binary, labels binary, vectors binary"
_FIELDS = ("lo", "hi", "first_id", "last_id", "shift", "top", "j")
_PACKED = "block long, dim int, ids binary, labels binary, vectors binary, counts binary, " + ", ".join(f"{f} binary" for f in _FIELDS)


def whole_numbers(vector: Column) -> Column:
    """Components times 256, rounded down."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256))


def participants(table: DataFrame, id_col: str, label: Column, vector_col: str) -> DataFrame:
    """(id, label, vector) of the rows that take part, ids unique."""
    finite = F.forall(F.col(vector_col), lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = table.where(finite).select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), whole_numbers(F.col(vector_col)).alias("vector"))
    rows = rows.where("id is not null and label is not null and vector is not null")
    if rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() == 0:
        return rows
    return rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("r")).select("id", "r.*")


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """One row a vector, filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), max([0, *sizes.tolist()])), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = vectors.flatten().to_numpy()
    return out


def row_blocks(rows: DataFrame) -> DataFrame:
    """Rows in blocks of a batch; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, labels = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                matrix = _matrix(batch.column(2))
                peak, norm = int(np.abs(matrix).max(initial=0)), float(np.sqrt((matrix.astype(np.float64) ** 2).sum(1)).max())
                values = [len(ids), matrix.shape[1], peak, norm, ids.tobytes(), labels.tobytes(), matrix.tobytes()]
                yield pa.RecordBatch.from_pylist([dict(zip(("n", "dim", "peak", "norm", "ids", "labels", "vectors"), values))], _schema(_ROWS))

    return map_arrow(rows.select("id", "label", "vector"), run, _ROWS)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def anchor_blocks(anchors: DataFrame, windows: DataFrame) -> DataFrame:
    """Anchors (anchor, label, vector, block) that have windows, with these, packed."""
    each = windows.groupBy("anchor").agg(F.collect_list(F.struct(*_FIELDS)).alias("w")).join(anchors, "anchor").select("block", "anchor", "label", "vector", "w")

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        matrix, w = _matrix(table.column("vector").chunk(0)), table.column("w").chunk(0)
        flat = w.flatten()
        values = [table.column("block")[0].as_py(), matrix.shape[1], table.column("anchor").to_numpy().tobytes(), table.column("label").to_numpy().tobytes(), matrix.tobytes()]
        values += [np.diff(w.offsets.to_numpy()).astype(np.int64).tobytes(), *(flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64).tobytes() for k in range(len(_FIELDS)))]
        schema = _schema(_PACKED)
        return pa.Table.from_pylist([dict(zip(schema.names, values))], schema)

    return each.groupBy("block").applyInArrow(pack, _PACKED)


def pairs(blocks: DataFrame, packed: DataFrame) -> DataFrame:
    """Each block of rows with each block of anchors; the stated query set against all rows."""
    own = packed.select(*[F.col(c).alias(f"a_{c}") for c in packed.columns])
    if is_small(packed):
        return blocks.crossJoin(F.broadcast(own))
    groups = -(-blocks.count() // GROUP)
    wide = own.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    dealt = blocks.withColumn("cell", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int"))
    dealt = dealt.join(F.broadcast(packed.agg(F.collect_set("block").alias("all"))))  # a row of numbers, one for each ANCHORS anchors
    return dealt.withColumn("a_block", F.explode("all")).drop("all").join(wide, ["cell", "a_block"])


class Pair:
    """A block of rows and a block of anchors with their windows, which stand in the order of the anchors."""

    def __init__(self, r: dict):
        num = lambda name, kind=np.int64: np.frombuffer(r[name], kind)
        self.ids, self.labels = num("ids"), num("labels")
        self.anchors, self.own = num("a_ids"), num("a_labels")
        self.rows, self.vectors = num("vectors").reshape(len(self.ids), -1), num("a_vectors").reshape(len(self.anchors), -1)
        self.counts = num("a_counts")
        self.first = np.cumsum(self.counts) - self.counts
        self.window = {f: num(f"a_{f}") for f in _FIELDS}
        self.anchor_of = np.repeat(np.arange(len(self.anchors)), self.counts)

    def scored(self, same: bool, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, window, score), tile by tile, of rows of the wanted labels with a score in the range of a window."""
        dim = min(self.rows.shape[1], self.vectors.shape[1])
        rows, vectors = self.rows[:, :dim], self.vectors[:, :dim]
        if dim * int(np.abs(rows).max(initial=0)) * int(np.abs(vectors).max(initial=0)) < 1 << 53:
            rows, vectors = rows.astype(np.float64), vectors.astype(np.float64)  # exact, and much faster
        least, most = np.minimum.reduceat(low, self.first), np.maximum.reduceat(high, self.first)
        step = max(1, TILE // len(self.anchors))
        for at in range(0, len(self.ids), step):
            scores = rows[at : at + step] @ vectors.T
            fits = (scores >= least) & (scores <= most) & ((self.labels[at : at + step, None] == self.own) == same)
            row, anchor = np.nonzero(fits & (self.ids[at : at + step, None] != self.anchors))
            score = scores[row, anchor].astype(np.int64)
            for k in range(int(self.counts.max())):
                has = self.counts[anchor] > k
                window = self.first[anchor[has]] + k
                inside = (score[has] >= low[window]) & (score[has] <= high[window])
                yield at + row[has][inside], window[inside], score[has][inside]


def _each_pair(blocks: DataFrame, packed: DataFrame, f: Callable[[Pair], Iterator[list[np.ndarray]]], schema: str) -> DataFrame:
    met = pairs(blocks, packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                for columns in f(Pair({name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names)})):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_schema(schema))

    return map_arrow(met, run, schema)


def histograms(blocks: DataFrame, packed: DataFrame, same: bool) -> DataFrame:
    """(anchor, j, bucket, n): the open windows' rows by bucket, added up."""
    bits = BITS

    def count(p: Pair) -> Iterator[list[np.ndarray]]:
        w, found = p.window, np.zeros(len(p.anchor_of) << bits, np.int64)
        for row, window, score in p.scored(same, w["lo"], w["hi"]):
            by_id = w["lo"][window] == w["hi"][window]
            inside = ~by_id | ((p.ids[row] >= w["first_id"][window]) & (p.ids[row] <= w["last_id"][window]))
            row, window, score, by_id = row[inside], window[inside], score[inside], by_id[inside]
            bucket = np.where(by_id, p.ids[row] - w["first_id"][window], w["hi"][window] - score) >> w["shift"][window]
            found += np.bincount((window << bits) + bucket, minlength=len(found))
        at = np.flatnonzero(found)
        window = at >> bits
        yield [p.anchors[p.anchor_of[window]], w["j"][window], at & ((1 << bits) - 1), found[at]]

    each = _each_pair(blocks, packed, count, "anchor long, j long, bucket long, n long")
    return each.groupBy("anchor", "j", "bucket").agg(F.sum("n").alias("n"))


def gathered(blocks: DataFrame, packed: DataFrame, same: bool) -> DataFrame:
    """(anchor, j, id, score) of the rows up to each window's limit."""

    def take(p: Pair) -> Iterator[list[np.ndarray]]:
        w = p.window
        for row, window, score in p.scored(same, w["lo"], w["top"]):
            keep = (score > w["lo"][window]) | (p.ids[row] <= w["last_id"][window])
            row, window = row[keep], window[keep]
            yield [p.anchors[p.anchor_of[window]], w["j"][window], p.ids[row], score[keep]]

    return _each_pair(blocks, packed, take, "anchor long, j long, id long, score long")


def _opened(state: DataFrame) -> DataFrame:
    """With the width of the next digit."""
    span = F.when(F.col("lo") < F.col("hi"), F.col("hi") - F.col("lo")).otherwise(F.col("last_id") - F.col("first_id"))
    return state.withColumn("shift", F.greatest(F.lit(0), F.length(F.bin(span)) - BITS).cast("long"))


def narrowed(state: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    """Open windows after a round: each goes on in the bucket that holds its kth row."""
    along = counts.withColumn("through", F.sum("n").over(Window.partitionBy("anchor", "j").orderBy("bucket")))
    reached = along.join(state.select("anchor", "j", "need"), ["anchor", "j"]).where("through >= need")
    hit = reached.groupBy("anchor", "j").agg(F.min(F.struct("bucket", "n", "through")).alias("hit"))
    width, by_score = F.expr("shiftleft(1L, cast(shift as int))"), F.col("lo") < F.col("hi")
    hi, first = F.col("hi") - F.col("hit.bucket") * width, F.col("first_id") + F.col("hit.bucket") * width
    found = state.where("open").join(hit, ["anchor", "j"], "left")
    fewer = F.col("hit").isNull()  # all that is left of the window is wanted
    found = found.select(
        "anchor", "j", "top",
        F.when(fewer | ~by_score, F.col("lo")).otherwise(F.greatest(F.col("lo"), hi - width + 1)).alias("lo"),
        F.when(fewer | ~by_score, F.col("hi")).otherwise(hi).alias("hi"),
        F.when(fewer | by_score, F.col("first_id")).otherwise(first).alias("first_id"),
        F.when(fewer | by_score, F.col("last_id")).otherwise(F.least(F.col("last_id"), first + width - 1)).alias("last_id"),
        F.coalesce(F.col("need") - (F.col("hit.through") - F.col("hit.n")), "need").alias("need"),
        (~fewer & (F.lit(k) - F.col("need") + F.col("hit.through") > GATHERED)).alias("open"),
    )
    return found.withColumn("open", F.col("open") & ((F.col("lo") < F.col("hi")) | (F.col("first_id") < F.col("last_id"))))


def first_rows(blocks: DataFrame, anchors: DataFrame, windows: DataFrame, ids: tuple[int, int], k: int, same: bool) -> DataFrame:
    """(anchor, j, rank, id, score): the first k rows of windows (anchor, j, lo, hi)."""
    state = windows.select("anchor", "j", F.col("hi").alias("top"), "lo", "hi", F.lit(ids[0]).cast("long").alias("first_id"), F.lit(ids[1]).cast("long").alias("last_id"), F.lit(k).cast("long").alias("need"), F.lit(True).alias("open"))
    state = stored(_opened(state), "windows")
    while state.where("open").limit(1).count():
        packed = stored(anchor_blocks(anchors, state.where("open")), "anchors")
        after = narrowed(state.where("open"), histograms(blocks, packed, same), k)
        after = stored(_opened(after.unionByName(state.where("not open").drop("shift"))), "windows")
        dropped(packed, state)
        state = after
    packed = stored(anchor_blocks(anchors, state), "anchors")
    found = gathered(blocks, packed, same).groupBy("anchor", "j").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "id"))), 1, k).alias("r"))
    found = found.select("anchor", "j", F.posexplode("r").alias("rank", "r"))
    return found.select("anchor", "j", (F.col("rank") + 1).alias("rank"), "r.id", (-F.col("r.down")).alias("score"))


def _share(score: Column, percent: int) -> Column:
    """percent of a score, rounded up."""
    x = score * percent + 99
    return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100))


def mine(table: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None, positives: int = 5, negatives: int = 5, low: int = 80) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its first
    positives, the first rows of other labels that score from ``low`` percent of the positive's score up to it.  is_anchor is
    over the column id."""
    rows = participants(table, id_col, F.col("label") if label is None else label, vector_col)
    blocks = stored(row_blocks(rows), "rows")
    peak, dim, norm = blocks.agg(F.coalesce(F.max("peak"), F.lit(0)), F.coalesce(F.max("dim"), F.lit(0)), F.coalesce(F.max("norm"), F.lit(0.0))).first()
    if peak * peak * dim >= 1 << 62:
        raise ValueError("scores may exceed 62 bits")
    size = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    own = rows.where(is_anchor).select(F.col("id").alias("anchor"), "label", "vector", F.ceil(size * norm * (1 + 1e-9) + 1).alias("bound"))
    own = stored(own, "queries")
    anchors = own.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-own.count() // ANCHORS)))))
    ids = rows.agg(F.coalesce(F.min("id"), F.lit(0)), F.coalesce(F.max("id"), F.lit(0))).first()
    every = own.select("anchor", F.lit(0).cast("long").alias("j"), (-F.col("bound")).alias("lo"), F.col("bound").alias("hi"))
    best = first_rows(blocks, anchors, every, tuple(ids), positives, True)
    best = stored(best.select("anchor", F.col("rank").cast("long").alias("j"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    windows = best.select("anchor", "j", _share(F.col("positive_score"), low).alias("lo"), F.col("positive_score").alias("hi")).where("lo <= hi")
    hard = first_rows(blocks, anchors, windows, tuple(ids), negatives, False)
    return hard.join(best, ["anchor", "j"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
