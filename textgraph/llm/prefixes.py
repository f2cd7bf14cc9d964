"""Prefix trie of conversations by rolling fingerprints (operator 13).

Each sequence of first turns that some conversation begins with is a node.  Turns are sorted by range, so a conversation of any
length may lie in several tasks; each task numbers its turns and scans them, in numpy, for the fingerprints of all prefixes, a
polynomial modulo 2 ** 64 in the turns' hashes.  What a conversation brings along from earlier tasks (at most two of them
end in a task) is added by that polynomial's rule, and by the same rule the fingerprints of rebuilt conversations follow from those of
their parts without another scan.

Members with equal depth and fingerprint are a group.  Its distinct last turns, with the groups of the prefixes before, are
compared with those of its representative, the smallest member: equal ones at every depth are equal prefixes.  What differs is
a collision; it gets a group of its own, and with it all that follows from it, until every group is of one prefix.  Counts are
pre-aggregated, so a prefix that very many conversations share is a row a task before the shuffle.

Sums over subtrees double their reach each round: a node adds what stands below it at the distance covered so far, so a tree
of depth d takes log2(d) rounds.  The ids of a node's ends are sorted by range and joined in parts by all tasks, and only
those parts are hashed one after the other, as a stream.

Defined cases: null roles and texts are empty; turns go by number, nulls first, then by role and text; rows repeated are turns
repeated; rows without a conv_id take no part; extra columns are ignored; no rows give no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textgraph.llm.common import dropped, map_arrow, mixed, partitions, run_starts, small, stored

#: Turns that a rebuilt conversation may take over, at most; bits of a fingerprint that count.
TAKEN, BITS = 5, 64
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_WRAP = (1 << 64) - 1


def powers(base: int, n: np.ndarray) -> np.ndarray:
    """base ** n modulo 2 ** 64."""
    out, n = np.ones(len(n), np.uint64), n.astype(np.int64)
    for bit in range(int(n.max(initial=0)).bit_length()):
        out[(n >> bit) & 1 == 1] *= np.uint64(pow(base, 1 << bit, 1 << 64))
    return out


def _numbers(batch: pa.RecordBatch, name: str, kind=np.uint64) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).view(kind)


def scanned(turns: DataFrame) -> DataFrame:
    """(part, conv, pos, hash, fp, role, text): turns numbered from 1 within the conversation and task, with the fingerprint of
    the prefix that they end there."""
    keys = ["conv", "turn", "role"]
    dealt = turns.repartitionByRange(partitions(turns.sparkSession), *keys, F.substring("text", 1, 64)).sortWithinPartitions(*keys, "text")
    rows = dealt.select("conv", F.xxhash64("role", "text").alias("hash"), "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, before, carried = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, hashes = _numbers(batch, "conv", np.int64), mixed(_numbers(batch, "hash"))
            first = run_starts(conv)
            run_of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(conv))))
            place = np.arange(len(conv)) - first[run_of] + 1
            sums = np.cumsum(hashes * powers(_INVERSE, place))
            earlier = np.concatenate([np.zeros(1, np.uint64), sums])[first]
            fp = (sums - earlier[run_of]) * powers(_BASE, place)
            if conv[0] == last:
                same = run_of == 0
                fp[same] += np.uint64(carried) * powers(_BASE, place[same])
                place[same] += before
            last, before, carried = conv[-1], int(place[-1]), int(fp[-1])
            columns = [np.full(len(conv), part, np.int64), conv, place, hashes.view(np.int64), fp.view(np.int64)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), batch.column("role"), batch.column("text")], ["part", "conv", "pos", "hash", "fp", "role", "text"])

    return map_arrow(rows, run, "part long, conv long, pos long, hash long, fp long, role string, text string")


def placed(scan: DataFrame) -> DataFrame:
    """The scan with places and fingerprints of whole conversations: those cut by the tasks' ranges, two a task at most, go on
    from what stands before."""
    ends = scan.groupBy("part").agg(F.min("conv"), F.max("conv")).collect()  # a row for each task
    lasts = [r[2] for r in ends]
    cut = sorted({r[1] for r in ends if lasts.count(r[1]) > 1 or (r[1] in lasts and r[1] != r[2])})
    if not cut:
        return scan
    known = scan.where(F.col("conv").isin(cut)).groupBy("part", "conv").agg(F.max("pos"), F.max_by("fp", "pos")).collect()
    before, total = {}, {}
    for part, conv, n, fp in sorted(known):
        at, so_far = total.get(conv, (0, 0))
        before[part, conv] = at, so_far
        total[conv] = at + n, (so_far * pow(_BASE, n, 1 << 64) + (fp & _WRAP)) & _WRAP

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, conv, place, fp = _numbers(batch, "part", np.int64), _numbers(batch, "conv", np.int64), _numbers(batch, "pos", np.int64).copy(), _numbers(batch, "fp").copy()
            for k in np.unique(part).tolist():
                for (own, c), (at, so_far) in before.items():
                    if own == k and at:
                        same = (part == k) & (conv == c)
                        fp[same] += np.uint64(so_far) * powers(_BASE, place[same])
                        place[same] += at
            batch = batch.set_column(2, "pos", pa.array(place))
            yield batch.set_column(4, "fp", pa.array(fp.view(np.int64)))

    return map_arrow(scan, run, scan.schema)


def rebuilt(rows: DataFrame, base: Column, taken: Column) -> tuple[DataFrame, DataFrame]:
    """Members (conv, depth, cls, parent, role, text, last) of all prefixes but the empty one, and the conversations that have
    no other (conv).  A conversation takes over the first turns of its base, and goes on with its own after as many."""
    bits = BITS
    heads = F.collect_list(F.when(F.col("pos") <= TAKEN, F.struct("pos", "fp")))
    convs = rows.groupBy("conv").agg(F.max("pos").alias("n"), F.transform(F.sort_array(heads), lambda x: x["fp"]).alias("heads"))
    convs = convs.withColumns({"base": base, "taken": F.when(base == F.col("conv"), 0).otherwise(taken).cast("long")})
    others = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"), F.col("heads").alias("base_heads")).join(convs.select("base").distinct(), "base", "left_semi")
    convs = convs.join(others, "base", "left").withColumn("m", F.least("taken", F.coalesce("base_n", F.lit(0))))
    at = lambda heads, n: F.when(n > 0, F.coalesce(F.get(heads, (n - 1).cast("int")), F.lit(0))).otherwise(F.lit(0)).cast("long")
    convs = stored(convs.select("conv", "base", "n", "taken", "m", at(F.col("heads"), F.col("taken")).alias("own_fp"), at(F.col("base_heads"), F.col("m")).alias("base_fp")), "convs")
    own = rows.join(convs.drop("base"), "conv").where("pos > taken")
    own = own.select("conv", (F.col("pos") - F.col("taken") + F.col("m")).alias("depth"), (F.col("pos") - F.col("taken")).alias("after"), "hash", "fp", "own_fp", "base_fp", "role", "text", (F.col("pos") == F.col("n")).alias("last"))
    head = rows.where(F.col("pos") <= TAKEN).select(F.col("conv").alias("base"), "pos", "hash", "fp", "role", "text")
    zero = F.lit(0).cast("long")
    head = head.join(convs.where("m > 0").select("conv", "base", "m", "taken", "n"), "base").where("pos <= m")
    head = head.select("conv", F.col("pos").alias("depth"), zero.alias("after"), "hash", "fp", zero.alias("own_fp"), zero.alias("base_fp"), "role", "text", ((F.col("pos") == F.col("m")) & (F.col("n") <= F.col("taken"))).alias("last"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64((1 << bits) - 1)
        for batch in batches:
            hashes, fp = _numbers(batch, "hash"), _numbers(batch, "fp")
            fp = fp + (_numbers(batch, "base_fp") - _numbers(batch, "own_fp")) * powers(_BASE, _numbers(batch, "after", np.int64))
            parent = (fp - hashes) * np.uint64(_INVERSE)
            numbers = [pa.array((x & mask).view(np.int64)) for x in (fp, parent)]
            columns = [batch.column("conv"), batch.column("depth"), *numbers, *(batch.column(c) for c in ("role", "text", "last"))]
            yield pa.RecordBatch.from_arrays(columns, ["conv", "depth", "cls", "parent", "role", "text", "last"])

    members = map_arrow(own.unionByName(head), run, "conv long, depth long, cls long, parent long, role string, text string, last boolean")
    return members, convs.where("m = 0 and n <= taken").select("conv")


def verified(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members whose groups are of one prefix each, and these groups: (depth, cls, parent, role, text, first, n)."""
    number = 0
    while True:
        found = stored(members.groupBy("depth", "cls", "parent", "role", "text").agg(F.min("conv").alias("first"), F.count("*").alias("n")), "groups")
        own = F.struct("parent", "role", "text")
        representative = F.first(own).over(Window.partitionBy("depth", "cls").orderBy("first"))
        other = found.withColumn("rep", representative).where(own != F.col("rep")).drop("rep")
        other = stored(other.select("depth", "cls", "parent", "role", "text", F.xxhash64("cls", "parent", "role", "text", F.lit(number)).alias("new")), "collisions")
        if not other.limit(1).count():
            dropped(other)
            return members, found
        keys = ["depth", "cls", "parent", "role", "text"]
        moved = members.join(small(other), keys, "left")
        below = moved.where("new is not null").select("conv", (F.col("depth") + 1).alias("depth"), F.col("new").alias("above"))
        moved = moved.join(below, ["conv", "depth"], "left")
        after = stored(moved.select("conv", "depth", F.coalesce("new", "cls").alias("cls"), F.coalesce("above", "parent").alias("parent"), "role", "text", "last"), "members")
        dropped(members, found, other)
        members, number = after, number + 1


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Nodes (conv_id, depth, parent_conv_id, values) with the values' sums over their subtrees.  A node is named by its
    smallest member and its depth."""
    keys = ["conv_id", "depth"]
    state = stored(nodes.select(*keys, F.col("parent_conv_id").alias("up"), *values), "rollup")
    deepest, step = state.agg(F.max("depth")).first()[0] or 0, 1
    nothing = F.lit(None).cast("long").alias("up")
    while step <= deepest:
        below = state.where("up is not null").withColumn("at", F.col("depth") - step)
        above = state.where("up is not null").select(F.col("conv_id").alias("up"), F.col("depth").alias("at"), F.col("up").alias("far"))
        far = below.select("conv_id", "depth", "up", "at").join(above, ["up", "at"]).select(*keys, F.col("far").alias("up"), *[F.lit(0).cast("long").alias(v) for v in values])
        more = below.select(F.col("up").alias("conv_id"), F.col("at").alias("depth"), nothing, *values)
        after = state.select(*keys, nothing, *values).union(more).union(far)
        after = stored(after.groupBy(*keys).agg(F.max("up").alias("up"), *[F.sum(v).alias(v) for v in values]), "rollup")
        dropped(state)
        state, step = after, 2 * step
    return state.drop("up")


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(depth, cls, ends_sha256) of (depth, cls, conv): the hash of the ids, ascending, joined by commas."""
    n, keys = partitions(ends.sparkSession), ["depth", "cls"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth, cls, conv = (_numbers(batch, c, np.int64) for c in ("depth", "cls", "conv"))
            first = np.union1d(run_starts(depth), run_starts(cls))
            limits = np.append(first, len(conv)).tolist()
            ids = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(limits, limits[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(x[first]) for x in (depth, cls, conv)] + [pa.array(ids, pa.string())], ["depth", "cls", "conv", "ids"])

    parts = ends.select(*keys, "conv").repartitionByRange(n, *keys, "conv").sortWithinPartitions(*keys, "conv")
    parts = map_arrow(parts, join, "depth long, cls long, conv long, ids string").repartition(n, *keys).sortWithinPartitions(*keys, "conv")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, key, running = [*keys, "ends_sha256"], None, None
        out = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names)
        for batch in batches:
            rows = []
            for *own, ids in zip(*(batch.column(c).to_pylist() for c in (*keys, "ids"))):
                if own != key:
                    rows += [(*key, running.hexdigest())] if running else []
                    key, running = own, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield out(rows)
        if running:
            yield out([(*key, running.hexdigest())])

    return map_arrow(parts, digest, "depth long, cls long, ends_sha256 string")


def trie(conversations: DataFrame, base: Column, taken: Column, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a row a node; a node's conv_id is its smallest member.
    base, taken: over the column conv, the conversation that it takes initial turns over from, and of how many, at most TAKEN."""
    turns = conversations.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    scan = stored(scanned(turns.where("conv is not null")), "turns", release=True)
    members, turnless = rebuilt(placed(scan), base, taken)
    members, groups = verified(stored(members, "members", release=True))
    zero = F.lit(0).cast("long")
    root = scan.agg(F.min("conv").alias("conv_id"), F.countDistinct("conv").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("cls"), F.lit(None).cast("long").alias("parent"), "conv_id", "n_convs", zero.alias("chars"))
    nodes = stored(groups.select("depth", "cls", "parent", F.col("first").alias("conv_id"), F.col("n").alias("n_convs"), F.length("text").cast("long").alias("chars")).union(root), "nodes")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("cls").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("cls")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(parents, ["depth", "parent"], "left").join(children, ["depth", "cls"], "left")
    nodes = nodes.withColumns({"n_children": F.coalesce("n_children", zero), "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")})
    nodes = stored(nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")), "nodes")
    sums = subtree_sums(nodes, ["n_leaves", "saved_tokens"])
    ends = members.where("last").select("depth", "cls", "conv").union(turnless.select(zero, zero, "conv"))
    nodes = nodes.drop("n_leaves", "saved_tokens").join(sums, ["conv_id", "depth"]).join(ends_hashes(ends), ["depth", "cls"], "left")
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")
    )
