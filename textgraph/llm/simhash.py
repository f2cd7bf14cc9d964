"""SimHash near-duplicates by tiled exact comparison (operator 8).

Fingerprints are compared exactly: numpy exclusive-or and bit counts over tiles that are sorted by population count,
where a pair of tiles is skipped if its population counts differ by more than the radius.  Of r + 3 blocks of bits, two
fingerprints within radius r agree on three at least, so tiles are built for each value of each three blocks (32 bits of 64
for a radius of 3, in 20 ways): no pair is lost, no task sees all fingerprints, and the fingerprints of a value stay few
as the corpus grows.  Equal fingerprints are merged before that, so copies never meet pairwise; each task
hands on a spanning forest of its links only.

Defined cases: null or empty texts have the fingerprint zero and link like any other; rows with a null id get their
component's smallest id that is not null; equal ids and repeated rows stay separate rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.llm.common import components, contract, local_roots, map_arrow, partitions, run_starts, small, stored

SEED = 42
#: Hashes whose bits are spread at a time, rows of a tile, rows of one block value that a single task compares.
SPREAD, TILE, CELL_ROWS = 1 << 15, 1024, 1 << 14
#: Blocks of bits on which a pair agrees at least, and rows of a block value up to which it isn't cut into tiles.
EQUAL_BLOCKS, SMALL_GROUP = 3, 64


def shingle_hashes(raw: bytes, words: int) -> list[int]:
    tokens = raw.lower().split()  # bytes: lowers A-Z and splits at ASCII white space only
    if not tokens:
        return []
    if len(tokens) < words:
        return [xxhash.xxh64_intdigest(b" ".join(tokens), SEED)]
    line = b" ".join(tokens)
    ends = list(itertools.accumulate(len(t) + 1 for t in tokens))
    digest = xxhash.xxh64_intdigest
    return [digest(line[a : b - 1], SEED) for a, b in zip([0, *ends], ends[words - 1 :])]


def majority(hashes: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """One fingerprint for each run of hashes: the bits that over half of its hashes have."""
    counts = np.zeros((len(limits) - 1, 64), np.int64)
    owner = np.repeat(np.arange(len(limits) - 1), np.diff(limits))
    for at in range(0, len(hashes), SPREAD):
        part, of = hashes[at : at + SPREAD], owner[at : at + SPREAD]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = run_starts(of)
        counts[of[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    over = (2 * counts > np.diff(limits)[:, None]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): each text's 64-bit SimHash over word shingles, repeats included."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            lists = [shingle_hashes(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in batch.column(1).cast(pa.binary())]
            limits = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)]).astype(np.int64)
            hashes = np.fromiter(itertools.chain.from_iterable(lists), np.uint64, int(limits[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(majority(hashes, limits).view(np.int64))], ["id", "fp"])

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")), run, "id long, fp long")


def tile_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the fingerprints (uint64) of one group that differ in at most radius bits."""
    counts = np.bitwise_count(fps)
    order = np.argsort(counts, kind="stable")
    fps, counts = fps[order], counts[order].astype(np.int64)
    found = [np.zeros((0, 2), np.int64)]
    for i in range(0, len(fps), TILE):
        a = fps[i : i + TILE]
        for j in range(i, len(fps), TILE):
            if counts[j] - counts[min(i + TILE, len(fps)) - 1] > radius:
                break  # every later tile is further away still
            x, y = np.nonzero(np.bitwise_count(a[:, None] ^ fps[None, j : j + TILE]) <= radius)
            x, y = x + i, y + j
            if (keep := x < y).any():
                node, root = local_roots(x[keep], y[keep])
                found.append(np.stack([node, root], 1)[node != root])
    pairs = np.concatenate(found)
    if len(pairs):
        node, root = local_roots(pairs[:, 0], pairs[:, 1])
        pairs = np.stack([node, root], 1)[node != root]
    return fps[pairs[:, 0]], fps[pairs[:, 1]]


def _group_links(keys: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside each run of equal keys, which is sorted by population count: runs of less than a tile by shifted
    comparison, all of them at once, larger ones tile by tile."""
    start = run_starts(keys)
    size = np.diff(np.append(start, len(keys)))
    a, b = [], []
    for s, n in zip(start[size > SMALL_GROUP], size[size > SMALL_GROUP]):
        x, y = tile_links(fps[s : s + n], radius)
        a.append(x), b.append(y)
    counts = np.bitwise_count(fps).astype(np.int64)
    at = np.flatnonzero(np.repeat(size <= SMALL_GROUP, size))
    for shift in range(1, SMALL_GROUP):
        at = at[at + shift < len(keys)]
        # the counts of a run rise: a row that is out of reach now stays so
        at = at[(keys[at] == keys[at + shift]) & (counts[at + shift] - counts[at] <= radius)]
        if not len(at):
            break
        hit = at[np.bitwise_count(fps[at] ^ fps[at + shift]) <= radius]
        a.append(fps[hit]), b.append(fps[hit + shift])
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *a]), np.concatenate([empty, *b])


def links(prints: DataFrame, radius: int = 3, forests: bool = False) -> DataFrame:
    """Links (a, b), b < a as signed 64-bit values, that connect all distinct fingerprints within the radius.
    forests: each batch of links is contracted to stars, in the worker that finds them."""
    blocks = radius + EQUAL_BLOCKS
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = [(1 << edges[k + 1]) - (1 << edges[k]) for k in range(blocks)]
    chosen = [sum(c) for c in itertools.combinations(masks, EQUAL_BLOCKS)]
    signed = [m - (1 << 64) if m >> 63 else m for m in chosen]
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for k, m in enumerate(signed)])
    rows = prints.select("fp", F.explode(keys).alias("bucket"))
    # a block value that very many fingerprints share is cut into cells: each pair of its parts meets in one of them
    parts = rows.groupBy("bucket").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("parts")).where("parts > 1")
    part = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts")).cast("int")
    other = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1)))
    parts = stored(parts, "parts")
    if not parts.limit(1).count():
        rows = rows.select("fp", F.col("bucket").alias("key"))
        return _compared(rows, radius, forests)
    rows = rows.join(small(parts), "bucket", "left").select("fp", "bucket", F.coalesce(part, F.lit(0)).alias("p"), other.alias("o"))
    rows = rows.select("fp", F.xxhash64("bucket", F.least("p", "o"), F.greatest("p", "o")).alias("key"))
    return _compared(rows, radius, forests)


def _compared(rows: DataFrame, radius: int, forests: bool) -> DataFrame:
    """Links among the fingerprints of each key, over (fp, key)."""

    def run(batch_rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def flush(last: bool):
            keys, fps = np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held])
            cut = len(keys) if last else int(np.searchsorted(keys, keys[-1]))
            held[:] = [(keys[cut:], fps[cut:])]
            if cut:
                a, b = _group_links(keys[:cut], fps[:cut], radius)
                a, b = a.view(np.int64), b.view(np.int64)
                if len(a):
                    return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])
            return None

        for batch in batch_rows:
            held.append((batch.column(1).to_numpy(zero_copy_only=False), batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))
            n += batch.num_rows
            if n >= 1 << 16:
                if (out := flush(False)) is not None:
                    yield out
                n = len(held[0][0])
        if held and (out := flush(True)) is not None:
            yield out

    dealt = rows.repartition(partitions(rows.sparkSession), "key").sortWithinPartitions("key", F.bit_count("fp"))
    return map_arrow(dealt, (lambda rows: contract(run(rows))) if forests else run, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component): the smallest id reachable over fingerprints within the radius, itself included."""
    rows = stored(fingerprints(docs, shingle, id_col, text_col), "prints")
    prints = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    found = links(prints, radius, forests=True)
    reached = components(found, forests=True)
    named = prints.join(reached.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    roots = named.groupBy("component").agg(F.min("least").alias("first"))
    label = named.join(roots, "component").select("fp", F.col("first").alias("component"))
    return rows.join(label, "fp").select("id", "fp", "component")
