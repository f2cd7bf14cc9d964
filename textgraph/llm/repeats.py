"""Removal of repeated byte strings by a prefix-free parse (operator 7).

A byte is removed if a string of ``width`` bytes that covers it also starts earlier in the corpus: in a document with a
smaller id, or earlier in the same one.

Parse.  A rolling hash of GRAM bytes marks triggers: the least hash of every ``width``-byte string.  A trigger depends on
the string's own bytes alone, so equal strings have it at the same place, and each string belongs to one phrase: the
bytes under all strings that share a trigger.  Phrases are the dictionary, their places in the documents the parse.
Order.  Suffixes of phrases only matter up to ``width`` bytes, and no such string reaches beyond its phrase.  So the suffix
array of the dictionary, by doubling up to ``width`` bytes, makes equal strings adjacent, and the parse orders equal
ones as the corpus does, by id and offset.  A task builds it for the phrases of its triggers.

1. A task sorts the phrases of a block of text.  All but the first of equal phrases are removed there.  A trigger with
   CROWD different phrases in a block, as a very common line makes, is crowded: its strings are compared one by one, and the
   block passes on one phrase, marked, and each distinct string.  What blocks pass on is gathered and all but the first of
   equal ones removed again, so copies, however many, leave one phrase or string for MERGED_ROWS of them in a task.
2. Phrases meet by trigger.  Of equal ones the first stays.  Where a trigger has different phrases, their texts are read
   again; where it is crowded in any block, or here, their strings are.
3. Texts meet by trigger: the suffix array orders their strings, and all but the first of equal ones are removed.  Strings of crowded
   triggers meet by trigger and content hash, so no task gets a crowd.
4. Each document's removed strings are merged to spans.

Strings that meet in step 3 by trigger are compared by their bytes.  Whole phrases, and strings of crowded triggers, are
compared by hashes, because they must not meet in one task: 64 bits of the polynomial that also finds triggers and 32 of
another one, with its own base and byte values, beside the 64 bits of the trigger's own hash.

The parse's own suffix array is not built: phrases overlap by all but one byte of a string, so no string that is compared
reaches into a next phrase, and of the parse only the order of places (id, offset) is needed, which ranks equal strings.

Defined cases: a null or empty text has no bytes; a null id comes before all others; rows with equal ids are separate
documents in the order of their texts; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.llm.common import dropped, keyed, map_arrow, mixed, partitions, run_starts, stored, text_bytes

GRAM = 24
#: Bytes of a block, and bits that number its places.
BLOCK, PLACE_BITS = 2 << 20, 22
#: Different phrases of a trigger in a block, or among blocks, from which it counts as crowded.
CROWD, CROWD_MET = 4, 2000
#: Phrases and strings that a task gathers before it passes them on.
MERGED_ROWS = 1 << 20
PHRASE, REMOVED, STRING = 0, 1, 2
ROWS = "kind int, k1 long, k2 long, k3 int, id long, at long, n int, marked boolean"
_NAMES = [x.split()[0] for x in ROWS.split(", ")]


#: Two polynomials: a base and a seed of the bytes' values.
_BASES = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


@cache
def _tables(k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random value per byte, and the powers of an odd base and of its inverse modulo 2**64."""
    base = _BASES[k]
    size = BLOCK + (BLOCK >> 1)
    power = lambda b: np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b, np.uint64))])
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(base)), power(base), power(pow(base, -1, 1 << 64))


class Block:
    """Texts side by side, with two hashes of any of their strings."""

    def __init__(self, raw: np.ndarray):
        self.raw, self.sums, self.inverse = raw, [], []
        for k in range(len(_BASES)):
            values, power, inverse = _tables(k)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[raw] * power[: len(raw)])]))
            self.inverse.append(inverse)

    def hashes(self, start: np.ndarray, end: np.ndarray, k: int = 0) -> np.ndarray:
        return mixed((self.sums[k][end] - self.sums[k][start]) * self.inverse[k][start])

    def checks(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """32 bits of the second hash."""
        return (self.hashes(start, end, 1) >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def phrases(self, limits: np.ndarray, width: int):
        """Of each phrase its first string's place, how many strings it has, trigger and content hashes."""
        none = np.zeros(0, np.int64)
        places = [np.arange(a, b - width + 1) for a, b in zip(limits[:-1], limits[1:]) if b - a >= width]
        if not places:
            return none, none, none, none, none.astype(np.int32)
        sums = self.sums[0]
        grams = mixed((sums[GRAM:] - sums[:-GRAM]) * self.inverse[0][: len(sums) - GRAM])
        mask = np.uint64((1 << PLACE_BITS) - 1)
        least = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
        span, wide = width - GRAM + 1, 1
        while 2 * wide <= span:
            least = np.minimum(least[:-wide], least[wide:])
            wide *= 2
        if span > wide:
            least = np.minimum(least[: len(least) - (span - wide)], least[span - wide :])
        at = np.concatenate(places)
        trigger = (least[at] & mask).astype(np.int64)
        first = run_starts(trigger)
        n = np.diff(np.append(first, len(trigger)))
        start, trigger = at[first], trigger[first]
        end = start + n - 1 + width
        inside = self.hashes(start, end) ^ mixed((trigger - start).astype(np.uint64))
        return start, n, grams[trigger].view(np.int64), inside.view(np.int64), self.checks(start, end)


def _first_of(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the columns, and which rows differ from the one before in all but the last two of them."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns[:-2]:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    return order, new


def _rows(kind: int, k1=None, k2=None, k3=None, ids=None, at=None, n=None, marked=None) -> pa.RecordBatch:
    size = len(ids)
    zero = np.zeros(size, np.int64)
    pick = lambda x, y: y if x is None else x
    arrays = [
        pa.array(np.full(size, kind, np.int32)), pa.array(pick(k1, zero)), pa.array(pick(k2, zero)), pa.array(pick(k3, zero.astype(np.int32))), pa.array(ids), pa.array(at),
        pa.array(pick(n, np.ones(size)).astype(np.int32)), pa.array(pick(marked, np.zeros(size, bool))),
    ]
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


def _removed(ids: np.ndarray, at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Rows of removed strings; those that follow each other are joined."""
    order = np.lexsort((at, ids))
    ids, at, n = ids[order], at[order], n[order].astype(np.int64)
    follows = np.zeros(len(ids), bool)
    follows[1:] = (ids[1:] == ids[:-1]) & (at[1:] == at[:-1] + n[:-1])
    first = np.flatnonzero(~follows)
    n = np.add.reduceat(n, first) if len(first) else n
    ids, at = ids[first], at[first]
    # keys that deal these rows evenly
    return _rows(REMOVED, mixed((ids * 31 + at).view(np.uint64)).view(np.int64), None, None, ids, at, n)


def _strings(block: Block, width: int, start: np.ndarray, n: np.ndarray, k1: np.ndarray, ids: np.ndarray, shift: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Compare the strings of phrases one by one: distinct ones are rows, others are removed."""
    place = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    k1, ids, at = np.repeat(k1, n), np.repeat(ids, n), place + np.repeat(shift, n)
    k2, k3 = block.hashes(place, place + width).view(np.int64), block.checks(place, place + width)
    order, new = _first_of(k1, k2, k3, ids, at)
    keep, gone = order[new], order[~new]
    yield _rows(STRING, k1[keep], k2[keep], k3[keep], ids[keep], at[keep])
    yield _removed(ids[gone], at[gone], np.ones(len(gone)))


def _blocks(rows: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    """(bytes, limits, ids, shifts, row numbers, batch): texts of bounded size; longer ones in parts that overlap by a string."""
    parts, size = [], 0
    step = BLOCK - width

    def joined():
        limits = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])]).astype(np.int64)
        return np.concatenate([p[0] for p in parts]), limits, *(np.array([p[k] for p in parts], np.int64) for k in (1, 2)), [p[3] for p in parts]

    for batch in rows:
        raw, limits = text_bytes(batch.column(1))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        more = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * len(ids)
        for k in np.flatnonzero(np.diff(limits) >= width):
            text = raw[limits[k] : limits[k + 1]]
            for s in range(0, max(1, len(text) - width + 1), step):
                part = text[s : s + step + width - 1]
                if size + len(part) > BLOCK and parts:
                    yield joined()
                    parts, size = [], 0
                parts.append((part, ids[k], s, more[k]))
                size += len(part)
    if parts:
        yield joined()


def parsed(docs: DataFrame, width: int) -> DataFrame:
    """Step 1, over (id, text)."""
    enough = MERGED_ROWS

    def of_blocks(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for raw, limits, ids, shifts, _ in _blocks(rows, width):
            block = Block(raw)
            start, n, k1, k2, k3 = block.phrases(limits, width)
            of = np.searchsorted(limits, start, "right") - 1
            doc, shift = ids[of], shifts[of] - limits[of]
            order, new = _first_of(k1, k2, k3, doc, start + shift)
            gone, keep = order[~new], order[new]
            yield _removed(doc[gone], start[gone] + shift[gone], n[gone])
            head = run_starts(k1[keep])
            several = np.diff(np.append(head, len(keep))) >= CROWD
            crowded = np.repeat(several, np.diff(np.append(head, len(keep))))
            passed = np.zeros(len(keep), bool)
            passed[head] = True
            passed |= ~crowded
            p = keep[passed]
            yield _rows(PHRASE, k1[p], k2[p], k3[p], doc[p], start[p] + shift[p], n[p], crowded[passed])
            m = keep[crowded]
            yield from _strings(block, width, start[m], n[m], k1[m], doc[m], shift[m])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def merged() -> Iterator[pa.RecordBatch]:
            kind, k1, k2, k3, ids, at, n, marked = (np.concatenate(c) for c in zip(*held))
            order, new = _first_of(k1, k2, k3, kind, marked, ids, at)
            gone, keep = order[~new], order[new]
            yield _removed(ids[gone], at[gone], n[gone])
            for k in (PHRASE, STRING):
                p = keep[kind[keep] == k]
                yield _rows(k, k1[p], k2[p], k3[p], ids[p], at[p], n[p], marked[p])

        for batch in of_blocks(rows):
            if batch.num_rows and batch.column(0)[0].as_py() == REMOVED:
                yield batch
            elif batch.num_rows:
                held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                n += batch.num_rows
                if n >= enough:
                    yield from merged()
                    held, n = [], 0
        if held:
            yield from merged()

    return map_arrow(docs, run, ROWS)


def _sorted_runs(rows: Iterator[pa.RecordBatch], keys: int, least_rows: int = 1 << 17, first: int = 1) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by so many columns from the first one on, cut where those change."""
    held, n = [], 0
    for batch in rows:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        n += batch.num_rows
        if n >= least_rows:
            columns = [np.concatenate(c) for c in zip(*held)]
            new = np.zeros(n, bool)
            for c in columns[first : first + keys]:
                new[1:] |= c[1:] != c[:-1]
            cut = int(np.flatnonzero(new)[-1]) if new.any() else 0
            if cut:
                yield [c[:cut] for c in columns]
            held, n = [[c[cut:] for c in columns]], n - cut
    if n:
        yield [np.concatenate(c) for c in zip(*held)]


def met(rows: DataFrame) -> DataFrame:
    """Step 2: the phrases of a trigger.  PHRASE rows of the result are those to be read again, marked if crowded."""
    most = CROWD_MET

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, k1, k2, k3, ids, at, n, marked in _sorted_runs(batches, 1):
            for other in (REMOVED, STRING):
                o = kind == other
                yield _rows(other, k1[o], k2[o], k3[o], ids[o], at[o], n[o])
            p = np.flatnonzero(kind == PHRASE)
            order, new = _first_of(k1[p], k2[p], k3[p], ids[p], at[p])
            p = p[order]
            gone = p[~new]
            yield _removed(ids[gone], at[gone], n[gone])
            head = run_starts(k1[p])
            if len(head):
                size = np.diff(np.append(head, len(p)))
                different = np.add.reduceat(new.astype(np.int64), head)
                crowd = np.logical_or.reduceat(marked[p], head) | (different > most)
                ask = np.repeat((different > 1) | crowd, size) & new & ~marked[p]
                crowd, p = np.repeat(crowd, size)[ask], p[ask]
                yield _rows(PHRASE, k1[p], k2[p], k3[p], ids[p], at[p], n[p], crowd)

    spark = rows.sparkSession
    # strings only pass through: those of a crowded trigger are dealt by their content
    key = F.when(F.col("kind") == STRING, F.col("k2")).otherwise(F.col("k1"))
    dealt = rows.repartition(partitions(spark), key).sortWithinPartitions("k1")
    return map_arrow(dealt, run, ROWS)


def asked(docs: DataFrame, requests: DataFrame, width: int) -> DataFrame:
    """The texts of phrases that have to be compared (body), or their strings where the trigger is crowded."""
    each = requests.groupBy("id").agg(F.collect_list(F.struct("at", "n", "k1", "marked")).alias("ask"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def with_body(batch: pa.RecordBatch, body=None) -> pa.RecordBatch:
            return batch.append_column("body", pa.nulls(batch.num_rows, pa.binary()) if body is None else pa.array(body, pa.binary()))

        for raw, limits, ids, shifts, asks in _blocks(rows, width):
            found = {True: [[] for _ in range(5)], False: [[] for _ in range(5)]}
            for k, ask in enumerate(asks):
                for a in ask:
                    # a part of a long text has the strings that start in it; a phrase may end in the next part
                    low = max(a["at"], shifts[k])
                    high = min(a["at"] + a["n"], shifts[k] + limits[k + 1] - limits[k] - width + 1)
                    if low < high:
                        for c, x in zip(found[a["marked"]], (low - shifts[k] + limits[k], high - low, a["k1"], ids[k], shifts[k] - limits[k])):
                            c.append(x)
            start, n, k1, of, shift = (np.array(c, np.int64) for c in found[False])
            body = [raw[a : a + b - 1 + width].tobytes() for a, b in zip(start.tolist(), n.tolist())]
            yield with_body(_rows(PHRASE, k1, None, None, of, start + shift, n), body)
            if found[True][0]:
                for batch in _strings(Block(raw), width, *(np.array(c, np.int64) for c in found[True])):
                    yield with_body(batch)

    return map_arrow(docs.join(each, "id").select("id", "text", "ask"), run, ROWS + ", body binary")


def suffix_ranks(text: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """The suffix array of a dictionary as far as it is needed: lexicographic ranks of the ``width`` bytes at each start,
    equal for equal bytes, by doubling the compared prefix."""
    size = 8 if width >= 8 else 1
    views = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, size))
    rank = np.unique(views.view(">u8" if size == 8 else np.uint8).ravel(), return_inverse=True)[1].astype(np.int64)
    while 2 * size <= width:
        rank = np.unique(rank[:-size] * (int(rank.max()) + 1) + rank[size:], return_inverse=True)[1].astype(np.int64)
        size *= 2
    return np.unique(rank[starts] * (int(rank.max()) + 1) + rank[starts + width - size], return_inverse=True)[1]


def _first_strings(width: int, ids: np.ndarray, at: np.ndarray, n: np.ndarray, bodies: list[bytes]) -> pa.RecordBatch:
    """Of phrases with their texts: the strings that equal an earlier one.  Strings in the order of their bytes, and
    equal ones in the order of the parse, which is that of the corpus."""
    limits = np.concatenate([[0], np.cumsum([len(x) for x in bodies])]).astype(np.int64)
    n = n.astype(np.int64)
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    ids, at = np.repeat(ids, n), np.repeat(at, n) + step
    if not len(ids):
        return _removed(ids, at, step)
    rank = suffix_ranks(np.frombuffer(b"".join(bodies), np.uint8), np.repeat(limits[:-1], n) + step, width)
    order, new = _first_of(rank, ids, at)
    gone = order[~new]
    return _removed(ids[gone], at[gone], np.ones(len(gone)))


def ordered(phrases: DataFrame, width: int) -> DataFrame:
    """Step 3 for texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k1, ids, at, n, bodies in _sorted_runs(batches, 1, 1 << 13, first=0):
            yield _first_strings(width, ids, at, n, bodies.tolist())

    dealt = phrases.select("k1", "id", "at", "n", "body").repartition(partitions(phrases.sparkSession), "k1").sortWithinPartitions("k1")
    return map_arrow(dealt, run, ROWS)


def compared(strings: DataFrame) -> DataFrame:
    """Step 3 for strings: all but the first of equal ones are removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, k1, k2, k3, ids, at, n, _ in _sorted_runs(batches, 2):
            order, new = _first_of(k1, k2, k3, ids, at)
            gone = order[~new]
            yield _removed(ids[gone], at[gone], n[gone])

    dealt = strings.repartition(partitions(strings.sparkSession), "k1", "k2").sortWithinPartitions("k1", "k2")
    return map_arrow(dealt, run, ROWS)


def merged_spans(at: np.ndarray, n: np.ndarray, width: int) -> np.ndarray:
    """Removed strings as maximal runs of bytes, (start, end)."""
    order = np.argsort(at, kind="stable")
    start, end = at[order], np.maximum.accumulate(at[order] + n[order] - 1 + width)
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return np.stack([start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]], 1)


def remove_repeats(docs: DataFrame, width: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (start, end in bytes) and kept (the bytes left)."""
    own = keyed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")
    texts = own.select("id", "text")
    found = stored(met(parsed(texts, width)), "met", release=True)
    more = stored(asked(texts, found.where(F.col("kind") == PHRASE), width), "asked", release=True)
    of = lambda df, kind: df.where(F.col("kind") == kind).drop("body")
    meet = [compared(of(found, STRING).union(of(more, STRING))), ordered(more.where(F.col("kind") == PHRASE), width)]
    gone = stored(of(found, REMOVED).union(of(more, REMOVED)).union(meet[0]).union(meet[1]).select("id", "at", "n"), "gone", release=True)
    dropped(found, more)
    gone = gone.groupBy("id").agg(F.collect_list("at").alias("at"), F.collect_list("n").alias("n"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            raw, limits = text_bytes(batch.column(1))
            out = [[] for _ in range(4)]
            for k, (at, n) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                text = raw[limits[k] : limits[k + 1]].tobytes()
                spans = merged_spans(np.array(at, np.int64), np.array(n, np.int64), width) if at else np.zeros((0, 2), np.int64)
                edges = [0, *spans.ravel().tolist(), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                for c, x in zip(out, (len(text), len(text) - len(kept), [{"start": int(a), "end": int(b)} for a, b in spans], kept)):
                    c.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), span, pa.binary())))], ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    joined = own.join(gone, "id", "left").select("row.doc_id", own.text, "at", "n")
    return map_arrow(joined, run, "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")


