"""Benchmark decontamination with an FM-index per training shard (operator 1).

A task gathers rows to shards and indexes each: the suffix array of the shard's words gives its Burrows-Wheeler
transform, held as a wavelet tree over word numbers, and sampled suffix positions.  All windows of the benchmark are
searched backward at once through wavelet ranks; occurrences are located by walking to a sampled position, and the
words that they cover are merged to removal spans.

The index holds what a window can occur in: runs of words that the benchmark uses, at least as long as the shortest
window.  Words are numbered by exact lookup.  The benchmark's items, long ones in overlapping pieces, are written to the
shared folder in blocks of about ``block_bytes``; nothing of them passes the driver.  A task reads one block at a time, as an
array of word numbers in which windows are places, and searches each shard for the windows of every block.  The documents
are read once, and there is no shuffle of them.

Defined cases: a null or empty text has no words; a null item_id is an item of its own, named null among the items; items
with equal ids are one item; repeated documents stay separate rows; an empty benchmark hits nothing; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import dataset, fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgraph.llm.common import dropped, map_arrow, mixed, new_folder, partitions, run_starts, stored

#: A word is a run of these bytes of the UTF-8 text: 0-9, a-z, A-Z (lowered) and all bytes beyond ASCII.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Words of a shard, every how many suffix positions one is kept, bytes of benchmark text in a block.
SHARD_WORDS, SAMPLE, BLOCK_BYTES = 1 << 21, 16, 8 << 20
#: Words of a piece of a long item, windows that are sought at a time, blocks that a task keeps.
PIECE_WORDS, SOUGHT, KEPT_BLOCKS = 1 << 16, 1 << 16, 2
#: Item ids of the documents that go out together, one document's at least.
OUT_ITEMS = 1 << 18
_SPAN = "array<struct<start:int,end:int>>"


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_WORD_BYTES).split()


class WaveletTree:
    """Ranks and access over an integer sequence, one bit level at a time, for many arguments at once."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels = []
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bit = (values >> shift) & 1
            ones = np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32)
            self.levels.append((shift, ones, len(values) - int(ones[-1])))
            values = np.concatenate([values[bit == 0], values[bit == 1]])
        self.origin = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, ones, zeros in self.levels:
            upper = ones[i]
            i = np.where((c >> shift) & 1, zeros + upper, i - upper)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c stands before i."""
        return self._down(c, i) - self.origin[c]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at i, and how often it stands before i."""
        c = np.zeros(len(i), np.int64)
        for shift, ones, zeros in self.levels:
            upper = ones[i]
            bit = ones[i + 1] - upper
            c |= bit.astype(np.int64) << shift
            i = np.where(bit, zeros + upper, i - upper)
        return c, i - self.origin[c]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Of a sequence whose zeros end their runs and differ from each other (the earlier one is smaller)."""
    n = len(text)
    ends = text == 0
    first = np.where(ends, np.cumsum(ends), text.astype(np.int64) + n + 1)
    order = np.argsort(first, kind="stable")
    rank, width = np.empty(n + 1, np.int64), 1
    rank[n] = -1

    def number(slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        rank[order[slots]] = slots[new][np.cumsum(new) - 1]
        alone = new & np.concatenate([new[1:], [True]])
        return slots[~alone]

    slots = number(np.arange(n), first[order]) if n else np.zeros(0, np.int64)
    while len(slots):
        at = order[slots]
        keys = rank[at] * (n + 1) + rank[np.minimum(at + width, n)] + 1
        by = np.argsort(keys, kind="stable")
        order[slots] = at[by]
        slots, width = number(slots, keys[by]), 2 * width
    return order


class FMIndex:
    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_array(text)
        before = text[order - 1]  # the last symbol is an end, so the first suffix is preceded by an end as well
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.tree = WaveletTree(before.astype(np.int64), symbols)
        sampled = (order % SAMPLE == 0) | (before == 0)
        self.sampled, self.count, self.positions = sampled, np.cumsum(sampled) - 1, order[sampled]

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search: the windows (rows of equal length) that occur, with their suffix intervals."""
        rows = np.arange(len(windows))
        low, high = self.before[windows[:, -1]], self.before[windows[:, -1] + 1]
        for j in range(windows.shape[1] - 2, -1, -1):
            live = low < high
            rows, low, high = rows[live], low[live], high[live]
            c = windows[rows, j]
            low, high = self.before[c] + self.tree.rank(c, low), self.before[c] + self.tree.rank(c, high)
        live = low < high
        return rows[live], low[live], high[live]

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by walking back to a sampled one."""
        out, todo, i = np.zeros(len(at), np.int64), np.arange(len(at)), at.copy()
        for steps in range(SAMPLE + 1):
            done = self.sampled[i]
            out[todo[done]] = self.positions[self.count[i[done]]] + steps
            todo, i = todo[~done], i[~done]
            if not len(todo):
                break
            c, k = self.tree.access(i)
            i = self.before[c] + k
        return out


class Windows:
    """The windows of a block of benchmark items: places in one array of word numbers, by length."""

    def __init__(self, items: list[tuple[str | None, bytes]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        self.width, self.items = width, [item for item, _ in items]
        number = self.vocabulary
        texts = [np.fromiter((number.setdefault(w, len(number) + 1) for w in words_of(raw)), np.int32) for _, raw in items]
        size = np.array([len(t) for t in texts], np.int64)
        self.words = np.concatenate([np.zeros(0, np.int32), *texts])
        limits = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        self.first = limits[:-1]
        # where windows start, by their length: items of fewer words are one window, longer ones have many
        self.starts = {int(n): self.first[size == n] for n in np.unique(size[(size > 0) & (size < width)])}
        full = np.flatnonzero(size >= width)
        if len(full):
            n = size[full] - width + 1
            starts = np.repeat(limits[full] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            self.starts[width] = starts.astype(np.int32 if len(self.words) < 1 << 31 else np.int64)
        self.shortest = min(self.starts, default=0)
        #: Ids in the order of the output, and each item's place among them.
        ids = sorted(set(self.items), key=lambda x: (x is None, x or ""))
        place = {x: k for k, x in enumerate(ids)}
        self.ids, place = pa.array(ids, pa.string()), np.array([place[x] for x in self.items], np.int64)
        #: Equal windows are one: a place where it stands, and the ids of the items that have it.
        self.distinct = {n: self._distinct(starts, n, place) for n, starts in self.starts.items()}

    def of(self, starts: np.ndarray) -> np.ndarray:
        """The items in which windows start."""
        return np.searchsorted(self.first, starts, "right") - 1

    def _distinct(self, starts: np.ndarray, n: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The first of equal windows, where the ids of each begin, and these ids."""
        key = np.zeros(len(starts), np.uint64)
        for k in range(n):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + self.words[starts + k].astype(np.uint64) + np.uint64(1))
        _, first, number = np.unique(key, return_index=True, return_inverse=True)
        same = starts[first][number]
        if any((self.words[starts + k] != self.words[same + k]).any() for k in range(n)):  # two windows of one hash
            rows = np.ascontiguousarray(self.words[starts[:, None] + np.arange(n)]).view(np.dtype((np.void, 4 * n))).ravel()
            _, first, number = np.unique(rows, return_index=True, return_inverse=True)
        wide = max(1, len(self.ids))
        pairs = np.unique(number.astype(np.int64) * wide + place[self.of(starts)])
        small = np.int32 if len(pairs) < 1 << 31 else np.int64
        return starts[first], np.searchsorted(pairs, np.arange(len(first) + 1) * wide).astype(small), (pairs % wide).astype(small)


def _several(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ..., as many as size says, of each."""
    return np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)


def shard_hits(docs: list[np.ndarray], windows: Windows) -> list[tuple[np.ndarray | None, np.ndarray]]:
    """For each document (numbered words, 0: not in the benchmark): which words are hit, and the places of the hitting
    items among the ids.  Equal windows of several items are sought and located once."""
    limits = np.concatenate([[0], np.cumsum([len(d) for d in docs], dtype=np.int64)]).astype(np.int64)
    all_words = np.concatenate([np.zeros(0, np.int32), *docs])
    none = [(None, np.zeros(0, np.int64)) for _ in docs]
    if not windows.starts or not len(all_words):
        return none
    used = all_words > 0
    # runs of benchmark words inside one document, as long as the shortest window at least
    edge = np.zeros(len(all_words) + 1, bool)
    edge[limits] = True
    start = np.flatnonzero(used & (edge[:-1] | ~np.concatenate([[False], used[:-1]])))
    end = np.flatnonzero(used & (edge[1:] | ~np.concatenate([used[1:], [False]]))) + 1
    long_ = end - start >= windows.shortest
    start, size = start[long_], (end - start)[long_]
    if not len(start):
        return none
    # each run and one end symbol
    step = size + 1
    base = np.cumsum(step) - step
    source = np.arange(int(step.sum())) + np.repeat(start - base, step)
    last = base + size
    text = all_words[np.minimum(source, len(all_words) - 1)].astype(np.int64)
    text[last] = 0
    index = FMIndex(text, len(windows.vocabulary) + 1)
    delta = np.zeros(len(all_words) + 1, np.int64)
    items: list[list[np.ndarray]] = [[] for _ in docs]
    for length, (starts, limits_of, places) in windows.distinct.items():
        for at in range(0, len(starts), SOUGHT):
            own = starts[at : at + SOUGHT]
            found, low, high = index.search(windows.words[own[:, None] + np.arange(length)].astype(np.int64))
            if not len(found):
                continue
            n = high - low
            place = source[index.locate(_several(low, n))]
            np.add.at(delta, place, 1)
            np.add.at(delta, place + length, -1)
            doc = np.searchsorted(limits, place, "right") - 1
            pairs = np.unique(doc * len(starts) + np.repeat(found + at, n))
            doc, window = pairs // len(starts), pairs % len(starts)
            for a, z in zip(first := run_starts(doc), np.append(first[1:], len(doc))):
                begins = limits_of[window[a:z]]
                items[doc[a]].append(np.unique(places[_several(begins, limits_of[window[a:z] + 1] - begins)]))
    hit = np.cumsum(delta)[:-1] > 0
    return [(hit[limits[k] : limits[k + 1]], np.unique(np.concatenate(found))) if found else none[k] for k, found in enumerate(items)]


def _named(parts: list[tuple[pa.Array, np.ndarray]]) -> pa.Array:
    """The ids that a document's places stand for, over one or more blocks of the benchmark, in order."""
    found = [ids.take(pa.array(places)) for ids, places in parts]
    if len(found) < 2:
        return found[0] if found else pa.array([], pa.string())
    return pa.array(sorted({x for f in found for x in f.to_pylist()}, key=lambda x: (x is None, x or "")), pa.string())


def _runs(hit: np.ndarray) -> np.ndarray:
    change = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return change.reshape(-1, 2)


def _char_spans(raw: bytes, runs: np.ndarray) -> list[dict]:
    """Word runs as code point limits, from the first word's start to the last one's end."""
    inside = np.frombuffer(raw.translate(_WORD_BYTES), np.uint8) != 32
    change = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))).reshape(-1, 2)
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [{"start": int(chars[change[a, 0]]), "end": int(chars[change[b - 1, 1]])} for a, b in runs]


def _searched(rows: Iterator[pa.RecordBatch], blocks: Blocks) -> Iterator[pa.RecordBatch]:
    """Columns row, n_words, hits, items, spans of each batch; a shard is as many batches as hold SHARD_WORDS words."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    held: list[tuple[pa.Array, list[list[bytes]], list[bytes]]] = []

    def flush():
        tokens = [t for _, words, _ in held for t in words]
        hits: list = [None] * len(tokens)
        items: list[list] = [[] for _ in tokens]
        for windows in blocks:
            number = windows.vocabulary.get
            numbered = [np.fromiter(map(number, t, itertools.repeat(0)), np.int32, len(t)) for t in tokens]
            for k, (hit, more) in enumerate(shard_hits(numbered, windows)):
                if hit is not None:
                    hits[k] = hit.copy() if hits[k] is None else hits[k] | hit
                    items[k].append((windows.ids, more))
        base = 0
        for row, words, raws in held:
            # documents that many items hit go out in batches of their own
            many = np.cumsum([sum(len(p) for _, p in items[base + k]) for k in range(len(raws))], dtype=np.int64) // OUT_ITEMS
            for a, z in zip(first := run_starts(many).tolist(), [*first[1:], len(raws)]):
                found = [_runs(h) if h is not None else () for h in hits[base + a : base + z]]
                names = [_named(p) for p in items[base + a : base + z]]
                columns = [
                    row.slice(a, z - a), pa.array([len(t) for t in words[a:z]], pa.int64()), pa.array([[{"start": int(x), "end": int(y)} for x, y in f] for f in found], span),
                    pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, names)]), pa.int32()), pa.concat_arrays(names)),
                    pa.array([_char_spans(raw, f) if len(f) else [] for raw, f in zip(raws[a:z], found)], span),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["row", "n_words", "hits", "items", "spans"])
            base += len(raws)
        held.clear()

    n = 0
    for batch in rows:
        raws = [raw or b"" for raw in batch.column(1).to_pylist()]
        words = [words_of(raw) for raw in raws]
        held.append((batch.column(0), words, raws))
        n += sum(map(len, words))
        if n >= SHARD_WORDS:
            yield from flush()
            n = 0
    yield from flush()


class Blocks:
    """The blocks of a benchmark in the shared folder; a task keeps the last few that it read."""

    def __init__(self, folder: str, blocks: int, width: int):
        self.folder, self.width, self.numbers, self.kept = folder, width, list(range(blocks)), {}

    def __iter__(self) -> Iterator[Windows]:
        # back and forth, so that the blocks still held come first
        for k in self.numbers:
            if k not in self.kept:
                while len(self.kept) >= KEPT_BLOCKS:
                    self.kept.pop(next(iter(self.kept)))
                self.kept[k] = self.read(k)
            yield self.kept[k]
        self.numbers.reverse()

    def read(self, k: int) -> Windows:
        store, at = fs.FileSystem.from_uri(f"{self.folder}/block={k}")
        if store.get_file_info(at).type == fs.FileType.NotFound:
            return Windows([], self.width)
        found = dataset.dataset(at, filesystem=store, format="parquet").to_table(columns=["item", "words"])
        return Windows(list(zip(found["item"].to_pylist(), found["words"].to_pylist())), self.width)


def pieces(benchmark: DataFrame, width: int) -> DataFrame:
    """(item, words): items as words with blanks between; long ones in pieces, which overlap so that each window is in one."""
    size = PIECE_WORDS

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            item, out = [], []
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(raw or b"")
                for at in range(0, max(1, len(words) - width + 1), size):
                    item.append(i)
                    out.append(b" ".join(words[at : at + size + width - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(out, pa.binary())], ["item", "words"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.encode("text", "UTF-8").alias("raw"))
    return map_arrow(rows, run, "item string, words binary")


def written(benchmark: DataFrame, width: int, block_bytes: int) -> Blocks:
    """The benchmark's items in as many blocks as their bytes make."""
    found = stored(pieces(benchmark, width).where(F.length("words") > 0), "pieces")
    total = found.agg(F.sum(F.length("words") + 64)).first()[0] or 0
    blocks = -(-total // block_bytes)
    folder = new_folder(benchmark.sparkSession, "benchmark")
    block = F.pmod(F.xxhash64("item", "words"), F.lit(max(1, blocks))).cast("int")
    found.withColumn("block", block).repartition(min(max(1, blocks), partitions(benchmark.sparkSession)), "block").write.partitionBy("block").parquet(folder)
    dropped(found)
    return Blocks(folder, blocks, width)


def find_passages(docs: DataFrame, benchmark: DataFrame, width: int = 13, carry: list[str] | None = None, text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: row (a struct of the carried columns), n_words, n_hit, hits (word runs, end exclusive), items
    (sorted ids) and spans (the runs as code points)."""
    blocks = written(benchmark, width, block_bytes)
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry or ["doc_id"]]).alias("row"), F.encode(text_col, "UTF-8").alias("raw"))
    rest = T._parse_datatype_string(f"n_words long, hits {_SPAN}, items array<string>, spans {_SPAN}")
    out = map_arrow(df, lambda rows: _searched(rows, blocks), T.StructType([df.schema["row"], *rest.fields]))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return out.select("row", "n_words", n_hit.alias("n_hit"), "hits", "items", "spans")


def contaminated(n_hit, n_words):
    """The rule: at least a twentieth of a document's words lie in benchmark windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
