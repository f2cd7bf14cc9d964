"""Fuzzy line dedup (operator 5).

Lines are trimmed and lower-cased; blank ones are left alone.  Equal lines are merged by their text and get a number; those of
fewer than SHINGLE characters take part by equality alone.  Other distinct ones get MinHash signatures over their character
shingles and meet in BANDS bands of ROWS values; two lines of similarity s meet with probability 1 - (1 - s ** ROWS) ** BANDS,
0.986 at the threshold of 0.8.  Lines that share a band are compared: a sketch of each shingle set, one bit a shingle, bounds
how many shingles two lines can share, which settles nearly all pairs without loss; the others are decided by the exact
Jaccard similarity of their sets, whose shingles are compared by 64-bit hashes.  Distributed union-find joins what is similar, and of each component the first line (by
document id and place) is kept.  Other lines are removed.

Copies are pre-aggregated before anything else, so a line is signed and compared once however often it stands.  Band values
that very many lines share are found by counting one line in COUNTED of them; this only decides how the work is dealt.  Their
lines are compared with a few representatives first, exactly; lines linked in this way are one component and need not
meet each other, and what is left of the band is cut into parts that meet all its lines' parts in cells, in different tasks.
A band that the count misses is compared whole.  A cell hands on a spanning forest of its links, never all pairs.  At the end, lines are looked up by 128 bits of hashes.

Defined cases: null and empty texts stay as they are; an id is given to rows with null or equal ids, in the order of id
and text; other columns are carried along; an empty table stays empty; a document may lose all its lines and keeps the text ''.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.llm.common import Scratch, Store, components, contract, filtered_joins, hashed_joins, keyed, map_arrow, mixed, partitions, run_starts, small, stored, text_bytes, without

#: Five characters: of ten, one changed character takes so many that no pair under 99 characters reaches the threshold; of
#: three, long lines that have nothing in common share so many that candidates grow with the square of the lines.
MIN_CHARS, SHINGLE, SIMILARITY = 1, 5, 0.8
#: More values a band than the recall needs: lines without likeness share more short shingles, and must not meet by them.
BANDS, ROWS = 14, 6
#: Lines of a band value that one task compares; of how many lines one is counted to find band values beyond that.
PART_LINES, COUNTED = 4096, 64
#: Numbers that the lines of a block span at most (two bytes each), and about how many band values a task sorts at a time.
BLOCK_LINES, BUCKET_VALUES = 1 << 16, 1 << 20
#: Characters of a piece of a line, and about how many are signed together.
LONG = 1 << 16
#: Words of 64 bits in a sketch, rows and columns of a tile, lines of a group up to which pairs are listed by distance, and
#: lines of a larger group that are compared with all its others first.
SKETCH, TILE, FEW, FIRST = 4, 512, 32, 8
#: Lines of a hot band that its other lines are compared with first.
REPRESENTATIVES = 8
_BASE = 0x9E3779B97F4A7C15


def _normal(line: Column) -> Column:
    return F.lower(F.trim(line))


def lines_of(texts: DataFrame) -> DataFrame:
    """(id, place, line) of the lines that take part."""
    # outer: no filter over the split text is inferred, which would split it twice; there is a line at least
    each = texts.select("id", F.posexplode_outer(F.split("text", "\n")).alias("place", "line"))
    return each.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select("id", "place", _normal(F.col("line")).alias("line"))


def characters(raw: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 lines as code points, and their limits in those."""
    begins = (raw & 0xC0) != 0x80
    return np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum(begins)])[limits]


def shingle_hashes(chars: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of lines of SHINGLE characters or more, and each line's limits in them."""
    values = mixed(chars.astype(np.uint64) + np.uint64(1))
    size = len(chars) - SHINGLE + 1
    hashes = np.zeros(size, np.uint64)
    for j, power in enumerate(np.cumprod(np.array([1] + [_BASE] * (SHINGLE - 1), np.uint64))):
        hashes += values[j : j + size] * power
    inside = np.ones(len(chars), bool)  # shingles that end in their line
    for back in range(1, SHINGLE):
        inside[limits[1:] - back] = False
    return mixed(hashes[inside[:size]]), limits - np.arange(len(limits)) * (SHINGLE - 1)


def segments(limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines cut into pieces of at most LONG characters and a few, which overlap so that each shingle is in one: the lines'
    numbers, starts and ends."""
    size = np.diff(limits) - SHINGLE + 1
    n = -(-size // LONG)
    line = np.repeat(np.arange(len(n)), n)
    start = limits[:-1][line] + (np.arange(len(line)) - np.repeat(np.cumsum(n) - n, n)) * LONG
    return line, start, np.minimum(start + LONG + SHINGLE - 1, limits[1:][line])


def signatures(raw: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Band values (lines, BANDS) of UTF-8 lines of SHINGLE characters or more."""
    if len(limits) < 2:
        return np.zeros((0, BANDS), np.int64)
    chars, limits = characters(raw, limits)
    line, start, end = segments(limits)
    least = np.empty((BANDS * ROWS, len(line)), np.uint32)
    # as many pieces at a time as fit into a processor's cache, for all hash functions
    group = np.cumsum(end - start) // LONG
    for a in (first := run_starts(group)).tolist():
        b = first[np.searchsorted(first, a) + 1] if a != first[-1] else len(line)
        size = end[a:b] - start[a:b]
        own = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(own[-1]) + np.repeat(start[a:b] - own[:-1], size)
        hashes, own = shingle_hashes(chars[place], own)
        value, step = (hashes >> np.uint64(32)).astype(np.uint32), hashes.astype(np.uint32) | np.uint32(1)
        for k in range(BANDS * ROWS):
            np.minimum.reduceat(value, own[:-1], out=least[k, a:b])
            value += step
    least = np.minimum.reduceat(least, run_starts(line), axis=1)
    out = np.empty((len(limits) - 1, BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(out), band + 1, np.uint64)
        for row in range(ROWS):
            key = mixed(key * np.uint64(_BASE) + least[band * ROWS + row])
        out[:, band] = key
    return out.view(np.int64)


def _signed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        lines = batch.column(1)
        long = pc.greater_equal(pc.utf8_length(lines), SHINGLE)
        bands = signatures(*text_bytes(lines.filter(long)))
        sizes = long.to_numpy(zero_copy_only=False) * np.int32(BANDS)  # no bands for lines that hold no shingle
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(bands.ravel()))
        yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "bands"])


class Lines:
    """Lines of several groups as sorted sets of shingle hashes, with sketches of those."""

    def __init__(self, lines: pa.Array):
        chars, limits = characters(*text_bytes(lines))
        some = run_starts(limits[:-1] // LONG)  # about as many characters at a time as fit into a processor's cache
        hashes = [shingle_hashes(chars[limits[a] : limits[b]], limits[a : b + 1] - limits[a])[0] for a, b in zip(some.tolist(), [*some[1:].tolist(), len(lines)])]
        hashes, limits = np.concatenate(hashes), limits - np.arange(len(limits)) * (SHINGLE - 1)
        for a, b in zip(limits[:-1].tolist(), limits[1:].tolist()):
            hashes[a:b].sort()
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        new[limits[:-1]] = True
        self.size = np.add.reduceat(new, limits[:-1], dtype=np.int64)
        self.hashes, self.ends = hashes[new], np.cumsum(self.size)
        bits = np.zeros((len(lines), 64 * SKETCH), np.uint8)
        bits[np.repeat(np.arange(len(lines)), self.size), (self.hashes & np.uint64(64 * SKETCH - 1)).view(np.int64)] = 1
        self.sketch = np.packbits(bits, axis=1).view(np.uint64)

    def similar(self, a: int, b: int) -> bool:
        """Whether the exact Jaccard similarity of two lines' shingle sets reaches the threshold."""
        m, n = int(self.size[a]), int(self.size[b])
        both = np.concatenate([self.hashes[self.ends[a] - m : self.ends[a]], self.hashes[self.ends[b] - n : self.ends[b]]])
        both.sort(kind="stable")  # two runs are merged
        both = int(np.count_nonzero(both[1:] == both[:-1]))
        return both >= SIMILARITY * (m + n - both)

    def possible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether lines a and b can be similar: a's bits that b lacks are shingles that b lacks, and the other way round."""
        x, y, m, n = self.sketch[a], self.sketch[b], self.size[a], self.size[b]
        only = lambda p, q: np.bitwise_count(p & ~q).sum(-1, dtype=np.int64)
        both = np.minimum(m - only(x, y), n - only(y, x))
        return both >= SIMILARITY * (m + n - both)

    def links(self, start: np.ndarray, end: np.ndarray, known: np.ndarray | None = None) -> list[tuple[int, int]]:
        """A spanning forest of the similar lines of each group [start, end).  known: numbers of lines that are linked already
        where these are equal and not 0; they are not compared with each other."""
        out = []
        known = np.zeros(len(self.size), np.int64) if known is None else known
        size = end - start
        few = np.repeat((size > 1) & (size <= FEW), size)
        group = np.repeat(np.arange(len(size)), size)
        at = np.flatnonzero(few)
        found = [np.zeros((0, 2), np.int64)]
        for shift in range(1, FEW):
            at = at[at + shift < len(group)]
            at = at[group[at] == group[at + shift]]
            if not len(at):
                break
            open_ = at[(known[at] != known[at + shift]) | (known[at] == 0)]
            hit = open_[self.possible(open_, open_ + shift)]
            found.append(np.stack([hit + shift, hit], 1))
        pairs = np.concatenate(found)
        root: dict[int, int] = {}

        def find(k: int) -> int:
            while (up := root.get(k, k)) != k:
                root[k] = k = root.get(up, up)
            return k

        for a, b in pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))].tolist():
            x, y = find(a), find(b)
            if x != y and self.similar(a, b):
                root[max(x, y)] = min(x, y)
                out.append((a, b))
        for a, b in zip(start[size > FEW].tolist(), end[size > FEW].tolist()):
            out += self.tiled(a, b, known)
        return out

    def tiled(self, start: int, end: int, known: np.ndarray) -> list[tuple[int, int]]:
        """The same for one large group, in the order of set sizes.  A few lines are compared with all others first; what is
        joined with the most others by then need not be compared with these, so only the rest meets all, tile by tile."""
        order = np.arange(start, end)[np.argsort(self.size[start:end], kind="stable")]
        size, out = self.size[order], []
        _, first, root = np.unique(np.where(known[order] == 0, -1 - np.arange(len(order)), known[order]), return_index=True, return_inverse=True)
        root = first[root]

        def join(x: np.ndarray, y: np.ndarray) -> None:
            while len(x):
                x, y = x[(apart := root[x] != root[y])], y[apart]
                one = run_starts(x)  # one open pair of each line, then those still open again
                for k, m in zip(x[one].tolist(), y[one].tolist()):
                    if root[k] != root[m] and self.similar(int(order[k]), int(order[m])):
                        low, high = sorted((root[k], root[m]))
                        root[root == high] = low
                        out.append((max(int(order[k]), int(order[m])), min(int(order[k]), int(order[m]))))
                x, y = np.delete(x, one), np.delete(y, one)

        everyone = np.arange(len(order))
        for k in np.linspace(0, len(order) - 1, FIRST).astype(np.int64).tolist():
            others = everyone[root != root[k]]
            others = others[self.possible(order[others], np.broadcast_to(order[k], len(others)))]
            join(others, np.full(len(others), k))
        main = np.bincount(root).argmax()
        rest = everyone[root != main]
        for i in range(0, len(rest), TILE):
            a = rest[i : i + TILE]
            low = np.searchsorted(size, SIMILARITY * size[a[0]], "left")  # sizes beyond these can't be similar
            high = np.searchsorted(size, size[a[-1]] / SIMILARITY, "right")
            for j in range(low, high, TILE):
                b = everyone[j : min(j + TILE, high)]
                x, y = np.nonzero(self.possible(order[a][:, None], order[b][None, :]))
                join(a[x], b[y])
        return out


def _hot(each: DataFrame, store: Store = stored) -> DataFrame | None:
    """(band, parts) of the band values that more than PART_LINES lines share, by the count of one line in COUNTED."""
    counts = each.where(F.pmod(F.xxhash64("name"), F.lit(COUNTED)) == 0).groupBy("band").agg(F.count("*").alias("n"))
    hot = store(counts.where(F.col("n") * COUNTED > PART_LINES).select("band", F.ceil(F.col("n") * COUNTED / PART_LINES).cast("int").alias("parts")), "hot")
    return hot if hot.limit(1).count() else None


def settled(distinct: DataFrame, hot: DataFrame, store: Store = stored) -> tuple[DataFrame, DataFrame]:
    """Lines of hot bands that are linked by a few exact comparisons: (name, known), where equal numbers are linked lines, and the
    links (a, b).  Each line is compared with REPRESENTATIVES lines of one of its hot bands, which meet it wherever it is, so a
    template's fillings become one component in linear time and need not meet each other again."""
    count = REPRESENTATIVES
    own = distinct.select("name", F.explode("bands").alias("band")).join(small(hot.select("band")), "band")
    own = store(own.groupBy("name").agg(F.min("band").alias("band")), "chosen")
    picked = own.groupBy("band").agg(F.array_distinct(F.array(*[F.min_by("name", F.xxhash64("name", F.lit(k))) for k in range(count)])).alias("reps"))
    texts = picked.select("band", F.posexplode("reps").alias("k", "name")).join(distinct.select("name", "line"), "name")
    sorted_ = F.array_sort(F.collect_list(F.struct("k", "name", "line")))  # no more than REPRESENTATIVES
    reps = texts.groupBy("band").agg(sorted_.alias("r")).select("band", F.transform("r", lambda x: x["name"]).alias("reps"), F.transform("r", lambda x: x["line"]).alias("lines"))
    reps = store(reps, "representatives")

    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            name, band = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            mask = np.zeros(len(name), np.int64)
            for b in np.unique(band).tolist():
                at = np.flatnonzero(band == b)
                first = batch.column(3)[int(at[0])].values
                n = len(first)
                both = Lines(pa.concat_arrays([first.cast(pa.string()), batch.column(2).take(pa.array(at)).cast(pa.string())]))
                for k in range(n):
                    near = np.flatnonzero(both.possible(n + np.arange(len(at)), np.full(len(at), k)))
                    mask[at[[x for x in near.tolist() if both.similar(n + x, k)]]] |= 1 << k
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(mask)], ["name", "band", "mask"])

    met = own.join(distinct.select("name", "line"), "name").join(small(reps.select("band", "lines")), "band").select("name", "band", "line", "lines")
    masks = store(map_arrow(met, compare, "name long, band long, mask long").where("mask <> 0"), "masks")

    def connected(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Masks that share a bit, step by step, are one component; its number is its lowest bit's."""
        for batch in rows:
            out = [[], [], []]
            for band, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                wide = list(own)
                while (wider := [_joined(wide, m) for m in wide]) != wide:
                    wide = wider
                for m, w in zip(own, wide):
                    for c, x in zip(out, (band, m, (w & -w).bit_length() - 1)):
                        c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["band", "mask", "part"])

    parts = map_arrow(masks.groupBy("band").agg(F.collect_set("mask").alias("masks")), connected, "band long, mask long, part long")
    parts = store(parts, "mask_parts")  # no more than 2 ** REPRESENTATIVES a band
    names = small(reps.select("band", "reps"))
    low = F.expr("length(bin(mask & -mask)) - 1")
    each = masks.join(names, "band").select(F.col("name").alias("x"), F.get("reps", low).alias("y"))
    bits = F.explode(F.filter(F.sequence(F.lit(0), F.lit(count - 1)), lambda k: F.expr("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), k)) != 0))
    among = parts.join(names, "band").withColumn("bit", bits).select(F.get("reps", "bit").alias("x"), F.get("reps", low).alias("y"))
    links_ = each.union(among).where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
    known = masks.join(small(parts), ["band", "mask"]).select("name", F.xxhash64("band", "part").alias("known"))
    return known, links_


def _joined(masks: list[int], own: int) -> int:
    """A mask with all that share a bit with it."""
    for m in masks:
        if m & own:
            own |= m
    return own


def in_cells(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """(band, name, known) of bands that very many share, cut into cells.  In such a band, the lines that are known to be linked
    with the most others are many and need not meet; of the others, which are cut into parts like all lines, each part
    meets all lines' parts.  Where the others are most lines, all pairs of parts meet, each in one cell."""
    inside = rows.join(small(hot), "band")
    counts = inside.groupBy("band", "known").agg(F.count("*").alias("n"))
    main = counts.groupBy("band").agg(F.sum("n").alias("n"), F.max_by("known", F.when(F.col("known") != 0, F.col("n"))).alias("main"), F.max(F.when(F.col("known") != 0, F.col("n"))).alias("most"))
    main = main.select("band", F.coalesce("main", F.lit(0)).alias("main"), (2 * F.coalesce("most", F.lit(0)) < F.col("n")).alias("all_open"), F.ceil((F.col("n") - F.coalesce("most", F.lit(0))) / PART_LINES).cast("int").alias("open_parts"))
    inside = inside.join(small(main), "band", "left")
    at = F.xxhash64("name", F.lit(1))
    part, mine = F.pmod(at, F.col("parts")).cast("int"), F.pmod(at, F.greatest("open_parts", F.lit(1))).cast("int")
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    cell = lambda i, j: F.xxhash64("band", i, j)
    all_pairs = F.transform(upto(F.col("parts")), lambda o: cell(F.least(part, o), F.greatest(part, o)))
    as_any = F.transform(upto(F.col("open_parts")), lambda i: cell(i, part))
    as_open = F.when((F.col("known") == 0) | (F.col("known") != F.col("main")), F.transform(upto(F.col("parts")), lambda j: cell(mine, j))).otherwise(F.array().cast("array<bigint>"))
    cells = F.when(F.col("all_open"), all_pairs).otherwise(F.array_distinct(F.concat(as_any, as_open)))
    return inside.select(F.explode(cells).alias("band"), "name", "known")


def in_blocks(distinct: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(key, name) of the lines that share a band value, without the values in hot.  Most values are one line's, so they are
    not dealt row by row: the values of up to BLOCK_LINES lines that fall into a bucket are one row, and a bucket, which is
    bounded, is sorted in numpy.  key: a hash of the lines that share the value, so values with the same lines are one key;
    with hot, the value."""
    parts = partitions(distinct.sparkSession)
    same, span = hot is None, BLOCK_LINES
    buckets = parts * (1 + distinct.count() * BANDS // (parts * BUCKET_VALUES))

    def blocks(name: np.ndarray, band: np.ndarray) -> pa.RecordBatch:
        """Of lines within span numbers, a row for each bucket: values, and the lines' places behind the first."""
        bucket = (((band.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")  # by radix, if few
        first = run_starts(bucket[order])
        limits = np.append(first, len(order)).astype(np.int32)
        base = int(name[0])
        binary = lambda x: pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(limits * np.int32(x.itemsize)), pa.py_buffer(x)])
        columns = [pa.array(bucket[order][first]), pa.array(np.full(len(first), base)), binary(band[order]), binary((name - base).astype(np.uint16)[order])]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "base", "bands", "places"])

    def dealt(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, bands, n = [], [], 0
        for batch in rows:
            own = batch.column(0).to_numpy()[pc.list_parent_indices(batch.column(1)).to_numpy()]
            if n and len(own) and own[-1] - names[0][0] >= span:
                yield from cut(np.concatenate(names), np.concatenate(bands))
                names, bands, n = [], [], 0
            if len(own):
                names.append(own)
                bands.append(pc.list_flatten(batch.column(1)).to_numpy())
                n += len(own)
        if n:
            yield from cut(np.concatenate(names), np.concatenate(bands))

    def cut(name: np.ndarray, band: np.ndarray) -> Iterator[pa.RecordBatch]:
        a = 0
        while a < len(name):  # numbers rise within a file, and jump between two
            far = (name[a:] < name[a]) | (name[a:] >= name[a] + span)
            b = a + int(far.argmax()) if far.any() else len(name)
            yield blocks(name[a:b], band[a:b])
            a = b

    def left_out(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if batch.num_rows:
                yield blocks(np.full(batch.num_rows, -1), batch.column(0).to_numpy())

    def gathered(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, skipped = None, [], []

        def several() -> pa.RecordBatch:
            band, name = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(band)
            band = band[order]
            again = np.concatenate([[False], band[1:] == band[:-1], [False]])
            many = np.flatnonzero(again[1:] | again[:-1])  # values of several lines
            key, name = band[many], name[order[many]]
            if same and len(many):
                first = run_starts(key)
                size = np.diff(np.append(first, len(key)))
                key = np.repeat(mixed(np.add.reduceat(mixed(name.view(np.uint64)), first) + size.astype(np.uint64)).view(np.int64), size)
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(name)], ["key", "name"])

        for batch in rows:
            for b, base, bands, places in zip(*(c.to_pylist() for c in batch.columns)):
                if b != bucket:
                    if held:
                        yield several()
                    bucket, held, skipped = b, [], []
                band = np.frombuffer(bands, np.int64)
                if base < 0:
                    skipped.append(band)
                    continue
                name = base + np.frombuffer(places, np.uint16).astype(np.int64)
                if skipped:
                    skipped = [np.concatenate(skipped)]
                    other = ~np.isin(band, skipped[0])
                    band, name = band[other], name[other]
                if len(band):
                    held.append((band, name))
        if held:
            yield several()

    schema = "bucket int, base long, bands binary, places binary"
    rows = map_arrow(distinct.select("name", "bands"), dealt, schema)
    if hot is not None:
        rows = rows.union(map_arrow(hot.select("band"), left_out, schema))
    return map_arrow(rows.repartitionById(parts, F.col("bucket")).sortWithinPartitions("bucket", "base"), gathered, "key long, name long")


def shared_bands(distinct: DataFrame, hot: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """(key, name, known) of the lines that share a band value; band values with the same lines are one key, and those whose
    lines are all known to be linked are none."""
    if hot is None:
        return in_blocks(distinct).distinct().select("key", "name", F.lit(0).cast("long").alias("known"))

    def linked(rows: DataFrame) -> DataFrame:
        if known is None:
            return rows.select("band", "name", F.lit(0).cast("long").alias("known"))
        return rows.join(known, "name", "left").select("band", "name", F.coalesce("known", F.lit(0)).alias("known"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, enough = [], 0, 1 << 17

        def several(last: bool) -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*held)]
            cut = len(columns[0]) if last else int(np.searchsorted(columns[0], columns[0][-1]))
            held[:] = [tuple(c[cut:] for c in columns)]
            band, name, linked = (c[:cut] for c in columns)
            first = run_starts(band)
            size = np.diff(np.append(first, len(band)))
            if len(first):
                done = (np.minimum.reduceat(linked, first) == np.maximum.reduceat(linked, first)) & (linked[first] != 0)
                many = np.repeat((size > 1) & ~done, size)
                same = mixed(np.add.reduceat(mixed(name.view(np.uint64)), first) + size.astype(np.uint64)).view(np.int64)
            else:
                many, same = np.zeros(0, bool), size
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(same, size)[many]), pa.array(name[many]), pa.array(linked[many])], ["key", "name", "known"])

        for batch in rows:
            held.append(tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2)))
            n += batch.num_rows
            if n >= enough:
                yield several(False)
                n = len(held[0][0])
                enough = max(1 << 17, 2 * n)  # what one long band holds is joined again only when it has doubled
        if held:
            yield several(True)

    crowded = distinct.select("name", F.explode("bands").alias("band")).join(small(hot.select("band")), "band")
    cold = in_blocks(distinct, hot).withColumnRenamed("key", "band")
    rows = in_cells(linked(crowded), hot).select("band", "name", "known").union(linked(cold))
    dealt = rows.repartition(partitions(distinct.sparkSession), "band").sortWithinPartitions("band")
    return map_arrow(dealt, run, "key long, name long, known long").distinct()


def links(distinct: DataFrame, store: Store = stored) -> DataFrame:
    """(a, b): numbers of similar lines."""
    hot = _hot(distinct.select("name", F.explode("bands").alias("band")), store)
    known, early = settled(distinct, hot, store) if hot else (None, None)
    known = store(known, "known") if hot else None
    candidates = store(shared_bands(distinct, hot, known), "candidates", release=True)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, enough = [], 0, 1 << 11

        def out(last: bool) -> pa.RecordBatch:
            nonlocal held
            whole = pa.Table.from_batches(held).combine_chunks()
            key = whole.column(0).to_numpy()
            cut = len(key) if last else int(np.searchsorted(key, key[-1]))
            held = whole.slice(cut).to_batches()
            names, found = whole.column(1).to_numpy()[:cut], []
            if cut:
                first = run_starts(key[:cut])
                found = Lines(whole.column(2).slice(0, cut).combine_chunks()).links(first, np.append(first[1:], cut), whole.column(3).to_numpy()[:cut])
            pairs = names[np.array(found, np.int64).reshape(-1, 2)]
            return pa.RecordBatch.from_arrays([pa.array(pairs.max(1)), pa.array(pairs.min(1))], ["a", "b"])

        for batch in rows:
            held.append(batch)
            n += batch.num_rows
            if n >= enough:
                yield out(False)
                n = sum(b.num_rows for b in held)
                enough = max(1 << 11, 2 * n)
        if n:
            yield out(True)

    with filtered_joins(distinct.sparkSession):  # most lines share no band, and their texts stay where they are
        met = distinct.select("name", "line").join(candidates.where("name >= 0"), "name").select("key", "name", "line", "known")
        dealt = met.repartition(partitions(distinct.sparkSession), "key").sortWithinPartitions("key")
        found = map_arrow(dealt, lambda rows: contract(run(rows)), "a long, b long")  # in one worker, not in two
        found = store(found, "found", release=True)
    return found.union(early) if hot else found


def _hashes() -> list[Column]:
    return [F.xxhash64("line").alias("h1"), F.xxhash64("line", F.lit(1)).alias("h2")]


def removed_lines(texts: DataFrame, store: Store = stored) -> DataFrame:
    """(id, gone): the places of the lines to remove, over (id, text) with unique ids.  store keeps what is used several times."""
    distinct = lines_of(texts).groupBy("line").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    distinct = distinct.select(F.monotonically_increasing_id().alias("name"), "line", "first", "n", *_hashes())
    distinct = store(map_arrow(distinct, _signed, "name long, line string, first long, n long, h1 long, h2 long, bands array<long>"), "lines", release=True)
    joined = store(components(links(distinct, store), forests=True, store=store).withColumnRenamed("node", "name"), "joined")
    named = distinct.select("name", "n", "first", "h1", "h2")  # without the texts
    with filtered_joins(texts.sparkSession):  # most lines are neither linked nor repeated
        linked = store(named.join(joined.where("component >= 0"), "name").select("component", "first", "h1", "h2"), "linked", release=True)
    owner = linked.groupBy("component").agg(F.min("first").alias("owner"))
    alone = named.where("n > 1").join(joined, "name", "left_anti").select("h1", "h2", F.col("name").alias("component"), F.col("first").alias("owner"))
    several = store(linked.join(owner, "component").select("h1", "h2", "component", "owner").union(alone), "several", release=True)
    # several grows with the corpus; a hot line's rows are split by adaptive joins
    met = lines_of(texts).select("id", "place", *_hashes()).join(several, ["h1", "h2"]).select("id", "place", "component", "owner")
    # all lines of other documents than the component's first go; of its own, all but the first
    other = F.col("id") != F.col("owner")
    found = met.groupBy("id").agg(
        F.collect_list(F.when(other, F.col("place"))).alias("others"), F.sort_array(F.collect_list(F.when(~other, F.struct("component", "place")))).alias("own")
    )
    again = F.filter("own", lambda x, k: F.coalesce(F.get("own", k - 1)["component"] == x["component"], F.lit(False)))
    gone = found.select("id", F.concat("others", F.transform(again, lambda x: x["place"])).alias("gone"))
    return gone.where(F.size("gone") > 0)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, text, n_lines, n_removed): row holds the columns of docs, text is what is left."""
    own, scratch = keyed(docs, id_col, text_col), Scratch()
    with hashed_joins(docs.sparkSession):
        gone = stored(removed_lines(own.select("id", "text"), scratch), "gone", release=True)
    scratch.drop()  # before texts are shuffled
    # where gone is not small, texts are shuffled once, within their rows
    original = F.col("row")[text_col]
    out = own.select("id", "row").join(small(gone), "id", "left").select("row", "gone", F.split(F.coalesce(original, F.lit("")), "\n").alias("lines"))
    left = without(F.col("lines"), F.col("gone"))
    return out.select(
        "row",
        F.when(F.col("gone").isNull(), original).otherwise(F.array_join(left, "\n")).alias("text"),
        F.when(original.isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
    )
