"""Cost-balanced packing of token sequences (operator 10).

A piece of n tokens costs ``n + n * n / quadratic``: the linear layers and the attention within the piece.  Each task
tokenizes its rows and gathers pools of pool_sequences sequences.  Full sequences are cut from longer documents; what
remains is taken in descending length, and each goes whole to the sequence of the lowest cost that has room for it.
Tails of equal length go in the order of their starts, then as they came; of sequences of equal cost the first opened takes a tail.
Only where no sequence has room is it cut, over the lowest-cost sequences with any capacity left.  A pool opens as many sequences as
its tokens fill, so none is padded; what is left over moves to the task's next pool, and at the end of a task goes to sequences
whose lengths are the powers of two that add up to it.  There is no shuffle; a task holds one batch of texts
and the pool, which keeps the tails' ids alone.

Defined cases: null and empty texts hold the end token alone; a null doc_id stays null; repeated rows and ids are
packed as separate documents (rows); extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.llm.common import map_arrow

#: Words, and parts of words, whose ids a task remembers: some 200 bytes each.
REMEMBERED = 250_000
#: Pieces of at most a sequence that go out at once.
OUT_ROWS = 1024
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


#: Words of printable ASCII and precomposed Latin letters (but U+0130, which lowers to two characters): what the
#: tokenizer's normalizer and splitter do with these is lower-casing and this split.
_PLAIN = re.compile(r"[\x21-\x7e\u00c0-\u012f\u0131-\u024f]+")
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\s\w]|_)+")


class WordTokenizer:
    """Ids of whole texts, for the vocabulary of lower-case words: white space separates words and leaves no ids.

    Words are found and numbered by Arrow, and a task remembers the ids of words and of their parts.  Parts not seen before are
    encoded many at once; an id that ends a word tells where the next one's begin.  Other words go to the tokenizer whole.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        if len(self.words) > REMEMBERED:
            self.words.clear()
        if len(self.parts) > REMEMBERED:
            self.parts.clear()
        split = {w: _SPLIT.findall(w.lower()) for w in words if "<|" not in w and _PLAIN.fullmatch(w)}
        other = [w for w in words if w not in split]
        self.words.update(zip(other, self._whole(other)))
        new = list({p for parts in split.values() for p in parts if p not in self.parts})
        for at in range(0, len(new), 2048):
            part = new[at : at + 2048]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            limits = [0, *(np.flatnonzero(self.ends[ids]) + 1).tolist()]
            pieces = [ids[a:b].tobytes() for a, b in zip(limits, limits[1:])] if len(limits) == len(part) + 1 else self._whole(part)
            self.parts.update(zip(part, pieces))
        for w, parts in split.items():
            self.words[w] = b"".join([self.parts[p] for p in parts])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and each text's limits in them."""
        words = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        coded = words.flatten().dictionary_encode()
        unique = coded.dictionary.to_pylist()
        if new := [w for w in unique if w not in self.words]:
            self._learn(new if len(self.words) <= REMEMBERED else unique)
        parts = [self.words[w] for w in unique]
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        flat = np.frombuffer(b"".join(parts), np.uint32)
        first = np.cumsum(size) - size
        at = coded.indices.to_numpy(zero_copy_only=False)
        lengths = size[at]
        ends = np.cumsum(lengths)
        which = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first[at] - (ends - lengths), lengths)
        word_limits = words.offsets.to_numpy().astype(np.int64)
        return flat[which], np.concatenate([[0], ends])[word_limits - word_limits[0]]


class Packer:
    """Pools documents of one task and deals them into sequences."""

    def __init__(self, capacity: int, pool_sequences: int, quadratic: float):
        self.capacity, self.pool, self.quadratic = capacity, pool_sequences * capacity, quadratic
        self.made, self.held, self.tokens, self.rows = 0, [], 0, []

    def cost(self, n):
        return n + n * n / self.quadratic

    def add(self, doc, ids: np.ndarray) -> None:
        full = len(ids) // self.capacity * self.capacity
        for at in range(0, full, self.capacity):
            self._put(doc, at, ids[at : at + self.capacity], len(ids), self._open(), 0)
        if full < len(ids):
            self.held.append((doc, full, len(ids), ids[full:].copy()))  # the tail alone, not the whole document's ids
            self.tokens += len(ids) - full
        if self.tokens >= self.pool:
            self.deal([self.capacity] * (self.tokens // self.capacity))

    def _open(self) -> int:
        self.made += 1
        return self.made - 1

    def _put(self, doc, start, ids, total, sequence, offset) -> None:
        self.rows.append((doc, start, len(ids), ids.tobytes(), total, sequence, offset))

    def deal(self, sizes: list[int]) -> None:
        """Fill sequences of these sizes; what finds no room stays in the pool."""
        left = np.array(sizes, np.int64)
        used, cost = np.zeros(len(sizes), np.int64), np.zeros(len(sizes))
        number = [self._open() for _ in sizes]
        kept = []
        for doc, start, total, ids in sorted(self.held, key=lambda x: (-len(x[3]), x[1])):
            while len(ids):
                fits = left >= len(ids)
                among = fits if fits.any() else left > 0
                if not among.any():
                    kept.append((doc, start, total, ids))
                    break
                k = int(np.argmin(np.where(among, cost, np.inf)))
                n = int(min(left[k], len(ids)))
                self._put(doc, start, ids[:n], total, number[k], int(used[k]))
                left[k] -= n
                used[k] += n
                cost[k] += self.cost(n)
                start, ids = start + n, ids[n:]
        self.held = kept
        self.tokens = sum(len(ids) for *_, ids in kept)

    def finish(self) -> None:
        """Full sequences, then the powers of two that add up to the rest: nothing is padded."""
        if full := self.tokens // self.capacity:
            self.deal([self.capacity] * full)
        rest = self.tokens
        self.deal([1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1])

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[]] * 7
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in SCHEMA.split(", ")])


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, pool_sequences: int = 256, quadratic: float = 4096.0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = WordTokenizer(tokenizer), Packer(capacity, pool_sequences, quadratic)
        packer.made = TaskContext.get().partitionId() << 36
        end = np.array([end_id], "<u4")
        for batch in rows:
            ids, limits = words.ids(batch.column(1))
            for k, doc in enumerate(batch.column(0).to_pylist()):
                packer.add(doc, np.concatenate([ids[limits[k] : limits[k + 1]], end]).astype("<u4"))
                if len(packer.rows) >= OUT_ROWS:
                    yield packer.batch()
            yield packer.batch()
        packer.finish()
        yield packer.batch()

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")), run, SCHEMA)
