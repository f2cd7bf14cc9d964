"""Byte-level BPE encoding and decoding in linear time (operator 11).

Ranks are those of a public file; the merges are never replayed over a text.  Bytes are mapped to Latin-1, and an automaton of all
tokens finds the longest one that begins at each byte.  Encoding takes the longest token, then its next shorter prefix that is
a token, and so on; a token may follow another if merging the bytes of both alone would leave the two as they are, and a text
whose neighbours all are compatible in this way is the one that the merges give.  Where none fits, the last token is taken
back; a place from which the rest can't be encoded is never tried again, so a text takes linear time.  Compatibility of two
tokens is found by undoing their merges from the seam outwards, and is memoised, as are the ids of short matches of the pattern.

Texts are cut into slices where a blank follows another character, at which no match of the pattern can continue, so what a
worker holds beyond a text and its ids is bounded; memos are emptied at fixed sizes, which changes no result.

Defined cases: null and empty texts have no ids and decode to no bytes; the pattern's matches are encoded one by one, and what it
doesn't match is dropped; a match that is a token as a whole is that token, even one that no merges reach; a vocabulary
without one of the 256 bytes, or with a token that ranks before one it is merged from, is refused, and so are ids beyond it; rows with null or equal ids and extra columns, whatever
their names, are carried along; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgraph.llm.common import local_file, map_arrow, ship_file

#: Entries of a memo before it is emptied: matches and pairs of tokens.  Bytes of a match that is remembered.
MATCHES, PAIRS, SHORT = 400_000, 500_000, 64
#: Characters of a text that are matched at a time, at least; ids that are decoded at a time.
SLICE, IDS = 1 << 18, 1 << 16
#: Later than any merge.
NEVER = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Vocabulary:
    """Tokens and their ranks, which are their ids."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"a vocabulary of bytes needs all 256; {len(missing)} are missing")
        self.ranks, self.token = ranks, {rank: token for token, rank in ranks.items()}
        self.size = {rank: len(token) for token, rank in ranks.items()}
        #: The longest token that a token begins with, itself apart; -1 if there is none.
        self.shorter = {rank: next((ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), -1) for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._pairs: dict[tuple[int, int], bool] = {}

    def halves(self, token: int) -> tuple[int, int] | None:
        """What the last merge of a token joins; none if its bytes don't merge into it.  A single byte is its own halves."""
        if token not in self._halves:
            parts = [bytes([b]) for b in self.token[token]]
            while len(parts) > 2:
                found = [self.ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
                if (least := min(found)) == NEVER:
                    break
                at = found.index(least)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            ends = self.ranks[parts[0]], self.ranks[parts[-1]]
            if len(parts) == 2 and max(ends) > token:
                raise ValueError(f"token {token} comes before what it is merged from")
            self._halves[token] = ends if len(parts) <= 2 else None
        return self._halves[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges reach the right token and leave the two side by side."""
        if len(self._pairs) >= PAIRS:
            self._pairs.clear()
        known = self._pairs[left, right] = self.halves(right) is not None and self._seam_holds(left, right)
        return known

    def _seam_holds(self, a: int, b: int) -> bool:
        """Back in time from the last merge: a and b are the parts next to the seam, and a_until, b_until the merges that took
        them in.  A merge across the seam happens if it comes before both; of equal merges the left one comes first."""
        a_until = b_until = NEVER
        while True:
            across = self.ranks.get(self.token[a] + self.token[b])
            if across is not None and across < a_until and across <= b_until:
                return False
            if self.size[a] == self.size[b] == 1:
                return True
            if self.size[b] == 1 or (a > b and self.size[a] > 1):
                a_until, a = a, self.halves(a)[1]
            else:
                b_until, b = b, self.halves(b)[0]

    def encode(self, match: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        whole = self.ranks.get(match)
        if whole is not None or not match:
            return [whole] if match else []
        size, shorter, pairs = self.size, self.shorter, self._pairs
        longest = np.zeros(len(match), np.int64) if len(match) > SHORT else [0] * len(match)
        for end, token in self.automaton.iter(match.decode("latin-1")):
            longest[end - size[token] + 1] = token  # a longer one ends later
        ids, at, dead, last = [], 0, bytearray(len(match) + 1), -1
        token = int(longest[0])
        while True:
            while token >= 0:
                end = at + size[token]
                if not dead[end]:
                    fits = pairs.get((last, token)) if ids else self.halves(token)
                    if fits or (ids and fits is None and self.compatible(last, token)):
                        break
                token = shorter[token]
            if token >= 0:
                ids.append(token)
                at, last = end, token
                if at == len(match):
                    return ids
                token = int(longest[at])
            else:
                dead[at] = 1
                token = ids.pop()
                at -= size[token]
                last = ids[-1] if ids else -1
                token = shorter[token]


class Matches(dict):
    """The ids of matches, as bytes; short ones are remembered."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, match: str) -> bytes:
        data = match.encode()
        ids = np.array(self.vocabulary.encode(data), "<u4").tobytes()
        if len(data) <= SHORT:
            if len(self) >= MATCHES:
                self.clear()
            self[match] = ids
        return ids


_SEAM = regex.compile(r"\S\s")


def slices(text: str, size: int) -> Iterator[str]:
    """A text in slices of that many characters or more, cut before white space that follows something else."""
    at = 0
    while at < len(text):
        seam = _SEAM.search(text, at + size)
        end = seam.start() + 1 if seam else len(text)
        yield text[at:end]
        at = end


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(row, ids): row holds the columns of docs that are carried (all), ids are little-endian unsigned 32-bit integers."""
    name = ship_file(docs.sparkSession, ranks_path)
    kept = [F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]
    rows = docs.select(F.struct(*kept).alias("row"), F.col(f"`{text_col}`").alias("text"))
    size = SLICE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, known = regex.compile(pattern), Matches(_vocabulary(local_file(name)))
        for batch in batches:
            ids = []
            for text in batch.column(1):
                parts = [b"".join(map(known.__getitem__, found.findall(part))) for part in slices(text.as_py() or "", size)]
                ids.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["row", "ids"])

    return map_arrow(rows, run, T.StructType([rows.schema["row"], T.StructField("ids", T.BinaryType())]))


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """encoded with the bytes that its ids stand for."""
    name = ship_file(encoded.sparkSession, ranks_path)
    place = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _vocabulary(local_file(name)).token
        for batch in batches:
            texts = []
            for ids in batch.column(place):
                ids = np.frombuffer(ids.as_py() or b"", "<u4")
                texts.append(b"".join(b"".join(map(token.__getitem__, ids[k : k + IDS].tolist())) for k in range(0, len(ids), IDS)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "bytes"])

    return map_arrow(encoded, run, T.StructType([*encoded.schema, T.StructField("bytes", T.BinaryType())]))


_VOCABULARIES: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    """One for each worker process, which serves many tasks."""
    if path not in _VOCABULARIES:
        _VOCABULARIES.clear()
        _VOCABULARIES[path] = Vocabulary(read_ranks(path))
    return _VOCABULARIES[path]
