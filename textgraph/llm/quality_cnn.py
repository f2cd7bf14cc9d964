"""Quality classifier: a byte-level convolutional network in numpy (operator 4).

Bytes are embedded; learned filters slide over the whole document with a stride; each filter's responses are
max-pooled over overlapping chunks of two blocks; the chunks' maxima, means and minima are combined by a hidden layer
into one probability.  Documents are scored batch by batch where they lie; there is no shuffle of texts.

The network is fitted on a bounded sample of labelled rows (``sample_rows`` rows, in the order of a hash of the id, and
``sample_bytes`` bytes of text), on the driver.  Rows are chosen by ids and lengths alone.  Where their texts are longer than
the bytes allow, the longest are shortened, all to the same length, each to a piece at a place that the hash of its id
gives; no row falls out of the sample for its length or for that of others.  Scoring reads every byte of every document.

Defined cases: a null or empty text is scored as padding; rows without label, or with a null one, don't train; where no row is
labelled the score is 1/2 for all, with a warning if there are labels that belong to none of the documents; where the sample
holds one class only the score tends to it; a null id is in the training folds and not held out; repeated rows are scored
separately; extra columns may be carried along; an empty table gives no rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgraph.llm.common import map_arrow, text_bytes

WIDTH, STRIDE, EMBED, FILTERS, HIDDEN = 12, 4, 8, 32, 16
#: Positions of a block; a chunk is two neighbouring blocks, so chunks overlap by half.  Blocks convolved at a time.
BLOCK, SLICE = 64, 512


@dataclass
class Network:
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, seed: int) -> Network:
        r = np.random.default_rng(seed)
        normal = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
        return cls(
            normal(256, EMBED, scale=0.5), normal(WIDTH * EMBED, FILTERS, scale=(WIDTH * EMBED) ** -0.5), np.zeros(FILTERS, np.float32),
            normal(3 * FILTERS, HIDDEN, scale=(3 * FILTERS) ** -0.5), np.zeros(HIDDEN, np.float32), normal(HIDDEN, scale=HIDDEN**-0.5), np.zeros(1, np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]


def laid_out(raw: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents in whole blocks: the padded bytes, each block's number of true positions, each document's first block."""
    length = np.diff(limits)
    positions = np.maximum(1, -(-(length - WIDTH) // STRIDE) + 1)
    blocks = -(-positions // BLOCK)
    first = np.cumsum(blocks) - blocks
    total = int(blocks.sum())
    padded = np.zeros(total * BLOCK * STRIDE + WIDTH, np.uint8)
    for at, a, b in zip((first * BLOCK * STRIDE).tolist(), limits[:-1].tolist(), limits[1:].tolist()):
        padded[at : at + b - a] = raw[a:b]
    within = np.arange(total) - np.repeat(first, blocks)
    return padded, np.minimum(BLOCK, np.repeat(positions, blocks) - within * BLOCK), first


def responses(net: Network, padded: np.ndarray, true: np.ndarray, arg: bool = False):
    """Each block's largest response per filter (and its position)."""
    best, where = np.empty((len(true), FILTERS), np.float32), np.empty((len(true), FILTERS), np.int64) if arg else None
    for b in range(0, len(true), SLICE):
        n = min(SLICE, len(true) - b)
        part = net.embed[padded[b * BLOCK * STRIDE : (b + n) * BLOCK * STRIDE + WIDTH]]
        rows = np.lib.stride_tricks.as_strided(part, (n * BLOCK, WIDTH * EMBED), (STRIDE * EMBED * 4, 4))
        out = (rows @ net.filters).reshape(n, BLOCK, FILTERS)
        short = np.flatnonzero(true[b : b + n] < BLOCK)
        for k in short:
            out[k, true[b + k] :] = -np.inf
        best[b : b + n] = out.max(1)
        if arg:
            where[b : b + n] = out.argmax(1)
    return best, where


def pooled(net: Network, best: np.ndarray, first: np.ndarray):
    """From blocks to chunks to each document's maxima, means and minima."""
    active = np.maximum(best + net.bias, 0)
    last = np.append(first[1:], len(best)) - 1
    paired = np.minimum(np.arange(len(best)) + 1, np.repeat(last, last - first + 1))
    chunks = np.maximum(active, active[paired])
    # a document's last block pairs with itself; where it has others, that chunk lies inside the one before
    keep = np.ones(len(best), bool)
    keep[last[last > first]] = False
    number = np.cumsum(keep) - 1
    at = number[first]
    kept = chunks[keep]
    count = np.diff(np.append(at, len(kept)))[:, None]
    vector = np.concatenate([np.maximum.reduceat(kept, at), np.add.reduceat(kept, at) / count, np.minimum.reduceat(kept, at)], 1)
    return vector, active, paired, keep, at, kept, count


def scores(net: Network, raw: np.ndarray, limits: np.ndarray) -> np.ndarray:
    if len(limits) < 2:
        return np.zeros(0)
    padded, true, first = laid_out(raw, limits)
    vector = pooled(net, responses(net, padded, true)[0], first)[0]
    z = np.tanh(vector @ net.hidden + net.hidden_bias) @ net.out + net.out_bias
    return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


def gradient(net: Network, raw: np.ndarray, limits: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    padded, true, first = laid_out(raw, limits)
    best, where = responses(net, padded, true, arg=True)
    vector, active, paired, keep, at, kept, count = pooled(net, best, first)
    h = np.tanh(vector @ net.hidden + net.hidden_bias)
    z = h @ net.out + net.out_bias
    dz = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / len(labels)).astype(np.float32)
    dh = dz[:, None] * net.out * (1 - h * h)
    dv = dh @ net.hidden.T
    d_max, d_mean, d_min = dv[:, :FILTERS], dv[:, FILTERS : 2 * FILTERS], dv[:, 2 * FILTERS :]
    doc = np.repeat(np.arange(len(at)), count.ravel())
    d_chunk = (d_mean / count)[doc]
    for value, d in ((vector[:, :FILTERS], d_max), (vector[:, 2 * FILTERS :], d_min)):
        hit = kept == value[doc]
        d_chunk += d[doc] * hit / np.maximum(np.add.reduceat(hit, at, dtype=np.int64), 1)[doc]
    block = np.flatnonzero(keep)
    second = paired[block]
    own = active[block] >= active[second]
    d_block = np.zeros_like(active)
    d_block[block] += d_chunk * own
    np.add.at(d_block, second, d_chunk * ~own)
    d_block *= active > 0
    # a block's gradient flows to the bytes under its strongest position
    b, f = np.nonzero(d_block)
    g = d_block[b, f]
    under = padded[((b * BLOCK + where[b, f]) * STRIDE)[:, None] + np.arange(WIDTH)]
    d_filters = np.zeros_like(net.filters)
    order = np.argsort(f, kind="stable")
    b_, f_, g_, under = b[order], f[order], g[order], under[order]
    limits_f = np.searchsorted(f_, np.arange(FILTERS + 1))
    d_embed = np.zeros((256, EMBED), np.float64)
    for k in range(FILTERS):
        s = slice(limits_f[k], limits_f[k + 1])
        if s.start == s.stop:
            continue
        d_filters[:, k] = g_[s] @ net.embed[under[s]].reshape(s.stop - s.start, -1)
        weight = net.filters[:, k].reshape(WIDTH, EMBED)
        for j in range(WIDTH):
            d_embed += np.bincount(under[s][:, j], g_[s], 256)[:, None] * weight[j]
    return [d_embed.astype(np.float32), d_filters, d_block.sum(0), vector.T @ dh, dh.sum(0), h.T @ dz, dz.sum(keepdims=True)]


def train(texts: list[bytes], labels: np.ndarray, steps: int = 600, size: int = 24, rate: float = 0.01, seed: int = 7) -> Network:
    """Adam over shuffled batches of documents; the rate falls to zero."""
    net, random = Network.fresh(seed), np.random.default_rng(seed)
    if len(texts):
        share = np.clip(labels.mean(), 0.01, 0.99)
        net.out_bias[:] = np.log(share / (1 - share))
    else:
        net.out[:] = 0
        return net
    first, second, order = [np.zeros_like(p) for p in net.parts()], [np.zeros_like(p) for p in net.parts()], np.zeros(0, int)
    for t in range(1, steps + 1):
        if len(order) < size:
            order = np.concatenate([order, random.permutation(len(texts))])
        take, order = order[:size], order[size:]
        part = [texts[k] for k in take]
        limits = np.concatenate([[0], np.cumsum([len(x) for x in part])]).astype(np.int64)
        grads = gradient(net, np.frombuffer(b"".join(part), np.uint8), limits, labels[take].astype(np.float32))
        for p, g, m, v in zip(net.parts(), grads, first, second):
            m += 0.1 * (g - m)
            v += 0.002 * (g * g - v)
            p -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.998**t)) + 1e-7)
    return net


def fold(id_col: str) -> Column:
    """0 for the held-out rows; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5))


def piece_bytes(lengths: list[int], total: int) -> int:
    """The length to which texts are cut so that they have no more bytes than total, or 1 each: the largest that does."""
    left, number = total, len(lengths)
    for n in sorted(lengths):
        if n * number > left:
            return max(1, left // number)
        left, number = left - n, number - 1
    return max(1, max(lengths, default=1))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 3000, sample_bytes: int = 16 << 20, seed: int = 7) -> Network:
    """Learn from at most sample_rows labelled documents outside the held-out fold, of sample_bytes in all."""
    named = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id") != 0))
    named = named.select("doc_id", (F.col("quality") > 0).cast("int").alias("quality"), F.xxhash64("doc_id").alias("by"))
    texts = docs.select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("raw")).withColumns({"bytes": F.length("raw"), "same": F.xxhash64("raw")})
    # labels of other documents take no place in the sample
    known = named.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = known.orderBy("by", "doc_id", "quality").limit(sample_rows)
    order = ["by", "doc_id", "quality", "same"]
    sample = texts.drop("raw").join(F.broadcast(chosen), "doc_id").orderBy(*order).limit(sample_rows)
    rows = sample.collect()  # ids, lengths and labels
    if not rows and named.limit(1).count() and docs.limit(1).count():
        warnings.warn("no labelled document is among the texts: every score will be 1/2", stacklevel=2)
    most = piece_bytes([r.bytes for r in rows], sample_bytes)
    wanted = docs.sparkSession.createDataFrame([(r.doc_id, r.same, r.by) for r in rows], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, same long, by long").distinct()
    start = F.when(F.col("bytes") > most, F.pmod("by", F.col("bytes") - most + 1)).otherwise(0).cast("int")
    piece = F.substring("raw", start + 1, F.lit(most))
    found = texts.join(F.broadcast(wanted), ["doc_id", "same"]).select("doc_id", "same", piece.alias("piece")).dropDuplicates(["doc_id", "same"])
    pieces = {(r.doc_id, r.same): bytes(r.piece) for r in found.collect()}
    return train([pieces[r.doc_id, r.same] for r in rows], np.array([r.quality for r in rows], np.float32), seed=seed)


def score(docs: DataFrame, net: Network, carry: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """(row, score): row is a struct of the carried columns."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(net, *text_bytes(batch.column(1))))], ["row", "score"])

    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry or ["doc_id"]]).alias("row"), F.coalesce(text_col, F.lit("")).alias("t"))
    return map_arrow(df, run, T.StructType([df.schema["row"], T.StructField("score", T.DoubleType())]))
