"""Operator 13 against plain lists of turns."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from textgraph.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, conv string, depth int, fp double"


def plain(rows, h=lambda c: zlib.crc32(str(c).encode()) % 6, base=lambda c: int(c - abs(c) % 100 * (1 if c > 0 else -1))):
    convs = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(c, []).append((role or "", text or ""))
    built = {c: convs.get(base(c), [])[: h(c)] + ts[h(c) :] for c, ts in convs.items()}
    nodes = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in nodes:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p, own in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in children)
            saved[p[:d]] = saved.get(p[:d], 0) + (len(own) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, own in nodes.items():
        ids = ",".join(map(str, sorted(c for c in own if len(built[c]) == len(p))))
        out.append((min(own), len(p), min(nodes[p[:-1]]) if p else None, len(own), children.get(p, 0), leaves[p], saved[p], hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, rows, parts=5):
    conv = F.col("conv")
    df = spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, prefixes.trie(df, conv - conv % 100, F.crc32(conv.cast("string")) % 6).collect()), key=str)


def conversations(seed, n, words=3):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        c = r.randrange(-150, 900)
        rows += [(c, t, r.choice(("user", "assistant", None)), r.choice(["é" * w for w in range(words)] + [None])) for t in range(r.randint(0, 7))]
    return rows


def test_nodes(spark):
    rows = conversations(1, 300)
    rows += [(200, None, "user", "first"), (200, None, "user", "also"), (200, 3, "user", "b"), (200, 3, "user", "a"), (None, 1, "user", "x"), (100, 0, None, None)]
    rows += rows[:40]  # repeated
    wanted = plain(rows)
    assert len({n[1] for n in wanted}) > 5
    assert trie(spark, rows) == wanted


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_collisions_split(spark, monkeypatch, bits):
    """Fingerprints so short that nearly all prefixes of a depth meet in one group."""
    monkeypatch.setattr(prefixes, "BITS", bits)
    rows = conversations(2, 60, 2)
    assert trie(spark, rows) == plain(rows)


def test_a_conversation_over_many_tasks(spark):
    """A third of all turns are of one conversation, another is its copy, and very many have but one turn in common."""
    long = [(300, t, "user", f"t{t % 7}") for t in range(300)] + [(700, t, "user", f"t{t % 7}") for t in range(300)]
    rows = long + [(1000 + 7 * k, 0, "user", "hello") for k in range(200)] + [(9000, None, "user", f"{k % 3}") for k in range(100)]
    assert trie(spark, rows) == plain(rows)


def test_turnless_and_nothing(spark):
    rows = [(17, 0, "user", "gone")]  # fewer turns than it would take over from a conversation that doesn't exist
    assert zlib.crc32(b"17") % 6 >= 1
    assert trie(spark, rows) == plain(rows) == [(17, 0, None, 1, 0, 1, 0, hashlib.sha256(b"17").hexdigest())]
    assert trie(spark, [(None, 1, "user", "x")]) == []


def test_fingerprints_follow_the_polynomial():
    import numpy as np

    n = np.array([0, 1, 2, 5, 63, 1000])
    assert prefixes.powers(prefixes._BASE, n).tolist() == [pow(prefixes._BASE, int(k), 1 << 64) for k in n]
    assert (prefixes._BASE * prefixes._INVERSE) & prefixes._WRAP == 1
