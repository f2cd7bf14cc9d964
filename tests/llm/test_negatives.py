"""Operator 12 against brute force over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textgraph.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string, score double, block int"


def plain(rows, is_anchor, positives=5, negatives_=5, low=80):
    """rows of (id, vector, label), ids unique."""
    own = {i: (np.array([math.floor(256 * float(np.float32(x))) for x in v]), label) for i, v, label in rows}
    size = max([0, *(len(v) for v, _ in own.values())])
    own = {i: (np.pad(v, (0, size - len(v))).astype(object), label) for i, (v, label) in own.items()}
    out = []
    for a in filter(is_anchor, own):
        v, label = own[a]
        scored = sorted((-int(v @ w), i, other) for i, (w, other) in own.items() if i != a)
        for p, pid, other in [x for x in scored if x[2] == label][:positives]:
            fits = [(n, nid) for n, nid, other in scored if other != label and low * -p <= 100 * -n <= 100 * -p][:negatives_]
            out += [(a, pid, k + 1, nid, -p, -n) for k, (n, nid) in enumerate(fits)]
    return sorted(out)


def clusters(seed, n, dim=8, common=0):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = [(k, [c + r.gauss(0, 0.3) for c in r.choice(centres)], r.randrange(3)) for k in range(n - common)]
    return rows + [(n - common + k, centres[0], r.randrange(3)) for k in range(common)]


def frame(spark, rows):
    return spark.createDataFrame([(*x, "x", 1.5, None) for x in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize(("bits", "gathered", "anchors", "tile"), [(8, 32, 512, 1 << 21), (4, 0, 3, 7), (3, 5, 1, 1)])
def test_rows(spark, monkeypatch, bits, gathered, anchors, tile):
    for name, value in (("BITS", bits), ("GATHERED", gathered), ("ANCHORS", anchors), ("TILE", tile)):
        monkeypatch.setattr(negatives, name, value)
    rows = clusters(1, 120, common=30) if bits < 8 else clusters(1, 700, common=250)  # very many equal vectors
    got = negatives.mine(frame(spark, rows), F.col("id") % 10 == 0)
    wanted = plain(rows, lambda i: i % 10 == 0)
    assert len(wanted) > 40
    assert sorted(map(tuple, got.collect())) == wanted
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]


def test_grid(spark, monkeypatch):
    """Blocks of anchors beyond a broadcast."""
    monkeypatch.setattr(negatives, "is_small", lambda df: False)
    monkeypatch.setattr(negatives, "GROUP", 2)
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    rows = clusters(2, 300)
    got = negatives.mine(frame(spark, rows), F.col("id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == plain(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    rows = clusters(3, 60)
    bad = [(None, [1.0] * 8, 1), (100, None, 1), (101, [1.0] * 8, None), (102, [float("nan")] * 8, 1), (103, [float("inf")] * 8, 1), (104, [None] * 8, 1)]
    more = [(-200, [], 1), (-100, [1.0, 2.0], 1), (110, [2.0, 2.0], 0), (120, [2.0, 2.0, 0.1], 1), (1 << 61, [2.0, 2.0], 0)]
    again = [rows[0], rows[10], (20, [9.0] * 8, 5)]  # repeated; of two rows with one id the one with the smaller label counts
    got = negatives.mine(frame(spark, rows + bad + more + again), F.col("id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == plain(rows + more, lambda i: i % 10 == 0)
    assert negatives.mine(frame(spark, bad), F.lit(True)).count() == 0
    assert negatives.mine(frame(spark, rows).limit(0), F.lit(True)).count() == 0
    assert negatives.mine(frame(spark, rows), F.lit(False)).count() == 0


def test_large_components(spark):
    rows = [(k, [x * 1e4 for x in v], label) for k, v, label in clusters(4, 80)]
    got = negatives.mine(frame(spark, rows), F.col("id") % 10 == 0, low=60)
    assert sorted(map(tuple, got.collect())) == plain(rows, lambda i: i % 10 == 0, low=60)
    with pytest.raises(ValueError, match="62 bits"):
        negatives.mine(frame(spark, [(1, [1e18], 1)]), F.lit(True)).count()
